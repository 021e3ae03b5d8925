"""Query registration."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from registry.compare import tidy


@dataclass(frozen=True)
class Entry:
    name: str
    ids: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, ids: str, sql: str | None):
    """Register ``fn(spark, folder)`` under a name, with survey ids and its SQL twin."""
    def wrap(fn):
        ENTRIES[name] = Entry(name, ids, lambda spark, folder: tidy(fn(spark, folder)), sql)
        return fn
    return wrap
