"""Aggregate expressions with the NULL and tie rules the marts rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeframe.functions.aqi import _col

LINEAGE = ["raw_loaded_at", "raw_sync_run_id", "raw_sync_started_at"]


def arg_max(value, version, *tiebreak) -> Column:
    """Value at the highest version, ignoring rows where the value is NULL."""
    v = _col(value)
    order = F.struct(_col(version), *[_col(t) for t in tiebreak]) if tiebreak else _col(version)
    return F.max_by(v, F.when(v.isNotNull() & _col(version).isNotNull(), order))


def arg_min(value, version, *tiebreak) -> Column:
    v = _col(value)
    order = F.struct(_col(version), *[_col(t) for t in tiebreak]) if tiebreak else _col(version)
    return F.min_by(v, F.when(v.isNotNull() & _col(version).isNotNull(), order))


def mode_of(column) -> Column:
    """Most frequent value, smallest on ties.

    Keeps one counter per distinct value, so use it on categories; for wide
    domains use ``operators.ranking.dominant``.
    """
    return F.mode(_col(column), deterministic=True)


def avg_where(value, condition: Column) -> Column:
    return F.avg(F.when(condition, _col(value)))


def sum_where(value, condition: Column) -> Column:
    """Sum over matching rows; 0 (not NULL) when none match."""
    return F.coalesce(F.sum(F.when(condition, _col(value))), F.lit(0.0))


def count_distinct_where(value, condition: Column) -> Column:
    return F.count_distinct(F.when(condition, _col(value)))


def newest_lineage() -> Column:
    """Lineage of the most recently loaded row, as one struct."""
    return F.max(F.struct(*[F.col(c) for c in LINEAGE]))


def ratio(a, b) -> Column:
    """a / b, NULL when b is 0."""
    b = _col(b)
    return _col(a) / F.when(b != 0, b)
