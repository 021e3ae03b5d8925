"""Reusable filter predicates."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SCOPE_COLUMNS = {"region": "region_3", "area": "region_8", "province": "province", "ward": "province"}


def conjunction(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def build_where(scope: str | None = None, value: str | None = None, dates=None, unit: str = "day",
                mix: str | None = None, source: str | None = None, date_col: str = "date") -> Column:
    """Conjunction of source, spatial-scope and date filters (all optional).

    ``dates`` holds one bound (equality) or two (inclusive range).  Literals
    keep the column's type so the predicate reaches the scan.
    """
    parts = []
    if mix:
        parts.append(F.col("source_mix") == mix)
    if source:
        parts.append(F.col("source") == source)
    if value and scope in SCOPE_COLUMNS:
        parts.append(F.col(SCOPE_COLUMNS[scope]) == value)
    if dates:
        column = "datetime_hour" if unit == "hour" else date_col
        kind = "timestamp" if unit == "hour" else "date"
        _two_at_most(dates)
        bounds = [F.lit(d if isinstance(d, (date, datetime)) else str(d)).cast(kind) for d in dates]
        parts.append(F.col(column) == bounds[0] if len(bounds) == 1
                     else F.col(column).between(*bounds))
    return conjunction(parts)


def _two_at_most(dates) -> None:
    if len(dates) > 2:
        raise ValueError(f"one date or a first and a last one, not {len(dates)}")


def monthly_where(dates, date_col: str = "date") -> Column:
    """Range over month starts that contain the given dates."""
    if not dates:
        return F.lit(True)
    _two_at_most(dates)
    months = [F.lit(d.replace(day=1)).cast("date") for d in dates]
    return F.col(date_col) == months[0] if len(months) == 1 else F.col(date_col).between(*months)


def present(*columns: str) -> Column:
    """Every column is neither NULL nor ''."""
    return conjunction([F.col(c).isNotNull() & (F.col(c) != "") for c in columns])


def only(column: str, values) -> Column:
    return F.col(column).isin(list(values))


def except_(column: str, values) -> Column:
    return ~F.col(column).isin(list(values))


def observed() -> Column:
    return (F.col("confidence_score") >= 0.5) & F.col("source_mix").isin("observed", "mixed")


def modeled() -> Column:
    return (F.col("source_mix") == "modeled") | (F.col("confidence_score") < 0.5)


def once_per_scope(df, scopes: list[Column]):
    """The rows of every scope stacked, from one pass: a row comes once for each scope that holds it."""
    hits = F.filter(F.array(*[F.when(s, F.lit(i)) for i, s in enumerate(scopes)]), lambda x: x.isNotNull())
    return df.withColumn("_scope", F.explode(hits)).drop("_scope")
