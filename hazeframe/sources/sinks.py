"""Sinks: CSV chunks, table append, recent-window export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.sources.landing import _struct


def write_csv(df: DataFrame, path: str) -> None:
    """Append CSV chunks; Spark gives each file a unique name, nested values become JSON."""
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("struct", "array", "map")]
    df = df.withColumns({c: F.to_json(c) for c in nested})
    df.write.mode("append").option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").option("escape", '"').csv(path)


def append_table(df: DataFrame, path: str, schema, partition: str | None = None, sort: list[str] = ()) -> None:
    """Append in the table's column order; absent columns are NULL.

    Rows are clustered by partition value before the write, so each task writes
    few files, and sorted inside a file for min/max skipping.
    """
    fields = _struct(schema).fields
    out = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    if partition:
        out = out.withColumn("month", F.date_format(partition, "yyyy-MM")).repartition("month", *sort)
    if sort:
        out = out.sortWithinPartitions(*(["month"] if partition else []), *sort)
    writer = out.write.mode("append")
    (writer.partitionBy("month") if partition else writer).parquet(path)


def recent(df: DataFrame, ts_col: str, days: int, as_of) -> DataFrame:
    """Rows of the last ``days`` before ``as_of``."""
    kind = dict(df.dtypes)[ts_col]
    start = F.lit(as_of).cast(kind) - F.expr(f"INTERVAL {int(days)} DAYS")
    return df.filter(F.col(ts_col) >= start.cast(kind))


def export_recent(df: DataFrame, path: str, ts_col: str | None = None, days: int = 14, as_of=None) -> None:
    """Parquet export; tables with a time column are limited to the last days."""
    (df if ts_col is None else recent(df, ts_col, days, as_of)).write.mode("overwrite").parquet(path)
