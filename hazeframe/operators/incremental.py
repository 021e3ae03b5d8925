"""High-water marks, affected keys, run control, materialisation, backfill."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.operators.dedup import keep_last
from hazeframe.sources.tables import BUCKETS, StoredTable, partition_values


def high_water_mark(control: DataFrame, source: str) -> datetime:
    """Last successful run of ``source`` (epoch if none); one row reaches the driver."""
    row = control.filter(F.col("source") == source).agg(F.max("last_success")).first()
    return row[0] or datetime(1970, 1, 1)


def incremental_filter(df: DataFrame, control: DataFrame, source: str, column: str = "raw_loaded_at") -> DataFrame:
    """Rows loaded after the mark; the mark is a literal, so the filter reaches the scan."""
    return df.filter(F.col(column) > F.lit(high_water_mark(control, source)))


def affected_keys(changed: list[DataFrame], column: str = "affected_key") -> DataFrame:
    """Distinct union of the one-column key sets touched by new rows."""
    parts = [df.toDF(column).distinct() for df in changed]
    return reduce(lambda a, b: a.union(b), parts).distinct()


def restrict(df: DataFrame, keys: DataFrame, column: str, key_column: str = "affected_key") -> DataFrame:
    """Only rows whose key was touched."""
    return df.join(keys.withColumnRenamed(key_column, column), column, "left_semi")


# --- run control ---------------------------------------------------------------

CONTROL_SCHEMA = ("source string, last_run timestamp, last_success timestamp, records_ingested bigint, "
                  "lag_seconds bigint, error_message string, updated_at timestamp")


def control_rows(control: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows to append for finished runs: a failed run keeps the earlier success.

    ``runs``: source, last_run, records_ingested, success, error_message.  Lag
    is 0 on success, seconds since the last success on failure, -1 if never.
    """
    before = (control.filter(F.col("last_success") > F.lit(fv.EPOCH).cast("timestamp"))
              .groupBy("source").agg(F.max("last_success").alias("_before")))
    ok = F.col("success")
    since = F.unix_timestamp("last_run") - F.unix_timestamp("_before")
    return runs.join(before, "source", "left").select(
        "source", "last_run",
        F.when(ok, F.col("last_run")).otherwise(F.coalesce("_before", F.lit(fv.EPOCH).cast("timestamp"))).alias("last_success"),
        F.col("records_ingested").cast("bigint").alias("records_ingested"),
        F.when(ok, F.lit(0)).when(F.col("_before").isNull(), F.lit(-1)).otherwise(since).cast("bigint").alias("lag_seconds"),
        "error_message", F.col("last_run").alias("updated_at"))


def success_ratio(df: DataFrame, ok, by: list[str] = (), minimum: float = 0.90) -> DataFrame:
    """Share of successful rows and whether it clears the gate (0 when empty)."""
    hit, n = F.count_if(ok), F.count(F.lit(1))
    share = F.coalesce(hit / F.when(n > 0, n), F.lit(0.0))
    return df.groupBy(*by).agg(hit.alias("succeeded"), n.alias("total"), share.alias("success_ratio"),
                               (share >= minimum).alias("passed"))


def require_success(df: DataFrame, ok, minimum: float = 0.90) -> float:
    """Raise when the share of successful rows is below ``minimum``."""
    got = success_ratio(df, ok, minimum=minimum).first()
    if not got["passed"]:
        raise ValueError(f"coverage {got['succeeded']}/{got['total']} ({got['success_ratio']:.2%}) below {minimum:.2%}")
    return got["success_ratio"]


# --- materialisation --------------------------------------------------------------

def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows whose key is not in ``new``, plus ``new`` (schema may have grown)."""
    kept = old.join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def materialize(df: DataFrame, name: str, mode: str, path: str | None = None, keys: list[str] = (),
                partition: str | None = None, cluster: tuple[str, ...] = (), buckets: int = BUCKETS) -> DataFrame:
    """Store a model: ``view``, ``table``, ``append`` or ``delete_insert``.

    ``delete_insert`` overwrites the partitions that receive rows (or the whole
    table), see ``hazeframe.sources.tables``; the key must determine the
    partition.  Columns that the old or the new rows lack are null there.
    ``cluster`` buckets and sorts the rows of a table.
    """
    if mode == "view":
        df.createOrReplaceTempView(name)
        return df
    table = StoredTable(df.sparkSession, path, partition, cluster, buckets)
    if mode == "delete_insert":
        touched = partition_values(df, partition)
        old = table.rows(touched)
        table.replace_partitions(df if old is None else upsert(old, df, list(keys)), touched)
    elif mode == "table":
        table.replace_all(df)
    elif mode == "append":
        table.append(df)
    else:
        raise ValueError(f"unknown mode {mode}")
    return table.rows()


# --- backfill -----------------------------------------------------------------------

TRAFFIC_KEYS = ["ward_code", "timestamp_utc", "traffic_source"]
#: What a row must carry to be of the current shape.
CURRENT_COLUMNS = ("ward_code", "traffic_source")


def lacking(columns, wanted=CURRENT_COLUMNS) -> list[str]:
    """The wanted columns that are absent."""
    return [c for c in wanted if c not in set(columns)]


def normalise_traffic(df: DataFrame, enrich) -> tuple[DataFrame, DataFrame]:
    """Any traffic shape -> (target-shaped rows, quarantined rows).

    ``enrich(df)`` maps located rows to ward metadata.  Legacy rows always get
    it; current rows only when ward metadata is missing.
    """
    admin = ["ward_code", "ward_name", "province_name", "nearest_highway_type", "distance_to_road_km"]
    legacy = bool(lacking(df.columns))
    defaults = {"source": "tomtom", "confidence": 0.0, "current_speed": 0.0, "free_flow_speed": 0.0,
                "current_travel_time": 0, "free_flow_travel_time": 0, "raw_payload": "", "ingest_batch_id": ""}
    for name, default in defaults.items():
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default))
    missing_kind = F.lit("legacy_backfill") if legacy else F.coalesce("traffic_source", F.lit("api"))
    df = df.withColumns({"traffic_source": missing_kind,
                         "road_closure": F.coalesce(F.col("road_closure").cast("int"), F.lit(0))
                         if "road_closure" in df.columns else F.lit(0)})
    if legacy:
        todo, done = df.drop(*admin), None
    else:
        gap = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in admin])
        todo, done = df.filter(gap).drop(*admin), df.filter(~gap)
    mapped, quarantine = enrich(todo)
    quarantine = quarantine.withColumn("source_stage", F.lit("legacy_transform" if legacy else "current_enrichment"))
    rows = mapped if done is None else done.unionByName(mapped, allowMissingColumns=True)
    rows = rows.withColumns({
        "nearest_highway_type": F.coalesce("nearest_highway_type", F.lit("unknown")),
        "distance_to_road_km": F.coalesce("distance_to_road_km", F.lit(0.0))})
    rows = rows.filter(F.coalesce("ward_code", F.lit("")) != "")
    return keep_last(rows, TRAFFIC_KEYS, "ingest_time", ["raw_payload"]), quarantine


def time_slices(start: datetime, end: datetime, step: timedelta) -> list[tuple[datetime, datetime]]:
    out = []
    while start < end:
        out.append((start, min(start + step, end)))
        start = out[-1][1]
    return out


def backfill(df: DataFrame, enrich, step: timedelta, target: str, quarantine: str,
             start: datetime | None = None, end: datetime | None = None) -> None:
    """Rebuild slice by slice of ingest time; each slice overwrites only its own folder,
    so a rerun after a failure repeats slices without duplicating rows.

    Without bounds the slices cover the whole input.  A key may come in several
    slices: read the result with ``backfilled``.  Rows without an ingest time
    belong to no slice and are quarantined, see ``quarantined``.
    """
    (df.filter(F.col("ingest_time").isNull()).withColumns({"quarantine_reason": F.lit("missing_ingest_time"), "source_stage": F.lit("slicing")})
     .write.mode("overwrite").parquet(f"{quarantine}/slice=none"))
    if start is None or end is None:
        low, high = df.agg(F.min("ingest_time"), F.max("ingest_time")).first()
        if low is None:
            return
        start, end = start or low, end or high + timedelta(microseconds=1)
    for lo, hi in time_slices(start, end, step):
        part = df.filter((F.col("ingest_time") >= F.lit(lo)) & (F.col("ingest_time") < F.lit(hi)))
        good, bad = normalise_traffic(part, enrich)
        tag = f"slice={lo:%Y%m%dT%H%M%S%f}"
        good.write.mode("overwrite").parquet(f"{target}/{tag}")
        bad.write.mode("overwrite").parquet(f"{quarantine}/{tag}")


def backfilled(spark: SparkSession, target: str) -> DataFrame:
    """All slices, with the last row of a key that several slices hold."""
    return keep_last(spark.read.option("mergeSchema", True).parquet(target).drop("slice"), TRAFFIC_KEYS, "ingest_time", ["raw_payload"])


def quarantined(spark: SparkSession, quarantine: str) -> DataFrame:
    """What a backfill could not place, with ``quarantine_reason`` and ``source_stage``."""
    return spark.read.option("mergeSchema", True).parquet(quarantine).drop("slice")


def replay_delta(df: DataFrame, enrich, watermark: datetime) -> tuple[DataFrame, DataFrame]:
    """Rows that arrived since the backfill began, in target shape."""
    return normalise_traffic(df.filter(F.col("ingest_time") >= F.lit(watermark)), enrich)


def reconcile_counts(before: DataFrame, after: DataFrame, ts: str = "ingest_time") -> DataFrame:
    """Row counts per ingest day on both sides and whether they agree."""
    def per_day(df, name):
        return df.groupBy(F.to_date(ts).alias("ingest_date")).agg(F.count(F.lit(1)).alias(name))
    zero = F.lit(0).cast("bigint")
    return (per_day(before, "rows_before").join(per_day(after, "rows_after"), "ingest_date", "full")
            .select("ingest_date", F.coalesce("rows_before", zero).alias("rows_before"),
                    F.coalesce("rows_after", zero).alias("rows_after"))
            .withColumn("matches", F.col("rows_before") == F.col("rows_after")))
