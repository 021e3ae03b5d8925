"""Hourly station aggregates and keyed upserts as streams."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.functions.times import hour_of
from hazeframe.operators.dedup import final
from hazeframe.operators.incremental import upsert
from hazeframe.sources.tables import StoredTable, partition_values

HOUR_KEYS = ["datetime_hour", "station_id", "source", "pollutant"]


def hourly_partials(rows: DataFrame) -> DataFrame:
    """Mergeable hourly partials; the mean is kept as sum and count."""
    usable = rows.filter(F.col("timestamp_utc").isNotNull() & F.col("value").isNotNull())
    return usable.groupBy(hour_of("timestamp_utc").alias("datetime_hour"), "station_id", "source",
                          F.col("parameter").alias("pollutant")).agg(
        F.sum("value").alias("value_sum"), F.count(F.lit(1)).alias("measurement_count"),
        F.max("value").alias("max_value"), F.min("value").alias("min_value"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Exact hourly figures from any number of partials."""
    return partials.groupBy(*HOUR_KEYS).agg(
        (F.sum("value_sum") / F.sum("measurement_count")).alias("avg_value"),
        F.sum("measurement_count").alias("measurement_count"),
        F.max("max_value").alias("max_value"), F.min("min_value").alias("min_value"))


def run_of(checkpoint: str) -> str:
    """Short name of a stream run, the same for every restart from its checkpoint."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def start_hourly_partials(stream: DataFrame, target: str, checkpoint: str):
    """Every micro-batch adds its partials under ``run=<id>/batch=<id>``.

    The run is named after the checkpoint, since batch ids start again with a
    new one.  A replayed batch overwrites its own folder, so figures stay exact after a
    failure; late rows simply add to their hour; no state is held.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        hourly_partials(batch).write.mode("overwrite").parquet(f"{target}/run={run_of(checkpoint)}/batch={batch_id}")
    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def windowed_hours(stream: DataFrame, late: str = "2 hours") -> DataFrame:
    """The same figures with engine-held state: tumbling hours behind a watermark."""
    return (stream.filter(F.col("value").isNotNull()).withWatermark("timestamp_utc", late)
            .groupBy(F.window("timestamp_utc", "1 hour").alias("w"), "station_id", "source", F.col("parameter").alias("pollutant"))
            .agg(F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("measurement_count"),
                 F.max("value").alias("max_value"), F.min("value").alias("min_value"))
            .select(F.col("w.start").alias("datetime_hour"), "station_id", "source", "pollutant",
                    "avg_value", "measurement_count", "max_value", "min_value"))


def dedup_stream(stream: DataFrame, keys: list[str], ts: str, within: str = "1 day") -> DataFrame:
    """First row per key within the watermark (exact copies of a feed)."""
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark(keys)


def start_upsert(stream: DataFrame, target: str, checkpoint: str, keys: list[str], version: str,
                 partition: str, tiebreak: list[str] = ()):
    """Last writer wins per key.  Only the partitions a batch touches are overwritten
    (``hazeframe.sources.tables``): a crash leaves the old rows or is finished by
    the next batch, and a replay gives the same rows again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table = StoredTable(batch.sparkSession, target, partition)
        new = final(batch, keys, version, list(tiebreak))
        touched = partition_values(new, partition)
        old = table.rows(touched)
        if old is not None:
            new = final(old.unionByName(new, allowMissingColumns=True), keys, version, list(tiebreak))
        table.replace_partitions(new, touched)
    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def recompute_hours(stream: DataFrame, history: str, target: str, checkpoint: str, build, ts: str = "timestamp_utc"):
    """Affected-hour recompute: each batch is appended to ``history`` and every hour it
    touches is rebuilt whole by ``build`` (rows with a ``datetime_hour``) in ``target``.

    Both writes are idempotent per batch: history by batch folder, target by key.
    """
    run = run_of(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        day = F.to_date(ts)
        batch.withColumn("day", day).write.mode("overwrite").partitionBy("day").parquet(f"{history}/run={run}/batch={batch_id}")
        new = spark.read.parquet(f"{history}/run={run}/batch={batch_id}")
        hours = new.select("day", hour_of(ts).alias("_hour")).distinct()  # day prunes partitions
        rows = spark.read.option("mergeSchema", True).parquet(history).withColumn("_hour", hour_of(ts)).join(hours, ["day", "_hour"], "left_semi")
        fresh = build(rows.drop("_hour", "run", "batch", "day")).withColumn("day", F.to_date("datetime_hour"))
        table, touched = StoredTable(spark, target, "day"), partition_values(new, "day")
        old = table.rows(touched)
        table.replace_partitions(fresh if old is None else upsert(old, fresh, ["datetime_hour"]), touched)
    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
