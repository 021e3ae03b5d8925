"""Roll-ups kept up to date by differences: what a replaced or withdrawn reading had added is taken out again.

A batch of readings is compared with the stored ones once.  What it changes goes
to every level as a difference of sum and count; a maximum or minimum that was
taken out is looked up again, for the groups that lost it only, in the level
below.  Sums are decimals, so any number of differences gives the figures of a
rebuild (mean values to 15 digits after the point).

Changes are staged before anything else and every stored group carries the batch
that changed it last, so a batch that died at any point is simply applied again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.functions import times
from hazeframe.session import stored
from hazeframe.sources.tables import StoredTable, partition_values

#: 15 digits after the point are kept in sums; values of 1e15 or more do not fit, a sum of 1e23 or more raises.
VALUE, SUM = "decimal(30,15)", "decimal(38,15)"
MOST = 1e15
PART = "stored_part"
#: Level -> (time of its groups, partition it is stored by).
LEVELS = {
    "hour": (times.hour_of, F.to_date),
    "day": (F.to_date, times.month_of),
    "month": (times.month_of, F.year),
}


def newest_readings(batch: DataFrame, keys: list[str], version: str, value: str) -> DataFrame:
    """``keys, version, value``: the newest version of each key; of equal versions the largest value.

    Values that are not finite or do not fit the sums count as withdrawn (null).
    Rows without a key or a version belong nowhere and are left out.
    """
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, version]])
    number = F.col(value).cast("double")
    usable = F.when(F.abs(number) < MOST, number)  # NaN is above all numbers
    best = F.max(F.struct(F.col(version).alias("version"), usable.alias("value")))
    return batch.filter(whole).groupBy(*keys).agg(best.alias("best")).select(*keys, "best.version", "best.value")


def changed_readings(current: DataFrame | None, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, version, value, old_value`` of the readings that ``batch`` (newest versions) adds, replaces or withdraws."""
    now = F.struct("version", "value")
    if current is None:
        return batch.withColumn("old_value", F.lit(None).cast("double"))
    before = current.select(*keys, now.alias("before"))
    both = batch.join(before, keys, "left").filter(F.col("before").isNull() | (now > F.col("before")))
    return both.select(*keys, "version", "value", F.col("before.value").alias("old_value"))


def differences(changes: DataFrame, group: list[Column]) -> DataFrame:
    """Per group, what the changes add to count and sum, and the extremes that came and went."""
    def exact(c: str) -> Column:
        return F.coalesce(F.col(c).cast(VALUE), F.lit(0).cast(VALUE))
    count = F.col("value").isNotNull().cast("long") - F.col("old_value").isNotNull().cast("long")
    return changes.groupBy(*group).agg(
        F.sum(count).alias("d_n"), F.sum((exact("value") - exact("old_value")).cast(SUM)).cast(SUM).alias("d_sum"),
        F.max("value").alias("came_max"), F.min("value").alias("came_min"), F.max("old_value").alias("went_max"), F.min("old_value").alias("went_min"))


class DeltaRollup:
    """Readings and their hours, days and months below ``base``.

    ``keys`` name a reading beside its time; ``group`` (some of them) name the
    groups of every level.  Hours are stored by date, days by month, months by
    year: a batch reads and writes the partitions that its changes touch.
    """

    def __init__(self, spark: SparkSession, base: str, keys: list[str], group: list[str], time: str = "timestamp_utc",
                 version: str = "version", value: str = "value"):
        self.spark, self.base = spark, base.rstrip("/")
        self.keys, self.group, self.time, self.version, self.value = [*keys, time], list(group), time, version, value

    def _table(self, name: str) -> StoredTable:
        return StoredTable(self.spark, f"{self.base}/{name}", PART)

    def level(self, name: str) -> DataFrame | None:
        """``group, at, n, value_sum, avg_value, max_value, min_value`` of a level; None before its first batch."""
        rows = self._table(name).rows()
        if rows is None:
            return None
        mean = (F.col("value_sum").cast("double") / F.col("n")).alias("avg_value")
        return rows.filter("n > 0").select(*self.group, "at", "n", "value_sum", mean, "max_value", "min_value")

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Bring every level up to date with ``batch``.

        Batch ids rise.  A batch that has been applied before, whole or in part,
        is finished from its staged changes; one without news changes nothing.
        """
        changes = self._changes(batch, batch_id)
        days = partition_values(changes.select(F.to_date(self.time).alias(PART)), PART)  # a value per touched day
        if not days:
            return
        self._keep_readings(changes, days)
        below = self._table("readings").rows(days).filter("value is not null").select(
            *self.group, F.col(self.time).alias("at"), F.col("value").alias("max_value"), F.col("value").alias("min_value"))
        for name in LEVELS:
            parts = self._update(name, changes, below, batch_id)
            below = self._table(name).rows(parts).filter("n > 0").select(*self.group, "at", "max_value", "min_value")

    # --- steps -------------------------------------------------------------------------

    def _changes(self, batch: DataFrame, batch_id: int) -> DataFrame:
        path = f"{self.base}/changes/batch={batch_id}"
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            fresh = newest_readings(batch, self.keys, self.version, self.value)
            days = partition_values(fresh.select(F.to_date(self.time).alias(PART)), PART)
            changed_readings(self._table("readings").rows(days), fresh, self.keys).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def _keep_readings(self, changes: DataFrame, days: list) -> None:
        table = self._table("readings")
        fresh = changes.drop("old_value").withColumn(PART, F.to_date(self.time))
        old = table.rows(days)
        table.replace_partitions(fresh if old is None else old.join(fresh.select(*self.keys), self.keys, "left_anti").unionByName(fresh), days)

    def _update(self, name: str, changes: DataFrame, below: DataFrame, batch_id: int) -> list:
        """Add the differences to a level; returns its touched partitions."""
        at, part = LEVELS[name]
        by = [*self.group, "at"]
        delta = differences(changes, [*[F.col(c) for c in self.group], at(self.time).alias("at")])
        parts = partition_values(delta.select(part("at").alias(PART)), PART)
        table = self._table(name)
        old = table.rows(parts)
        if old is None:
            old = delta.limit(0).select(*by, F.lit(0).cast("long").alias("n"), F.lit(0).cast(SUM).alias("value_sum"), F.col("came_max").alias("max_value"),
                                        F.col("came_min").alias("min_value"), F.lit(0).cast("long").alias("batch"))
        joined = old.drop(PART).join(delta, by, "full")
        due = F.col("d_n").isNotNull() & (F.coalesce("batch", F.lit(-1)) < batch_id)
        lost_max = (F.col("went_max") >= F.col("max_value")) & (F.coalesce("came_max", F.lit(float("-inf"))) < F.col("max_value"))
        lost_min = (F.col("went_min") <= F.col("min_value")) & (F.coalesce("came_min", F.lit(float("inf"))) > F.col("min_value"))
        added = [(F.coalesce("n", F.lit(0)) + F.col("d_n")).alias("n"), (F.coalesce("value_sum", F.lit(0).cast(SUM)) + F.col("d_sum")).cast(SUM).alias("value_sum"),
                 F.greatest("max_value", "came_max").alias("max_value"), F.least("min_value", "came_min").alias("min_value"),
                 F.lit(batch_id).cast("long").alias("batch"), F.coalesce(lost_max | lost_min, F.lit(False)).alias("lost")]
        same = [F.col(c) for c in ("n", "value_sum", "max_value", "min_value", "batch")] + [F.lit(False).alias("lost")]
        fresh = stored(joined.withColumn("now", F.when(due, F.struct(*added)).otherwise(F.struct(*same))).select(*by, "now.*"), f"delta-{name}")
        again = below.withColumn("at", at("at")).join(fresh.filter("lost").select(*by), by, "left_semi")
        again = again.groupBy(*by).agg(F.max("max_value").alias("true_max"), F.min("min_value").alias("true_min"))
        rows = fresh.join(again, by, "left").select(
            *by, "n", "value_sum", F.when(F.col("lost"), F.col("true_max")).otherwise(F.col("max_value")).alias("max_value"),
            F.when(F.col("lost"), F.col("true_min")).otherwise(F.col("min_value")).alias("min_value"), "batch", part("at").alias(PART))
        table.replace_partitions(rows, parts)
        return parts
