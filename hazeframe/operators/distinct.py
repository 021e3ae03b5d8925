"""Exact distinct counts that merge: bitmaps over dense numbers.

A dictionary gives every key a number from 1 on, in blocks of 32,768.  Per group
and block one bitmap of 4 KiB says which numbers occur.  Bitmaps of hours merge
to days, months and the nation by OR, so a distinct count at any grain reads the
stored bitmaps and not the rows, and no plan multiplies rows as a distinct count
of several columns does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.session import stored


def number_keys(keys: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """``<column>, number``: the known numbers, and the next ones for keys that have none yet.

    Numbers never change once given, so stored bitmaps stay valid.  New keys are
    dealt by range and counted per part; null keys get no number.
    """
    new, last = keys.select(column).filter(F.col(column).isNotNull()).distinct(), 0
    if known is not None:
        new, last = new.join(known.select(column), column, "left_anti"), known.agg(F.max("number")).first()[0] or 0
    parts = int(new.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(new.repartitionByRange(parts, column).withColumn("_part", F.spark_partition_id()), "numbered-keys")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    offsets = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.lit(last)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    fresh = dealt.withColumn("_place", place).join(F.broadcast(offsets), "_part").select(column, (F.col("_place") + F.col("_before")).cast("long").alias("number"))
    return fresh if known is None else known.select(column, "number").unionByName(fresh)


def day_number(date) -> Column:
    """A number from 1 on for every date since 1970."""
    return F.unix_date(date).cast("long") + 1


def distinct_bitmaps(df: DataFrame, by: list[str], number, name: str = "bits") -> DataFrame:
    """``by, block, <name>``: which numbers occur per group; rows without a number set no bit.

    Numbers are made distinct and meet as numbers, at most 32,768 per block; half-filled bitmaps are never shuffled.
    """
    n = F.col(number) if isinstance(number, str) else number
    numbers = df.withColumn("_number", n).filter("_number is not null").select(*by, "_number").distinct()
    return (numbers.withColumn("block", F.bitmap_bucket_number("_number")).repartition(*by, "block").groupBy(*by, "block")
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias(name)))


def merge_bitmaps(bitmaps: DataFrame, by: list[str], name: str = "bits") -> DataFrame:
    """Bitmaps of a coarser grouping."""
    return bitmaps.groupBy(*by, "block").agg(F.bitmap_or_agg(name).alias(name))


def distinct_counts(bitmaps: DataFrame, by: list[str], alias: str, name: str = "bits") -> DataFrame:
    """Exact number of different keys per group, from bitmaps of that grouping or a finer one."""
    return merge_bitmaps(bitmaps, by, name).groupBy(*by).agg(F.sum(F.bitmap_count(name)).alias(alias))
