"""Running sums and lookups that no single key can hold up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hazeframe.llm.tables import stored, tasks

#: A key that more than one in this many rows has counts as hot; there are at most this many such keys.
HOT_SHARE = 500


def running_sums(rows: DataFrame, key: str, order: list, values: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``before_<v>`` for each of ``values``: its sum over the earlier rows of the same key.

    The rows are dealt by range of key and order, so a key with a third of all
    rows lies in many parts.  Sums run within the parts; a part goes on from
    earlier ones for its first key only, so there are fewer offsets than parts
    and they are broadcast.  Rows equal in key and order may come in any order.
    ``rows`` must not have a column ``part``.
    """
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(tasks(spark), key, *order).withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, purpose)
    ends = dealt.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    across = ends.select("part", F.col("low").alias(key)).unionByName(ends.select("part", F.col("high").alias(key))).distinct()
    sums = dealt.join(F.broadcast(across), ["part", key], "left_semi").groupBy("part", key).agg(*[F.sum(v).alias(f"of_{v}") for v in values])
    earlier = W.partitionBy(key).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("part", key, *[F.sum(f"of_{v}").over(earlier).alias(f"offset_{v}") for v in values]).filter(f"offset_{values[0]} is not null")
    within = W.partitionBy("part", key).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = dealt.select("*", *[F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"within_{v}") for v in values])
    out = out.join(F.broadcast(offsets), ["part", key], "left")
    return out.select(*rows.columns, *[(F.col(f"within_{v}") + F.coalesce(f"offset_{v}", F.lit(0))).alias(f"before_{v}") for v in values])


def look_up(rows: DataFrame, table: DataFrame, keys: list[str], counts: DataFrame, total: int, purpose: str) -> DataFrame:
    """Left join of ``rows`` to ``table``, which has every key once.

    ``counts`` (keys and ``n``) says how many rows share a key.  Keys that more
    than ``total / HOT_SHARE`` rows share are at most ``HOT_SHARE``; their rows
    are matched by broadcast, all others by a shuffle without a hot key.
    """
    hot = stored(counts.filter(F.col("n") * HOT_SHARE > total).select(*keys), purpose)
    if hot.isEmpty():
        return rows.join(table, keys, "left")
    here = F.broadcast(table.join(F.broadcast(hot), keys, "left_semi"))
    often = rows.join(F.broadcast(hot), keys, "left_semi").join(here, keys, "left")
    return often.unionByName(rows.join(F.broadcast(hot), keys, "left_anti").join(table, keys, "left"))
