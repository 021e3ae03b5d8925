"""Top-k, ranking, exact order statistics and matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.operators.dedup import limit_by
from hazeframe.session import stored


def top_n(df: DataFrame, keys: list[str], aggregate, n: int, alias: str, ascending: bool = False) -> DataFrame:
    """Largest (or smallest) n groups by an aggregate; ties by key."""
    order = F.col(alias).asc() if ascending else F.col(alias).desc()
    return df.groupBy(*keys).agg(aggregate.alias(alias)).orderBy(order, *keys).limit(n)


def dominant(df: DataFrame, keys: list[str], value: str, count_name: str = "n") -> DataFrame:
    """Most frequent value per key (smallest on ties), safe for wide domains.

    Counts first, so what is ranked is one row per distinct value.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(count_name))
    return limit_by(counts, keys, [F.desc(count_name), F.col(value).asc()], 1)


def arg_rows(df: DataFrame, by: str, tiebreak: list[str]) -> DataFrame:
    """Whole rows at the maximum and the minimum of a column."""
    row = F.struct(*df.columns)
    order = F.struct(by, *tiebreak)
    filled = df.filter(F.col(by).isNotNull())
    return (filled.agg(F.array(F.struct(F.lit("max").alias("kind"), F.max_by(row, order).alias("row")),
                               F.struct(F.lit("min").alias("kind"), F.min_by(row, order).alias("row"))).alias("a"))
            .select(F.explode("a").alias("e")).select("e.kind", "e.row.*"))


def top_groups_matrix(df: DataFrame, group: str, column: str, value: str, k: int, columns: list) -> DataFrame:
    """Rows of the k groups with the largest total, pivoted to group x column."""
    leaders = top_n(df, [group], F.sum(value), k, "_total").select(group)
    return df.join(leaders, group, "left_semi").groupBy(group).pivot(column, columns).agg(F.sum(value))


def rank_desc(df: DataFrame, **ranks: str) -> DataFrame:
    """Global ``rank()`` columns, name=metric, highest first.

    The window has no partition, so use it on rows already reduced to a bounded
    set of groups (provinces); ``rank_large`` has no such limit.
    """
    return df.withColumns({name: F.rank().over(Window.orderBy(F.desc(metric))) for name, metric in ranks.items()})


def rank_large(df: DataFrame, metric: str, alias: str = "rank", buckets: int = 256) -> DataFrame:
    """Global descending ``rank()`` without a single-task window.

    Value ranges come from approximate quantiles (only a balance hint: any cut
    points give exact ranks).  Rows are counted per distinct value, ranked
    inside their range, and offset by the counts of the higher ranges.  Rows of
    a value that more than 1/``buckets`` of all rows have (there are fewer than
    ``buckets`` such values) are dealt to ``buckets`` keys of the last join.
    """
    cuts = sorted(set(df.approxQuantile(metric, [i / buckets for i in range(1, buckets)], 0.01)))
    bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(metric))) if cuts else F.lit(0)
    counts = df.groupBy(metric).agg(F.count(F.lit(1)).alias("_n")).withColumn("_b", bucket)
    totals = counts.groupBy("_b").agg(F.sum("_n").alias("_t"))  # at most ``buckets`` rows
    above = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_b", F.coalesce(F.sum("_t").over(above), F.lit(0)).alias("_off"), F.sum("_t").over(Window.partitionBy()).alias("_all"))
    inside = Window.partitionBy("_b").orderBy(F.desc(metric)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (counts.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
             .join(F.broadcast(offsets), "_b")
             .select(F.col(metric).alias("_m"), (F.col("_in") + F.col("_off") + 1).alias(alias), (F.col("_n") * buckets > F.col("_all")).alias("_hot")))
    hot = ranks.filter("_hot").select(F.col("_m").alias("_hm"), "_hot")
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*df.columns), F.lit(buckets))).otherwise(F.lit(0).cast("bigint"))
    salted = df.join(F.broadcast(hot), F.col(metric).eqNullSafe(F.col("_hm")), "left").withColumn("_salt", salt).drop("_hm", "_hot")
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(F.col("_hot"), F.lit(buckets - 1)).otherwise(F.lit(0)).cast("bigint")))
    ranks = ranks.select("_m", alias, salts.alias("_s"))
    return salted.join(ranks, F.col(metric).eqNullSafe(F.col("_m")) & (F.col("_salt") == F.col("_s"))).drop("_m", "_s", "_salt")


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float],
                    accuracy: int = 10000, most_distinct: int = 1_000_000) -> DataFrame:
    """Element at 0-based index floor(p*n) of each group's sorted values, exactly.

    Values are counted first, so a frequent value is one row.  A bracket of
    more than ``most_distinct`` distinct values is cut into ranges by a
    mergeable sketch (any cut points give exact results), the ranges are
    counted, and the one that holds the target is the next bracket.  Only the
    last bracket is ordered.  Returns keys, p, quantile.
    """
    if not keys:
        whole = exact_quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, probabilities, accuracy, most_distinct)
        return whole.drop("_all")
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    wanted = F.array(*[F.lit(float(p)) for p in sorted(set(probabilities))])
    brackets = stored(counted.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_d"))
                      .withColumn("p", F.explode(wanted))
                      .select(*keys, "p", F.least(F.floor(F.col("p") * F.col("_n")), F.col("_n") - 1).alias("_target"), "_lo", "_hi", "_d"), "quantile-brackets")
    wide = F.col("_d") > most_distinct
    while not brackets.filter(wide).isEmpty():
        brackets = stored(brackets.filter(~wide).unionByName(_narrowed(counted, brackets.filter(wide), keys, accuracy)), "quantile-brackets")
    w = Window.partitionBy(*keys, "p").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    return (_inside(counted, brackets, keys).withColumn("_cum", F.sum("_c").over(w)).filter(F.col("_cum") > F.col("_target"))
            .groupBy(*keys, "p").agg(F.min("_v").alias("quantile")))


def _inside(counted: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    return counted.join(brackets, keys).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _narrowed(counted: DataFrame, brackets: DataFrame, keys: list[str], accuracy: int, ranges: int = 64) -> DataFrame:
    """The range of each bracket that holds its target."""
    group = [*keys, "p"]
    inside = _inside(counted, brackets, keys)
    cuts = inside.groupBy(*group).agg(F.percentile_approx("_v", [i / ranges for i in range(1, ranges)], accuracy).alias("_cuts"))
    place = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    parts = inside.join(cuts, group).groupBy(*group, "_target", place.alias("_place")).agg(
        F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_d"))
    before = Window.partitionBy(*group).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)  # ``ranges`` rows at most
    left = F.col("_target") - F.coalesce(F.sum("_n").over(before), F.lit(0))
    return parts.withColumn("_left", left).filter((F.col("_left") >= 0) & (F.col("_left") < F.col("_n"))).select(
        *group, F.col("_left").alias("_target"), "_lo", "_hi", "_d")


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, long form, one aggregate pass."""
    pairs = [(a, b) for a in columns for b in columns]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs])
    return row.select(F.explode(cells).alias("c")).select("c.*")


def ols(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares line through the non-NULL pairs."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.regr_count(y, x).alias("n"), F.corr(y, x).alias("r"))
