"""Mixing sources to target weights along a time-varying curriculum.

Targets share the whole corpus by weight, capped at a multiple of each source.
Every source has a weight schedule over training time; its integral is the
cumulative demand, whose inverse turns the running word count of a document
into a training position.  Documents are then range-sorted by position.

Running sums are taken in two levels (hash bucket, then rows of a bucket), so a
source with a third of all rows is spread over as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hazeframe.llm.tables import WORD, nested, stored, tasks, text_or_empty

#: (time, relative weight) knots, dealt to the sources in turn: rising, level, falling.
SCHEDULES = (((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """One row per source: ``source, rank, source_size, target``.

    Targets are ``min(cap * size, level * weight)``; the level at which they add
    up to all sizes is the largest of the levels left over after capping the
    first k sources in order of ``cap * size / weight``.
    """
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    ranked = (own.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", weight)
              .withColumn("most", F.lit(cap) * F.col("source_size")))
    before = W.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(W.unboundedPreceding, -1)
    everywhere = W.partitionBy()
    left = F.sum("source_size").over(everywhere) - F.coalesce(F.sum("most").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = ranked.withColumn("level", left.cast("double") / open_weight.cast("double"))
    level = F.max("level").over(everywhere)
    return levels.select("source", "rank", "source_size", F.least(F.col("most").cast("double"), level * F.col("weight")).alias("target"))


def _position(share: Column, rank: Column, schedules) -> Column:
    """Time at which the integrated schedule has spent ``share`` of its demand."""
    pieces = []
    for knots in schedules:
        parts, spent = [], 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            area = (w0 + w1) / 2 * (t1 - t0)
            parts.append((t0, w0, (w1 - w0) / (t1 - t0), spent, spent + area))
            spent += area
        done = None
        for t0, w0, slope, low, high in reversed(parts):
            need = F.greatest(share * F.lit(spent) - F.lit(low), F.lit(0.0))
            at = F.lit(t0) + 2 * need / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * F.lit(slope) * need, F.lit(0.0))))
            done = at if done is None else F.when(share * F.lit(spent) <= F.lit(high), at).otherwise(done)
        pieces.append(done)
    turn = F.pmod(rank, F.lit(len(schedules)))
    out = pieces[0]
    for k, piece in enumerate(pieces[1:], 1):
        out = F.when(turn == k, piece).otherwise(out)
    return F.least(out, F.lit(1.0))


def _copy_position(copy: Column, schedules) -> Column:
    """Time of a document's copy number ``copy`` (from 0); a source's passes follow each other along its demand."""
    share = F.least((copy * F.col("source_size") + F.col("start") + F.col("size") / 2) / F.col("target"), F.lit(1.0))
    return _position(F.when(F.col("target") > 0, share).otherwise(0.0), F.col("rank"), schedules)


def _mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, bucket_digits: int = 3) -> DataFrame:
    """The rows of ``mix`` in no order, with their source's ``rank`` and the words ``start`` before them in a pass."""
    doc_id, key = F.col(f"`{id_col}`").cast("long"), F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    sizes = stored(docs.select(doc_id.alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                               F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"),
                               key.alias("key")).withColumn("bucket", F.substring("key", 1, bucket_digits)), "mix-sizes")
    targets = source_targets(sizes, weights, cap)
    of_source = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (sizes.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
               .withColumn("offset", F.coalesce(F.sum("in_bucket").over(of_source), F.lit(0)))
               .withColumnsRenamed({"source": "o_source", "bucket": "o_bucket"}).drop("in_bucket"))
    within = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = (sizes.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
              .join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket")))
              .join(targets.withColumnRenamed("source", "t_source"), F.col("source").eqNullSafe(F.col("t_source")))
              .withColumn("start", F.col("offset") + F.col("before")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    taken = (placed.withColumn("whole", whole)
             .withColumn("copies", F.col("whole") + F.when((F.col("size") > 0) & (F.col("start") + F.col("size") / 2 <= rest), 1).otherwise(0))
             .withColumn("taken", F.col("copies") * F.col("size")))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "start", "rank")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, schedules=SCHEDULES, bucket_digits: int = 3) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source, copies, first_position``, range-sorted by position.

    ``size`` counts the words of the whole text (null: 0).  A source gives
    ``floor(target / size)`` whole passes and, of its documents in a fixed
    hashed order, those whose middle lies within the rest of the target, so it
    misses the target by half a document at most; no document is cut.  Ids
    order ties, so reruns agree.  Repeated rows are documents of their own.
    Rows that are not taken have no position.  Null sources form one source;
    empty texts never add words.  Other input columns are ignored.
    """
    first = F.when(F.col("copies") > 0, _copy_position(F.lit(0), schedules))
    out = _mixed(docs, id_col, text_col, source_col, weights, cap, bucket_digits).withColumn("first_position", first)
    spread = F.coalesce(F.col("first_position"), 1 + F.col("start") / F.greatest(F.col("source_size"), F.lit(1)))
    return (out.repartitionByRange(tasks(docs.sparkSession), spread, F.col("doc_id")).sortWithinPartitions(spread, "doc_id")
            .drop("start", "rank"))


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", schedules=SCHEDULES,
                   with_position: bool = False, **how) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their own columns.

    ``with_position`` adds ``position`` and ``copy`` (from 0), which keep the
    order for whoever stores the rows; columns of these names in ``docs`` are
    replaced then.  An empty table gives no rows; texts of any length are
    counted whole.  Each copy of a document has its own position: the second pass over a source
    comes after its first.  Rows that share id, source and size (repeated rows,
    rows without an id) share the copies that the mix takes of them evenly and
    in turn, the first by digest of their text taking what is left over, so the
    words add up to those of ``mix``.
    """
    key, placing = ["c_id", "c_source", "c_size"], ["source_size", "target", "start", "rank", "copies"]
    taken = stored(_mixed(docs, id_col, text_col, source_col, **how), "mix-taken")
    chosen = stored(taken.groupBy(F.col("doc_id").alias("c_id"), F.col("source").alias("c_source"), F.col("size").alias("c_size"))
                    .agg(*[F.min(c).alias(c) for c in placing[:-1]], F.sum("copies").alias("copies"), F.count("*").alias("sharing"))
                    .filter("copies > 0"), "mix-chosen")
    text = text_or_empty(text_col)
    rows = nested(docs, doc_id=F.col(f"`{id_col}`").cast("long"), source=F.col(f"`{source_col}`").cast("string"),
                  size=F.regexp_count(text, F.lit(WORD)).cast("long"), digest=F.sha2(text, 256))

    def match(side: str) -> Column:
        return F.col("doc_id").eqNullSafe(F.col(f"{side}_id")) & F.col("source").eqNullSafe(F.col(f"{side}_source")) & (F.col("size") == F.col(f"{side}_size"))
    each = F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1)).alias("copy")
    columns = ("row", _copy_position(F.col("copy"), schedules).alias("at"), "doc_id", "copy")
    out = rows.join(chosen.filter("sharing = 1"), match("c")).select("row", "doc_id", "size", *placing, each).select(*columns)
    shared = chosen.filter("sharing > 1").select(*key, "sharing")
    if not shared.isEmpty():
        places = taken.filter("copies > 0").join(shared, match("c")).select(*key, "sharing", *placing, each)
        number = F.row_number().over(W.partitionBy(*key).orderBy("copy", "start")) - 1
        places = places.withColumn("p_turn", number % F.col("sharing")).drop("sharing").withColumnsRenamed({c: f"p{c[1:]}" for c in key})
        turn = F.row_number().over(W.partitionBy(*key).orderBy("digest")) - 1
        sharers = rows.join(shared, match("c")).withColumn("turn", turn)
        out = out.unionByName(sharers.join(places, match("p") & (F.col("turn") == F.col("p_turn"))).select(*columns))
    out = out.repartitionByRange(tasks(docs.sparkSession), "at", "doc_id").sortWithinPartitions("at", "doc_id", "copy")
    if not with_position:
        return out.select("row.*")
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in ("position", "copy")]
    return out.select(*own, F.col("at").alias("position"), "copy")
