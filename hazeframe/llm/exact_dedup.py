"""Exact deduplication that survives a group holding a third of all rows.

Three combining steps, each grouping by digest *and* full content: every task
merges the equal texts it has read (map-side combine), the partial groups meet
per digest and salt, and the winners of the salts meet per digest.  A hot text
therefore reaches no task more than once per salt and map task.  The verdicts
go back to the rows by digest alone, those of hot digests by broadcast; should
two different texts ever share a digest, its rows are matched by content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.llm.tables import hot_keys, join_spread, nested, stored, text_or_empty


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per distinct text: ``digest, text, keep_id, group_size``.

    Null text counts as empty; the largest id stays (null only where all are null).
    """
    salted = (_rows(docs, id_col, text_col)
              .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
              .groupBy("digest", "text", "salt").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    return salted.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every input row.

    Other columns of the input are ignored, whatever their names.  Rows that
    repeat both id and text are one document and share one verdict; a null id
    is kept only where its whole group has none.  A text of any length is compared
    whole.  An empty table gives no rows.
    """
    groups = stored(exact_groups(docs, id_col, text_col, salts).groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count("*").alias("variants")), "exact-groups")
    rows = _rows(docs, id_col, text_col)
    total = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    out = join_spread(rows.drop("text"), groups, hot_keys(groups, "group_size", total), "digest", "doc_id")
    clashing = groups.filter("variants > 1").select("digest")
    if not clashing.isEmpty():
        odd = rows.join(clashing, "digest", "left_semi")
        by_text = odd.join(exact_groups(odd, "doc_id", "text", salts), ["digest", "text"]).select("digest", "doc_id", "keep_id", "group_size")
        out = out.filter("variants = 1").select("digest", "doc_id", "keep_id", "group_size").unionByName(by_text)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))


def keep_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns and one row per kept id and text."""
    verdicts = exact_dedup(docs, id_col, text_col, salts).filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha")).distinct()
    rows = nested(docs, doc_id=F.col(f"`{id_col}`").cast("long"), sha=F.sha2(text_or_empty(text_col), 256))
    return rows.join(verdicts, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("kept_sha")), "left_semi").select("row.*")
