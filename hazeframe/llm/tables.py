"""Shared intermediate tables and small column helpers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.session import freeing_shuffles, scratch, stored

__all__ = ["WORD", "freeing_shuffles", "hot_keys", "join_spread", "nested", "scratch", "ship", "stored", "table", "tasks", "text_or_empty"]

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def tasks(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers of this application the package, once, as a zip file."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def nested(docs: DataFrame, **keys: Column) -> DataFrame:
    """``docs`` as one column ``row`` beside computed keys, so that no name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(k) for k, c in keys.items()])


#: A key is hot when it holds more than one in this many rows; so there are never more hot keys than this.
HOT_SHARE = 1000


def hot_keys(verdicts: DataFrame, size: str, total: int) -> DataFrame:
    """The rows of ``verdicts`` (one per key) whose key stands for more than ``total / HOT_SHARE`` rows: fewer than ``HOT_SHARE``."""
    return verdicts.filter(F.col(size) * HOT_SHARE > F.lit(total))


def join_spread(rows: DataFrame, verdicts: DataFrame, hot: DataFrame, key: str, by: str, matches: Column | None = None) -> DataFrame:
    """Left join of ``rows`` with ``verdicts`` (one row per ``key``) in which no key brings all its rows into one task.

    Rows of a ``hot`` key take the verdict from a broadcast of the hot rows, which
    are few by construction; they and the rows that cannot match (null keys,
    ``matches`` false) go through the shuffle under keys spread by the hash of ``by``.
    """
    names = [c for c in verdicts.columns if c != key]
    one = F.struct(*names)
    known = rows.withColumn("_may", F.col(key).isNotNull() & (F.lit(True) if matches is None else matches)).join(
        F.broadcast(hot.select(F.col(key).alias("_hot_key"), one.alias("_hot"))), F.col("_may") & (F.col(key) == F.col("_hot_key")), "left")
    settled = F.col("_hot").isNotNull() | ~F.col("_may")
    # longer than any key it could meet: key, then eight bytes or more of the hash
    spread = F.concat(F.coalesce(F.col(key).cast("binary"), F.lit(b"")), F.lit("/spread/").cast("binary"), F.xxhash64(by).cast("string").cast("binary"))
    cold = verdicts.select(F.col(key).cast("binary").alias("_key"), one.alias("_cold"))
    joined = known.withColumn("_key", F.when(settled, spread).otherwise(F.col(key).cast("binary"))).join(cold, "_key", "left")
    verdict = F.coalesce("_hot", "_cold")
    return joined.select(*rows.columns, *[verdict[n].alias(n) for n in names])
