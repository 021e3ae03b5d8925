"""Session and shared-folder helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_BASE: dict[str, str] = {}
#: Folders filled by ``stored`` within each open ``scratch``, the innermost last.
_SCRATCH: list[list[str]] = []


def local_session(cores: str = "*", name: str = "hazeframe", shared: str | None = None) -> SparkSession:
    """Local session for tests and the benchmark; clusters bring their own."""
    return (SparkSession.builder.master(f"local[{cores}]").appName(name)
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.driver.memory", "12g")
            .config("spark.ui.enabled", "false")
            .config("spark.checkpoint.dir", shared or tempfile.mkdtemp(prefix="hazeframe-"))
            .getOrCreate())


def shared_base(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset, a session whose only process is this one (``local[n]``)
    gets a temporary folder; any other session is refused, since its executors
    could not read what others wrote.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_BASE:
        _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="hazeframe-")
    return _LOCAL_BASE[app]


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for one purpose below the shared one."""
    return f"{shared_base(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def freeing_shuffles(spark: SparkSession):
    """Jobs that write in this context leave no shuffle files.

    Spark removes them when the job has ended, not when the driver happens to
    collect its garbage: of many steps in a row only one is on disk.
    """
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once into a new shared folder and read it back: its size is known then and its lineage cut.

    A lost executor costs the readers nothing but a re-read.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, purpose)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    with freeing_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """What ``stored`` writes in this context is removed at its end, but for what goes through the function it yields."""
    paths: list[str] = []
    _SCRATCH.append(paths)

    def keep(df: DataFrame, purpose: str) -> DataFrame:
        out = stored(df, purpose)
        path = paths.pop()
        if len(_SCRATCH) > 1:
            _SCRATCH[-2].append(path)
        return out
    try:
        yield keep
    finally:
        _SCRATCH.pop()
        for path in paths:
            remove_folder(spark, path)
