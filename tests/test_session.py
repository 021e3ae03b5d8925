"""Steps that are stored leave neither shuffle files nor, once they are used, folders."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hazeframe import session


def shuffle_bytes(spark):
    folder = Path(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    total = 0
    for f in folder.rglob("shuffle_*"):
        try:
            total += f.stat().st_size
        except FileNotFoundError:
            pass
    return total


def test_a_stored_step_leaves_no_shuffle_files(spark):
    before = shuffle_bytes(spark)
    out = session.stored(spark.range(300_000).repartition(4, F.xxhash64("id")), "shuffled-step")
    for _ in range(50):
        if shuffle_bytes(spark) <= before + 100_000:
            break
        time.sleep(0.2)
    assert shuffle_bytes(spark) <= before + 100_000 and out.count() == 300_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_scratch_keeps_what_it_is_told_to(spark):
    def folder(df):
        return Path(df._jdf.inputFiles()[0].removeprefix("file:")).parent

    with session.scratch(spark) as keep:
        one = session.stored(spark.range(5), "one")
        kept = keep(one.select((F.col("id") + 1).alias("id")), "kept")
        with pytest.raises(ValueError), session.scratch(spark) as inner:
            two = inner(kept, "two")
            three = session.stored(two, "three")
            gone = folder(three)
            raise ValueError
        assert not gone.exists() and two.count() == 5
        folders = [folder(df) for df in (one, two)]
        assert all(f.exists() for f in folders)
    assert not any(f.exists() for f in folders) and kept.count() == 5
