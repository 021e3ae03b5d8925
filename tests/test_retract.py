"""Differences equal the rebuild: replaced, withdrawn and late readings, replays, deaths within a batch."""

import random
from datetime import datetime, timedelta

import pytest

from hazeframe.operators.retract import DeltaRollup, newest_readings

SCHEMA = "station string, pollutant string, timestamp_utc timestamp, version long, value double, note string"
START = datetime(2024, 1, 30)


def floor_of(level, t):
    t = t.replace(minute=0)
    return {"hour": t, "day": t.date(), "month": t.date().replace(day=1)}[level]


def rebuilt(batches, level):
    newest = {}
    for r in (r for b in batches for r in b):
        key, mark = r[:3], (r[3], r[4] is not None, r[4] or 0)
        if None not in r[:4] and (key not in newest or mark > newest[key][0]):
            newest[key] = (mark, r[4])
    groups = {}
    for (_, p, t), (_, v) in newest.items():
        if v is not None:
            groups.setdefault((p, floor_of(level, t)), []).append(v)
    return {k: (len(v), round(sum(v), 6), max(v), min(v)) for k, v in groups.items()}


def kept(store, level):
    return {(r.pollutant, r.at): (r.n, round(float(r.value_sum), 6), r.max_value, r.min_value) for r in store.level(level).collect()}


def batches(n, rows, rng):
    out, version = [], 0
    for _ in range(n):
        batch = []
        for _ in range(rows):
            version += 1
            at = START + timedelta(minutes=30 * rng.randrange(150))
            value = None if rng.random() < 0.25 else round(rng.uniform(-5, 50), 3)
            batch.append((rng.choice("ab"), rng.choice(["pm25", "o3"]), at, version if rng.random() < 0.9 else version - 40, value, "x"))
        out.append(batch)
    return out


def new_store(spark, path):
    return DeltaRollup(spark, str(path), ["station", "pollutant"], ["pollutant"])


def test_differences_equal_the_rebuild(spark, tmp_path):
    store, seen = new_store(spark, tmp_path), []
    assert store.level("hour") is None
    for k, batch in enumerate(batches(3, 160, random.Random(5))):
        batch += [("a", "pm25", None, 9, 1.0, "x"), ("a", None, START, 9, 1.0, "x"), ("b", "o3", START, None, 1.0, "x")]
        seen.append(batch)
        df = spark.createDataFrame(batch, SCHEMA)
        store.apply(df, k)
        if k == 1:
            store.apply(df, k)  # a replay adds nothing
        for level in ("hour", "day", "month"):
            assert kept(store, level) == rebuilt(seen, level), (k, level)


def test_a_batch_that_died_is_finished_once(spark, tmp_path, monkeypatch):
    store = new_store(spark, tmp_path)
    one, two = batches(2, 120, random.Random(8))
    store.apply(spark.createDataFrame(one, SCHEMA), 1)
    whole = DeltaRollup._update

    def dies(self, name, *rest):
        if name == "day":
            raise RuntimeError("lost")
        return whole(self, name, *rest)
    monkeypatch.setattr(DeltaRollup, "_update", dies)
    with pytest.raises(RuntimeError):
        store.apply(spark.createDataFrame(two, SCHEMA), 2)
    monkeypatch.setattr(DeltaRollup, "_update", whole)
    store.apply(spark.createDataFrame(two, SCHEMA), 2)
    for level in ("hour", "day", "month"):
        assert kept(store, level) == rebuilt([one, two], level), level


def test_only_touched_partitions_change(spark, tmp_path):
    store = new_store(spark, tmp_path)
    year = datetime(2023, 3, 1, 4)
    store.apply(spark.createDataFrame([("a", "o3", t, 1, v, "") for t, v in ((year, 1.0), (START, 2.0), (START + timedelta(days=1), 9.0))], SCHEMA), 1)

    def files():
        return {f.split("stored_part=")[1].split("/")[0]: f for f in store._table("hour").rows().inputFiles()}
    before = files()
    store.apply(spark.createDataFrame([("a", "o3", year, 2, None, "")], SCHEMA), 2)
    after = files()
    assert {d for d in before if after.get(d) != before[d]} == {"2023-03-01"}
    assert kept(store, "month") == {("o3", START.date().replace(day=1)): (2, 11.0, 9.0, 2.0)}


def test_odd_values_and_no_rows(spark, tmp_path):
    odd = [("a", "o3", START, 1, v, "") for v in (float("nan"), float("inf"), 1e300, None)] + [("b", "o3", START, 1, 3.0, ""), ("b", "o3", START, 1, 4.0, "")]
    df = spark.createDataFrame(odd, SCHEMA)
    got = {r.station: r.value for r in newest_readings(df, ["station", "pollutant", "timestamp_utc"], "version", "value").collect()}
    assert got == {"a": None, "b": 4.0}
    store = new_store(spark, tmp_path)
    store.apply(df.limit(0), 1)
    assert store.level("hour") is None
    store.apply(df, 2)
    assert [tuple(r)[2:] for r in store.level("day").collect()] == [(1, 4, 4.0, 4.0, 4.0)]
