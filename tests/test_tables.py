"""Stored tables: schema growth, crashes before and during the insert, emptied partitions, clustered joins, backfill across slices, hand-written figures."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hazeframe import session
from hazeframe.functions import aqi
from hazeframe.functions.predicates import monthly_where
from hazeframe.operators import incremental as inc
from hazeframe.operators.quality import ContractBroken, Watch
from hazeframe.sources import landing
from hazeframe.sources.tables import StoredTable


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_grown_columns_survive_later_rewrites(spark, tmp_path):
    path = str(tmp_path / "t")
    inc.materialize(spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, None, 3.0)], "id long, p string, v double"), "t", "table", path, partition="p")
    inc.materialize(spark.createDataFrame([(1, "a", 9.0, 30.0)], "id long, p string, v double, w double"), "t", "delete_insert", path, ["id", "p"], "p")
    out = inc.materialize(spark.createDataFrame([(2, "a", 8.0), (4, "b c/d", 4.0)], "id long, p string, v double"), "t", "delete_insert", path, ["id", "p"], "p")
    assert rows(out.select("id", "p", "v", "w")) == rows(spark.createDataFrame(
        [(1, "a", 9.0, 30.0), (2, "a", 8.0, None), (3, None, 3.0, None), (4, "b c/d", 4.0, None)], "id long, p string, v double, w double"))
    whole = str(tmp_path / "u")
    inc.materialize(out.drop("w"), "u", "append", whole)
    assert inc.materialize(out.filter("id = 1"), "u", "delete_insert", whole, ["id"]).filter("w = 30").count() == 1


def test_crash_before_the_folder_is_complete_changes_nothing(spark, tmp_path, monkeypatch):
    path, old = str(tmp_path / "t"), spark.createDataFrame([(1, 1.0), (2, 2.0)], "id long, v double")
    inc.materialize(old, "t", "table", path)
    new = spark.createDataFrame([(2, 7.0)], "id long, v double")
    dying = new.withColumn("v", F.expr("assert_true(id > 5)").cast("double"))
    with pytest.raises(Exception):
        inc.materialize(dying, "t", "delete_insert", path, ["id"])
    assert rows(StoredTable(spark, path).rows()) == [(1, 1.0), (2, 2.0)]
    assert rows(inc.materialize(new, "t", "delete_insert", path, ["id"])) == [(1, 1.0), (2, 7.0)]


def test_crash_between_write_and_insert_is_finished_by_the_next_opener(spark, tmp_path, monkeypatch):
    path, old = str(tmp_path / "t"), spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, p string, v double")
    inc.materialize(old, "t", "table", path, partition="p")

    def dies(*_):
        raise KeyboardInterrupt
    new = spark.createDataFrame([(2, "b", 7.0)], "id long, p string, v double")
    with monkeypatch.context() as m:
        m.setattr(StoredTable, "_aligned", dies)
        with pytest.raises(KeyboardInterrupt):
            inc.materialize(new, "t", "delete_insert", path, ["id", "p"], "p")
    assert rows(StoredTable(spark, path, "p").rows().select("id", "v")) == [(1, 1.0), (2, 7.0)]
    assert not (tmp_path / "t_pending").exists()


def test_emptied_partitions_and_a_lost_catalogue(spark, tmp_path):
    path = str(tmp_path / "t")
    table = StoredTable(spark, path, "p", ("id",), 4)
    assert table.rows() is None
    table.replace_all(spark.createDataFrame([(1, 1.0, "it's"), (2, 2.0, "b"), (3, 3.0, None)], "id long, v double, p string"))
    table.replace_partitions(spark.createDataFrame([(9, 9.0, "b")], "id long, v double, p string"), ["b", "it's", None])
    assert rows(table.rows()) == [(9, 9.0, "b")] and rows(table.rows(["it's", None])) == []
    spark.sql(f"DROP TABLE {table.name}")
    assert rows(StoredTable(spark, path, "p", ("id",), 4).rows()) == [(9, 9.0, "b")]


def test_clustered_facts_join_and_roll_up_without_a_shuffle(spark, tmp_path):
    facts = spark.range(2000).select((F.col("id") % 50).cast("string").alias("ward_code"), (F.col("id") % 40).alias("hour"), (F.col("id") % 3).alias("p"), F.col("id").alias("v"))
    a, b = (inc.materialize(facts.withColumnRenamed("v", c), c, "table", str(tmp_path / c), partition="p", cluster=("ward_code",)) for c in ("v", "w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.drop("p").join(b.drop("p"), ["ward_code", "hour"]).groupBy("ward_code").agg(F.sum("v").alias("v"), F.sum("w").alias("w"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        want = facts.drop("p").join(facts.drop("p").withColumnRenamed("v", "w"), ["ward_code", "hour"]).groupBy("ward_code").agg(F.sum("v"), F.sum("w"))
        assert rows(joined) == rows(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_backfill_keeps_one_row_per_key_across_slices(spark, tmp_path):
    t = datetime(2024, 1, 1)
    admin = ["ward_name", "province_name", "nearest_highway_type", "distance_to_road_km"]
    df = spark.createDataFrame([("1", "api", t, t, 9.0), ("1", "api", t, t + timedelta(days=3), 5.0), ("2", "api", t, t + timedelta(days=40), 4.0)],
                               "ward_code string, traffic_source string, timestamp_utc timestamp, ingest_time timestamp, current_speed double")
    df = df.withColumns({c: F.lit("x") if c != "distance_to_road_km" else F.lit(1.0) for c in admin})
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    inc.backfill(df, lambda d: (d.withColumns({"ward_code": F.lit("z"), **{c: F.lit("x") for c in admin[:3]}, "distance_to_road_km": F.lit(1.0)}), d.limit(0)), timedelta(days=1), good, bad)
    assert rows(inc.backfilled(spark, good).select("ward_code", "current_speed")) == [("1", 5.0), ("2", 4.0)]


def test_backfill_quarantines_rows_without_ingest_time(spark, tmp_path):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(t, t, 1.0), (None, t, 2.0), (None, None, 3.0)], "timestamp_utc timestamp, ingest_time timestamp, latitude double")
    enrich = lambda d: (d.withColumns({"ward_code": F.lit("z"), "ward_name": F.lit("x"), "province_name": F.lit("x"), "nearest_highway_type": F.lit("x"),
                                       "distance_to_road_km": F.lit(1.0)}), d.limit(0).withColumn("quarantine_reason", F.lit("")))
    for part, good_rows, bad_rows in ((df, 2, [3.0]), (df.filter("ingest_time is null"), 0, [3.0])):
        good, bad = str(tmp_path / f"good{good_rows}"), str(tmp_path / f"bad{good_rows}")
        for _ in range(2):
            inc.backfill(part, enrich, timedelta(days=1), good, bad)
        assert rows(inc.quarantined(spark, bad).select("quarantine_reason", "source_stage", "latitude")) == [("missing_ingest_time", "slicing", x) for x in bad_rows]
        assert not good_rows or inc.backfilled(spark, good).count() == good_rows


def test_broken_contract_leaves_the_table_as_it_was(spark, tmp_path):
    schema = "id long, p string, v double"
    table = StoredTable(spark, str(tmp_path / "w"), "p")
    watch = Watch("m", ["v"], ["id", "p"], {"p": ["a", "b"]}, {"v": (0, 9)}, F.col("v") > 0, 0.5)
    table.replace_all(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], schema), watch)
    assert watch.rows == 2 and set(watch.violations.values()) == {0}
    before = rows(table.rows())
    bad = spark.createDataFrame([(1, "a", 0.0), (1, "a", None), (3, "a", 10.0), (4, "a", 0.0)], schema)
    with pytest.raises(ContractBroken, match="required v: 1 of 4"):
        table.replace_partitions(bad, ["a"], watch)
    assert watch.violations == {"required v": 1, "accepted p": 0, "between v": 1, "unique id p": 1, "success share": 3}
    assert rows(StoredTable(spark, str(tmp_path / "w"), "p").rows()) == before
    loose = Watch("m", ["v"], strict=False)
    table.replace_partitions(bad, ["a"], loose)
    assert rows(loose.report(spark)) == [("m", "required v", 1)] and table.rows().count() == 5
    table.replace_partitions(bad.limit(0), ["a"], watch)  # no rows break nothing
    assert watch.rows == 0 and rows(table.rows()) == [(2, 2.0, "b")]


def test_rows_that_were_never_judged_are_not_inserted(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "w"), "id long, v double"
    StoredTable(spark, path).replace_all(spark.createDataFrame([(1, 1.0)], schema))
    table = StoredTable(spark, path)

    def die(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as patch:
        patch.setattr(Watch, "settle", die)
        with pytest.raises(KeyboardInterrupt):
            table.replace_all(spark.createDataFrame([(2, None)], schema), Watch("m", ["v"]))
    again = StoredTable(spark, path)
    assert rows(again.rows()) == [(1, 1.0)]
    again.replace_all(spark.createDataFrame([(3, 3.0)], schema))  # a later write without a watch counts
    assert rows(again.rows()) == [(3, 3.0)]


def test_shared_folder_is_required_on_clusters():
    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077", "applicationId": "x"})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster, "p")


def test_dates_are_one_or_two():
    with pytest.raises(ValueError):
        monthly_where([datetime(2024, m, 1) for m in (1, 2, 3)])


def test_published_breakpoints_by_hand(spark):
    cases = [("pm25", 0.0, 0), ("pm25", 12.0, 50), ("pm25", 35.4, 100), ("pm25", 55.4, 150), ("pm10", 54.0, 50), ("no2", 100.0, 100), ("o3", 70.0, 100)]
    got = spark.createDataFrame(cases, "p string, v double, want int").select("want", aqi.us_aqi("p", "v").alias("i")).collect()
    assert all(abs(r.i - r.want) < 0.5 for r in got)


def test_unreadable_text_is_reported(spark, tmp_path):
    (tmp_path / "aqi_in").mkdir()
    (tmp_path / "aqi_in" / "one.csv").write_text('station_name,"odd, name",value,timestamp_utc\nA,z,"12,5",2024-01-01T00:00:00Z\nB,z,,not a time\nC,z,1.5,2024-01-01T00:00:00Z\n')
    bad = landing.landing_rejects(spark, str(tmp_path))
    assert rows(bad.select("table", "column", "text")) == [("raw_aqiin_measurements", "timestamp_utc", "not a time"), ("raw_aqiin_measurements", "value", "12,5")]
    tables, _ = landing.load_landing(spark, str(tmp_path), "r", datetime(2024, 1, 2))
    assert {r.station_name: r.value for r in tables["raw_aqiin_measurements"].collect()} == {"A": None, "B": None, "C": 1.5}
