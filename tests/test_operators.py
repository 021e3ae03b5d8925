"""Operators against brute force on small fixtures, skew included."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hazeframe import session
from hazeframe.operators import dedup, distinct, incremental, joins, ranking, spatial
from hazeframe.plans import alerts, marts


def haversine(a, b):
    (la1, lo1), (la2, lo2) = [(math.radians(x), math.radians(y)) for x, y in (a, b)]
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * 6371000 * math.asin(min(1, math.sqrt(h)))


def clustered(n, seed):
    r = random.Random(seed)
    pts = [(r.uniform(-85, 85), r.uniform(-179.9, 179.9)) for _ in range(n // 3)]
    pts += [(10 + r.gauss(0, 0.02), 106 + r.gauss(0, 0.02)) for _ in range(n // 3)]
    return pts + [(10.0, 106.0)] * (n - 2 * (n // 3))  # a third of the points coincide


@pytest.mark.parametrize("metric,k", [("sphere", 1), ("sphere", 3), ("planar", 4)])
def test_knn_equals_brute_force(spark, metric, k):
    points, refs = clustered(60, 1), clustered(90, 2)[:61] + [(80.0, 179.95), (80.0, -179.95)]
    dist = haversine if metric == "sphere" else (lambda a, b: math.hypot(a[0] - b[0], a[1] - b[1]))
    got = spatial.knn(spark.createDataFrame([(a, b) for a, b in points], "latitude double, longitude double"),
                      spark.createDataFrame([(f"{i:03d}", a, b) for i, (a, b) in enumerate(refs)], "ref_key string, ref_lat double, ref_lon double"), k, metric).collect()
    found = {}
    for r in got:
        found.setdefault((r.latitude, r.longitude), []).append((r.neighbour, r.distance))
    assert set(found) == set(points)
    for p, rows in found.items():
        want = sorted(dist(p, q) for q in refs)[:k]
        assert [d for _, d in sorted(rows)] == pytest.approx(want, rel=1e-9, abs=1e-4)


def test_knn_with_fewer_references_than_k(spark):
    pts = spark.createDataFrame([(1.0, 1.0)], "latitude double, longitude double")
    refs = spark.createDataFrame([("a", 50.0, -120.0), ("b", 2.0, 1.0)], "ref_key string, ref_lat double, ref_lon double")
    assert [r.ref_key for r in spatial.knn(pts, refs, 10, "planar").orderBy("neighbour").collect()] == ["b", "a"]


def test_station_distance_rule(spark):
    step = 1 / 111194.93
    wards = spark.createDataFrame([("w1", 10.0, 106.0), ("w2", 11.0, 106.0)], "ward_code string, latitude double, longitude double")
    stations = spark.createDataFrame([("w1", 10.0 + 1999 * step, 106.0), ("w2", 11.0 + 2001 * step, 106.0)], "ward_code string, latitude double, longitude double")
    flags = spatial.station_flags(stations, wards)
    rows = spark.createDataFrame([("openweather", "w1"), ("openweather", "w2"), ("aqiin", "w1"), ("openweather", "w3")], "source string, ward_code string")
    kept = {tuple(r) for r in spatial.suppress_near(rows, flags).select("source", "ward_code").collect()}
    assert kept == {("openweather", "w2"), ("aqiin", "w1"), ("openweather", "w3")}


def test_latest_value_skips_null(spark):
    df = spark.createDataFrame([("a", 1, 5.0, "x"), ("a", 2, None, "y"), ("b", 1, None, None)], "k string, v int, n double, s string")
    for sparse in (None, ["n"]):
        got = {r.k: (r.v, r.n, r.s) for r in dedup.latest_by_key(df, ["k"], "v", sparse=sparse).collect()}
        assert got == {"a": (2, 5.0, "y"), "b": (1, None, None)}
    assert {r.k: r.n for r in dedup.final(df, ["k"], "v").collect()} == {"a": None, "b": None}


@pytest.mark.parametrize("n", [1, 4, 5, 24, 997])
def test_exact_quantile_index(spark, n):
    r = random.Random(n)
    values = [float(r.choice([1, 2, 3, r.random() * 100])) for _ in range(n)]
    df = spark.createDataFrame([("hot", v) for v in values] + [("cold", 7.0)], "g string, v double")
    got = {(x.g, x.p): x.quantile for x in ranking.exact_quantiles(df, ["g"], "v", [0.0, 0.25, 0.75, 1.0]).collect()}
    for p in (0.0, 0.25, 0.75, 1.0):
        assert got[("hot", p)] == sorted(values)[min(int(p * n), n - 1)]
        assert got[("cold", p)] == 7.0


def test_exact_quantile_beyond_sketch_size(spark):
    df = spark.range(50000).select(((F.col("id") * 7919) % 50000).cast("double").alias("v"))
    got = {x.p: x.quantile for x in ranking.exact_quantiles(df, [], "v", [0.25, 0.9], accuracy=100).collect()}
    assert got == {0.25: 12500.0, 0.9: 45000.0}


def test_exact_quantile_narrows_until_bounded(spark):
    rows = spark.range(20000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise("cold").alias("g"),
                                     F.when(F.col("id") < 10000, 5.0).otherwise(((F.col("id") * 7919) % 20000).cast("double")).alias("v"))
    got = {(x.g, x.p): x.quantile for x in ranking.exact_quantiles(rows, ["g"], "v", [0.0, 0.3, 0.77, 1.0], most_distinct=20).collect()}
    by = {}
    for r in rows.collect():
        by.setdefault(r.g, []).append(r.v)
    assert got == {(g, p): sorted(vs)[min(int(p * len(vs)), len(vs) - 1)] for g, vs in by.items() for p in (0.0, 0.3, 0.77, 1.0)}


def test_places_without_coordinates_stay(spark):
    stations = spark.createDataFrame([("a", 1.0, 1.0, "p", "zz"), ("b", None, 2.0, "p", "zz"), ("c", None, None, "p", "w")],
                                     "station_name string, latitude double, longitude double, norm_province string, norm_ward string")
    wards = spark.createDataFrame([("1", "P", "p", "w", 1.1, 1.0)], "ward_code string, province string, norm_province string, norm_ward string, ref_lat double, ref_lon double")
    got = {r.station_name: (r.ward_code, r.match) for r in spatial.map_stations(stations, wards).collect()}
    assert got == {"a": ("1", "nearest"), "b": (None, "missing_lat_lon"), "c": ("1", "name")}
    targets = spark.createDataFrame([("2", 1.0, 1.0, "trunk", 0.1), ("3", None, 1.0, "trunk", 0.1)], "ward_code string, latitude double, longitude double, nearest_highway_type string, distance_to_road_km double")
    known = spark.createDataFrame([("1", 1.1, 1.0, 30.0, 60.0)], "ward_code string, latitude double, longitude double, current_speed double, free_flow_speed double")
    filled = {r.ward_code: r.congestion_ratio for r in spatial.idw_fill(targets, known).collect()}
    assert filled["2"] > 0 and filled["3"] is None


def test_nearest_with_dense_city_outlier_and_equal_points(spark):
    r = random.Random(8)
    refs = [(i, 21.0 + r.random() / 50, 105.8 + r.random() / 50) for i in range(300)] + [(900, -40.0, -70.0)]
    where = [(21.01, 105.81)] * 3000 + [(-39.0, -71.0), (60.0, 10.0), (20.0, 104.0)]
    points = spark.createDataFrame([(i, *w) for i, w in enumerate(where)], "id int, latitude double, longitude double")
    known = spark.createDataFrame(refs, "ref_key int, ref_lat double, ref_lon double")
    got = {x.id: x.ref_key for x in spatial.nearest_join(points, known, "planar").collect()}
    best = {w: min(refs, key=lambda q: ((q[1] - w[0]) ** 2 + (q[2] - w[1]) ** 2, q[0]))[0] for w in set(where)}
    assert got == {i: best[w] for i, w in enumerate(where)}


def test_large_rank_equals_window_rank(spark):
    r = random.Random(5)
    values = [float(r.randrange(50)) for _ in range(300)] + [9.0] * 150 + [None] * 3
    df = spark.createDataFrame(list(enumerate(values)), "id int, m double")
    got = {x.id: x["rank"] for x in ranking.rank_large(df, "m", buckets=8).collect()}
    present = [v for v in values if v is not None]
    assert got == {i: (len(present) if v is None else sum(w > v for w in present)) + 1 for i, v in enumerate(values)}


def test_calibration_order(spark):
    table = spark.createDataFrame([("ow", "pm25", "ALL", 0.5), ("ow", "pm25", "Huế", 1.5)], "source string, parameter string, location_scope string, calibration_factor double")
    rows = spark.createDataFrame([("ow", "pm25", "Huế", 10.0), ("ow", "pm25", "Hà Nội", 10.0), ("ow", "co", "Huế", 10.0)], "source string, parameter string, province string, value double")
    got = {(r.parameter, r.province): r.value for r in joins.calibrate(rows, table).collect()}
    assert got == {("pm25", "Huế"): 15.0, ("pm25", "Hà Nội"): 5.0, ("co", "Huế"): 8.0}


def trend_rows(hours, congestion):
    t0 = datetime(2024, 1, 1)
    return [(t0.date(), "Hà Nội", "observed", "Northern", "Red River Delta", t0 + timedelta(hours=i), 10.0 * i, 1.0, congestion(i), 1.0, "high", 1, 1, 0.1) for i in range(hours)]


TREND = ("date date, province string, source_mix string, region_3 string, region_8 string, datetime_hour timestamp, pm25 double, pm10 double, avg_congestion double, "
         "confidence_score double, confidence_level string, traffic_ward_count int, positive_traffic_ward_count int, traffic_coverage_ratio double")


@pytest.mark.parametrize("hours,defined", [(23, False), (24, True)])
def test_uplift_needs_a_full_day(spark, hours, defined):
    row = marts.traffic_correlation(spark.createDataFrame(trend_rows(hours, lambda i: i / 10 + 0.1), TREND)).first()
    assert (row.pm25_congestion_uplift is not None) == defined
    assert row.low_congestion_threshold == pytest.approx(int(0.25 * hours) / 10 + 0.1)
    assert row.location_type == "Urban"


def test_control_keeps_last_success(spark):
    t = datetime(2024, 1, 1)
    control = spark.createDataFrame([("a", t, t, 1, 0, "", t)], incremental.CONTROL_SCHEMA)
    runs = spark.createDataFrame([("a", t + timedelta(hours=1), 0, False, "x"), ("b", t, 0, False, "x"), ("c", t, 5, True, "")],
                                 "source string, last_run timestamp, records_ingested int, success boolean, error_message string")
    got = {r.source: (r.last_success, r.lag_seconds) for r in incremental.control_rows(control, runs).collect()}
    assert got["a"] == (t, 3600) and got["b"][1] == -1 and got["c"] == (t, 0)
    assert incremental.high_water_mark(control, "a") == t and incremental.high_water_mark(control, "zz") == datetime(1970, 1, 1)


def test_success_gate(spark):
    df = spark.createDataFrame([(i < 9,) for i in range(10)], "ok boolean")
    assert incremental.require_success(df, F.col("ok")) == 0.9
    with pytest.raises(ValueError):
        incremental.require_success(df, F.col("ok"), 0.95)
    assert incremental.success_ratio(df.limit(0), F.col("ok")).first().passed is False


def test_alert_rules(spark):
    m = spark.createDataFrame([("p", "aqi_2h", 201.0), ("q", "aqi_2h", 150.0), ("platform", "reliable_pct", 69.9)], "subject string, metric string, observed double")
    assert {(r.rule, r.subject) for r in alerts.fired(m).collect()} == {("aqi_vn_warning", "p"), ("aqi_vn_critical", "p"), ("reliable_coverage", "platform")}


def test_current_rows_keep_ward_and_fill_gaps(spark):
    t = datetime(2024, 1, 1)
    schema = ("ward_code string, ward_name string, province_name string, nearest_highway_type string, distance_to_road_km double, traffic_source string, "
              "latitude double, longitude double, timestamp_utc timestamp, ingest_time timestamp, current_speed double, free_flow_speed double, road_closure int")
    df = spark.createDataFrame([("1", "n", "p", "trunk", 0.1, "api", 1.0, 1.0, t, t, 5.0, 6.0, 0), ("1", "n", "p", "trunk", 0.1, "api", 1.0, 1.0, t, t + timedelta(hours=1), 7.0, 6.0, 0),
                                (None, None, None, None, None, None, 9.0, 9.0, t, t, 5.0, 6.0, 0), (None, None, None, None, None, "api", None, 9.0, t, t, 5.0, 6.0, 0)], schema)
    refs = spark.createDataFrame([("9", "nine", "p9", "primary", 0.2, 9.1, 9.1), ("1", "one", "p", "trunk", 0.1, 1.0, 1.0)],
                                 "ward_code string, ward_name string, province_name string, nearest_highway_type string, distance_to_road_km double, ref_lat double, ref_lon double")
    good, bad = incremental.normalise_traffic(df, lambda x: spatial.nearest_enrich(x, refs, ref_key="ward_code"))
    assert {(r.ward_code, r.current_speed, r.traffic_source) for r in good.collect()} == {("1", 7.0, "api"), ("9", 5.0, "api")}
    assert [r.quarantine_reason for r in bad.collect()] == ["missing_lat_lon"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_late_rows_equal_whole_rows_on_ties_and_nulls(spark):
    r = random.Random(5)
    rows = [(r.choice(["a", "b", None]), r.choice([1, 2, None]), r.choice([1, 2, 3, None]), f"t{r.randrange(4)}", i % 7) for i in range(300)] + [("z", 1, None, "t", 0), ("z", 1, None, "u", 0)]
    df = spark.createDataFrame(rows, "k string, j int, v int, t string, n int")
    late, whole = dedup.final_late(df, ["k", "j"], "v", ["t", "n"]), dedup.final(df, ["k", "j"], "v", ["t", "n"])
    assert sorted(map(repr, late.collect())) == sorted(map(repr, whole.collect())) and late.count() == 10
    plan = plan_of(late)
    assert "HashAggregate(keys=[k" in plan and "LeftSemi" in plan
    assert dedup.final_late(df.limit(0), ["k", "j"], "v", ["t"]).count() == 0


def test_bitmaps_count_what_distinct_counts(spark):
    r = random.Random(6)
    rows = [(h, r.choice("xy"), r.choice([None, *[f"w{k}" for k in range(70_000)]]) if h else f"w{i}") for h in range(3) for i in range(40_000 if h == 0 else 3000)]
    df = spark.createDataFrame(rows, "hour int, area string, ward string")
    numbers = distinct.number_keys(df.filter("hour < 2"), "ward")
    numbers = distinct.number_keys(df, "ward", session.stored(numbers, "first-numbers"))
    given = [x.number for x in numbers.collect()]
    assert sorted(given) == list(range(1, len(given) + 1)) and len(given) > 32_768
    bits = session.stored(distinct.distinct_bitmaps(df.join(numbers, "ward"), ["hour", "area"], "number"), "bits")
    for by in (["hour", "area"], ["hour"], ["area"]):
        counts = distinct.distinct_counts(bits, by, "n")
        assert "Expand" not in plan_of(counts)
        assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, df.groupBy(*by).agg(F.count_distinct("ward")).collect()))


def test_many_bands_of_one_key(spark):
    r = random.Random(8)
    inf, nan = float("inf"), float("nan")
    lows = [r.choice([-1, 1]) * r.random() * 10 ** r.randrange(-3, 7) for _ in range(3000)]
    bands = [("p", x, x + r.choice([0.0, 0.001, 1.0, 37.5, 1e5]), i) for i, x in enumerate(lows)]
    bands += [("p", -inf, -1e5, 9000), ("p", 1e6, inf, 9001), ("p", None, 3.0, 9002), ("p", 5.0, 4.0, 9003), (None, 0.0, 9.0, 9004), ("q", 0.0, 0.0, 9005), ("p", 1.0, nan, 9006)]
    values = [("p", x) for x in lows[:400]] + [("p", r.uniform(-2e6, 2e6)) for _ in range(300)] + [("q", 0.0), ("q", 1.0), ("r", 1.0), (None, 1.0), ("p", None), ("p", inf), ("p", 0.0), ("p", 0.0)]
    df = spark.createDataFrame(values, "parameter string, value double")
    table = spark.createDataFrame(bands, "name string, low double, high double, band int")
    args = ("parameter", "value", "name", "low", "high")
    got, want = joins.band_join_cells(df, table, *args), joins.band_join(df, table, *args)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() > 1000
    assert [tuple(x) for x in joins.band_join_cells(df, table.limit(0), *args).filter("parameter = 'q'").collect()] == [("q", 0.0, None), ("q", 1.0, None)]


def test_bands_of_uneven_cells(spark, monkeypatch):
    """Dealt at the coarsest level, at a finer one, and not at all: the same pairs."""
    r = random.Random(18)
    bands = [("p", x, x + w, i) for i, (x, w) in enumerate((r.uniform(0, 500), r.choice([0.1, 2.0, 30.0, 400.0])) for _ in range(300))] + [("p", 450.0, float("inf"), 900)]
    values = [("p", r.uniform(-50, 600)) for _ in range(500)] + [("p", 77.0)] * 60 + [("x", 1.0), (None, 1.0), ("p", None)]
    df, table = spark.createDataFrame(values, "parameter string, value double"), spark.createDataFrame(bands, "name string, low double, high double, band int")
    args = ("parameter", "value", "name", "low", "high")
    want = sorted(map(repr, joins.band_join(df, table, *args).collect()))
    for least in (100_000, 150, 70, 0):
        monkeypatch.setattr(joins, "DEALT_AT_LEAST", least)
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        try:
            assert sorted(map(repr, joins.band_join_cells(df, table, *args).collect())) == want
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_rows_of_bands_are_dealt_once(spark):
    bands = spark.range(5000).select(F.lit("p").alias("name"), (F.col("id") * 3.0).alias("low"), (F.col("id") * 3.0 + F.when(F.col("id") % 7 == 0, 50.0).otherwise(0.5)).alias("high"), F.col("id").alias("band"))
    rows = spark.range(20_000).select(F.lit("p").alias("parameter"), (F.col("id") * 0.7).alias("value"), F.col("id").alias("n"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.band_join_cells(rows, bands, "parameter", "value", "name", "low", "high")
        plan = plan_of(got)
        assert plan.count("hashpartitioning(_deal") == 2 and "hashpartitioning(_id" not in plan and "_level#" not in "".join(x for x in plan.splitlines() if "hashpartitioning" in x)
        assert got.filter("band is null").select("n").distinct().count() + got.filter("band is not null").select("n").distinct().count() == 20_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hundred_thousand_bands(spark):
    bands = spark.range(100_000).select(F.lit("p").alias("name"), F.col("id").cast("double").alias("low"), (F.col("id") + 0.5).alias("high"), F.col("id").alias("band"))
    rows = spark.range(200_000).select(F.lit("p").alias("parameter"), (F.col("id") * 0.5 + 0.25).alias("value"))
    got = joins.band_join_cells(rows, bands, "parameter", "value", "name", "low", "high")
    assert got.filter("band = floor(value)").count() == 100_000 and got.filter("band is null").count() == 100_000
