"""Steps that must not grow faster than their input, against their plain form."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from hazeframe.functions import predicates
from hazeframe.operators import dedup, distinct, joins
from hazeframe.plans import air_quality


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_dealt_near_each_other_are_shuffled_once(spark):
    df = spark.range(2000).select((F.col("id") % 50).alias("k"), (F.col("id") % 7).alias("p"), F.col("id").alias("v"),
                                  F.when(F.col("id") % 3 != 0, F.col("id")).alias("x"), F.concat(F.lit("t"), "id").alias("t"))
    near = dedup.latest_by_key(df, ["k", "p"], "v", ["x", "t"], ["t"], sparse=["x"], near=["k"])
    plain = dedup.latest_by_key(df, ["k", "p"], "v", ["x", "t"], ["t"], sparse=["x"])
    assert sorted(near.collect()) == sorted(plain.collect())
    again = near.groupBy("k").agg(F.max("v"))
    assert plan_of(again).count("Exchange ") == 1


def test_weather_is_reduced_before_it_meets_wards(spark):
    """Forty wards of one cell, one ward in two cells, wards without a place: same rows as from the fanned out readings."""
    wards = [(f"w{i:03}", f"n{i}", "P" if i % 2 else "Q", 10.0, 105.0) for i in range(40)]
    wards += [("w001", "n1", "P", 20.0, 105.0), ("w001", "n1", "Q", 10.0, 105.0), ("far", "f", "P", 30.0, 105.0), ("none", "n", None, 10.0, 105.0), (None, "x", "P", 10.0, 105.0)]
    w = spark.createDataFrame(wards, "ward_code string, ward_name string, province string, latitude double, longitude double")
    t0 = datetime(2024, 1, 1)
    rows = [("P" if i % 3 else "Q", 20.0 if i % 5 == 0 else 10.0, t0 + timedelta(minutes=7 * i), None if i % 4 == 0 else float(i), float(i * 2), i / 30, i, 1000 + i,
             t0 + timedelta(minutes=7 * i), f"r{i:03}") for i in range(60)]
    raw = spark.createDataFrame(rows, "province_name string, lat double, timestamp_utc timestamp, temp double, humidity double, wind_speed double, wind_deg int, pressure int, ingest_time timestamp, raw_sync_run_id string")
    raw = raw.withColumns({"weather_cluster": air_quality.geo.grid_key("lat", F.lit(105.0)), "raw_loaded_at": F.col("ingest_time"), "raw_sync_started_at": F.col("ingest_time"),
                           "visibility": F.lit(1), "cluster_lat": F.lit(0.0), "cluster_lon": F.lit(0.0)})
    got = air_quality.weather_ward_hourly(raw, w)
    names = air_quality.WEATHER
    ward = air_quality.stage_weather(raw, w).groupBy("province", "ward_code", "timestamp_utc").agg(
        *[air_quality.arg_max(s, "ingest_time", "raw_sync_run_id").cast("double").alias(c) for s, c in names.items()], F.max("raw_sync_run_id").alias("run"))
    mean = ward.groupBy("province", "timestamp_utc").agg(*[F.avg(c).alias(f"province_{c}") for c in names.values()])
    want = ward.join(mean, ["province", "timestamp_utc"])
    columns = [*names.values(), *[f"province_{c}" for c in names.values()]]

    def tidy(df, at, run):
        return sorted(map(repr, df.select("province", "ward_code", at, *[F.round(c, 9) for c in columns], run).collect()))
    assert tidy(got.withColumnsRenamed({"datetime_hour": "t", "raw_sync_run_id": "r"}), "t", "r") == \
        tidy(want.withColumnsRenamed({"timestamp_utc": "t", "run": "r"}), "t", "r")
    assert got.filter("ward_code = 'w001'").select("province").distinct().count() == 2


def test_readings_are_not_shuffled_to_find_few_stations(spark):
    """Stations that come from a join, which Spark guesses to be large, a name in two networks and one without a station."""
    n = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 0.001).alias("latitude"))
    stations = n.join(n.select("k", (F.col("k") * 0.002).alias("longitude")), "k").select(
        F.concat(F.lit("S"), F.col("k").cast("string")).alias("station_name"), F.when(F.col("k") % 2 == 0, "aqiin").otherwise("waqi").alias("station_source"),
        "latitude", "longitude", F.concat(F.lit("w"), (F.col("k") % 7).cast("string")).alias("ward_code"), F.lit("P").alias("province"))
    stations = stations.unionByName(stations.filter("station_name = 'S4'").withColumn("station_source", F.lit("waqi")))
    at = F.timestamp_seconds(1704067200 + F.col("id") % 3 * 1800)
    raw = spark.range(3_000_000).filter("id < 60").select(
        F.concat(F.lit("S"), (F.col("id") % 10 + F.when(F.col("id") % 10 == 9, 9000).otherwise(0)).cast("string")).alias("station_name"), at.alias("timestamp_utc"),
        F.lit("pm25").alias("parameter"), (F.col("id") * 1.0).alias("value"), F.lit("ug").alias("unit"), at.alias("raw_loaded_at"), at.alias("ingest_time"),
        F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("raw_sync_run_id"), at.alias("raw_sync_started_at"))
    got = air_quality.observed_for_hours({"aqiin": raw, "waqi": raw}, stations)
    assert "hashpartitioning(station_name" not in plan_of(got) and "SortMergeJoin" not in plan_of(got)
    # the latest run of a station and time is one of the last 30 readings; S4 is the same place in both networks
    want = [(f"w{i % 7}", f"r{r:03}") for i in range(9) for r in range(30, 60) if r % 10 == i]
    assert sorted(map(tuple, got.select("ward_code", "raw_sync_run_id").collect())) == sorted(want)


def test_readings_are_dealt_once_however_many_stations(spark):
    """Stations too many to broadcast: raw readings are shuffled by date and station alone, then as a row per time; rows as of ``fuse_observed``."""
    t0 = datetime(2024, 1, 1)
    names = [("S1", "aqiin", 10.0, "w1", "P"), ("S1", "waqi", 10.0, "w2", "P"), ("S2", "aqiin", 10.0, "w3", None), ("S2", "waqi", 20.0, None, "Q"), ("S3", "waqi", None, "w1", "P"), ("S3", "waqi", None, "w1", "P")]
    stations = spark.createDataFrame([(n, lat, 105.0, src, w, p) for n, src, lat, w, p in names], "station_name string, latitude double, longitude double, station_source string, ward_code string, province string")

    def readings(shift):
        rows = [(f"S{i % 4}" if i % 11 else None, t0 + timedelta(hours=i % 3) if i % 13 else None, ["pm25", "co", "o3", "temp"][i * 7 % 4], None if i % 5 == 0 else i * 1.5 + shift, ["ppm", "ppb", None][i * 5 % 3],
                 t0 + timedelta(minutes=i // 6 + shift) if i % 17 else None, t0 + timedelta(minutes=i), f"r{i:03}", t0) for i in range(400)]
        return spark.createDataFrame(rows, "station_name string, timestamp_utc timestamp, parameter string, value double, unit string, raw_loaded_at timestamp, ingest_time timestamp, raw_sync_run_id string, raw_sync_started_at timestamp")
    raw = {"aqiin": readings(0), "waqi": readings(1)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = air_quality.observed_for_hours(raw, stations)
        shuffles = [x for x in plan_of(got).splitlines() if "Exchange hashpartitioning(" in x]
        mine = sorted(map(repr, got.select("ward_code", "province", "timestamp_utc", "parameter", "value", "raw_loaded_at", "raw_sync_run_id", "ingest_time").collect()))
        plain = air_quality.observed_for_hours(raw, stations, lineage=False)
        values = sorted(map(repr, plain.select("ward_code", "province", "timestamp_utc", "parameter", "value").collect()))
        assert set(plain.columns) == set(got.columns) and plain.filter("raw_sync_run_id is not null or ingest_time is not null").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    first, second = (air_quality.process_station(air_quality.stage_station(raw[s], s, ["unit", *air_quality.HOURLY_COLUMNS]), stations, s) for s in ("aqiin", "waqi"))
    fused = dedup.fuse_observed(first, second).filter("parameter <> 'temp'")
    assert mine == sorted(map(repr, fused.select("ward_code", "province", "timestamp_utc", "parameter", "value", "raw_loaded_at", "raw_sync_run_id", "ingest_time").collect()))
    assert values == sorted(map(repr, fused.select("ward_code", "province", "timestamp_utc", "parameter", "value").collect()))
    dealt = [x.split("hashpartitioning(")[1].split("), ")[0].split("#")[0] for x in shuffles]
    assert dealt.count("date") == 2  # raw readings of the two networks; all others move packed rows or stations
    assert "Union" not in plan_of(got).split("hashpartitioning(date")[-1]


def test_observed_rows_are_dealt_by_position(spark):
    """Networks are placed in steps of their own; then rows without what follows from them go by position and date; rows as of ``fuse_observed``."""
    t0 = datetime(2024, 1, 1)
    names = [("S1", "aqiin", 10.0, "w1", "P"), ("S1", "waqi", 10.00001, "w2", "P"), ("S2", "aqiin", 0.0, "w3", None), ("S3", "aqiin", -0.00001, "w4", "Q"), ("S2", "waqi", 20.0, None, "Q"), ("S3", "waqi", None, "w1", "P")]
    stations = spark.createDataFrame([(n, lat, 105.0, src, w, p) for n, src, lat, w, p in names], "station_name string, latitude double, longitude double, station_source string, ward_code string, province string")

    def readings(shift):
        rows = [(f"S{i % 4}" if i % 11 else None, t0 + timedelta(hours=i % 30) if i % 13 else None, ["pm25", "co", "o3", "temp", None][i * 7 % 5], None if i % 5 == 0 else i * 1.5 + shift, ["ppm", "ppb", None][i * 5 % 3], i % 9, "valid" if i % 2 else None,
                 t0 + timedelta(minutes=i + shift) if i % 17 else None, t0 + timedelta(minutes=i), f"r{i:03}", t0) for i in range(600)]
        return spark.createDataFrame(rows, "station_name string, timestamp_utc timestamp, parameter string, value double, unit string, aqi_reported int, quality_flag string, raw_loaded_at timestamp, ingest_time timestamp, raw_sync_run_id string, raw_sync_started_at timestamp")
    models = air_quality.AirQualityModels({"aqiin": readings(0), "waqi": readings(1), "stations": stations})
    got, want = models.observed_processed, dedup.fuse_observed(models.processed("aqiin"), models.processed("waqi"))
    assert got.columns == want.columns

    def rows_of(df):
        return sorted(repr(tuple(x)) for x in df.select(*[F.col(c) + 0.0 if c.endswith("_rounded") else c for c in want.columns]).collect())
    assert rows_of(got) == rows_of(want) and got.count() > 50
    shuffles = [x for x in plan_of(got).splitlines() if "Exchange" in x]
    assert len(shuffles) == 1 and "hashpartitioning(_position" in shuffles[0]
    moved = plan_of(got).split("hashpartitioning(_position")[1]
    assert "aqi_us" not in moved and "region_3" not in moved


def test_cell_weather_meets_its_places_where_it_was_dealt(spark):
    t0 = datetime(2024, 1, 1)
    raw = spark.createDataFrame([("P", "c", t0 + timedelta(minutes=i), *[i * 1.0] * 5, t0, t0, "r", t0) for i in range(100)], "province_name string, weather_cluster string, timestamp_utc timestamp, "
                                + ", ".join(f"{c} double" for c in air_quality.WEATHER) + ", ingest_time timestamp, raw_loaded_at timestamp, raw_sync_run_id string, raw_sync_started_at timestamp")
    cells = spark.createDataFrame([("w7", "c", "P", 1)], "place string, weather_cluster string, province string, n long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hours = air_quality.weather_place_hourly(raw, cells)
        uses = plan_of(hours).count("REPARTITION_BY_COL")  # one deal of readings and one of cells for each
        assert plan_of(hours).count("hashpartitioning(weather_cluster") == 2 * uses > 0
        assert hours.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pairs_of_bands_are_not_shuffled(spark):
    bands = spark.range(300).select(F.lit("p").alias("name"), F.lit(0.0).alias("low"), F.lit(10.0).alias("high"), F.col("id").alias("band"))
    rows = spark.range(100).select(F.lit("p").alias("parameter"), (F.col("id") * 0.2).alias("value"))
    got = joins.band_join_cells(rows, bands, "parameter", "value", "name", "low", "high")
    assert got.filter("band is not null").count() == 51 * 300 and got.filter("band is null").count() == 49
    pairs = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in pairs and "LeftOuter" not in pairs


def test_bitmaps_are_built_after_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") % 40 + 1).alias("number"))
    bits = distinct.distinct_bitmaps(df, ["g"], "number")
    text = plan_of(bits)
    assert text.index("partial_bitmap_construct_agg") < text.index("Exchange hashpartitioning(g")
    assert sorted(map(tuple, distinct.distinct_counts(bits, ["g"], "n").collect())) == [(0, 40), (1, 40), (2, 40)]


def test_scopes_are_stacked_in_one_pass(spark):
    df = spark.range(10).withColumn("m", F.when(F.col("id") != 3, F.col("id") % 2))
    scopes = [F.col("m") == 1, F.col("id") > 6, F.lit(True)]
    want = df.filter(scopes[0]).union(df.filter(scopes[1])).union(df.filter(scopes[2]))
    got = predicates.once_per_scope(df, scopes)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and "Union" not in plan_of(got)
