"""Stored layers: two runs equal a full rebuild, untouched partitions stay as they are."""

from datetime import datetime, timedelta

from hazeframe.functions import geo
from hazeframe.operators import rollup
from hazeframe.plans.air_quality import AirQualityModels
from hazeframe.plans.stored import StoredModels, day_ranges
from hazeframe.sources.tables import partition_values

STAMPS = "ingest_time timestamp, raw_loaded_at timestamp, raw_sync_run_id string, raw_sync_started_at timestamp"
JAN, FEB = datetime(2024, 1, 1, 5), datetime(2024, 2, 3, 7)


def stamped(loaded, run):
    return (loaded, loaded, run, loaded)


def raw_tables(spark, late):
    day = datetime(2024, 2, 4)
    first, second = stamped(day, "run-1"), stamped(day + timedelta(days=1), "run-2")
    station = [("A1", at + timedelta(minutes=m), "pm25", v, "ug/m3", 1, "valid", *first) for at in (JAN, FEB) for m, v in ((0, 10.0), (30, 20.0))]
    modelled = [("00001", "one", "Huế", 16.0, 107.0, at, "pm25", 30.0, 1, *first) for at in (JAN, FEB)]
    traffic = [("tomtom", "1", "one", "Huế", 16.0, 107.0, at, 120, 100, 30.0, 60.0, "api", 0.5, *first) for at in (JAN, FEB)]
    if late:
        station += [("A1", JAN, "pm25", 90.0, "ug/m3", 1, "valid", *second), ("A1", JAN + timedelta(hours=3), "pm25", 7.0, "ug/m3", 1, "valid", *second)]
    ids = "ward_code string, ward_name string, province_name string, latitude double, longitude double, timestamp_utc timestamp"
    measured = f"station_name string, timestamp_utc timestamp, parameter string, value double, unit string, aqi_reported int, quality_flag string, {STAMPS}"
    return {
        "aqiin": spark.createDataFrame(station, measured), "waqi": spark.createDataFrame([], measured),
        "openweather": spark.createDataFrame(modelled, f"{ids}, parameter string, value double, aqi_reported int, {STAMPS}"),
        "traffic": spark.createDataFrame(traffic, f"source string, {ids}, current_travel_time int, free_flow_travel_time int, current_speed double, "
                                                  f"free_flow_speed double, traffic_source string, confidence double, {STAMPS}"),
        "stations": spark.createDataFrame([("A1", 16.0, 107.0, "aqiin", "00001", "Huế")], "station_name string, latitude double, longitude double, station_source string, ward_code string, province string"),
        "wards": spark.createDataFrame([("00001", "one", "Huế", 16.0, 107.0, 5000.0, 9.0)], "ward_code string, ward_name string, province string, latitude double, longitude double, population double, area_km2 double")}


def rows(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


def files(store, layer):
    """Date of the partition -> its files."""
    out = {}
    for f in store.layer(layer).inputFiles():
        out.setdefault(f.split("stored_part=")[1].split("/")[0], set()).add(f)
    return out


def test_late_rows_change_only_their_partitions(spark, tmp_path):
    store = StoredModels(spark, str(tmp_path))
    assert store.layer("ward_hour") is None
    store.run(raw_tables(spark, late=False))
    before = files(store, "ward_hour")
    assert sorted(before) == ["2024-01-01", "2024-02-03"]

    everything = raw_tables(spark, late=True)
    log = {r.source: r.records_ingested for r in store.run(everything).collect()}
    assert log == {"aqiin": 2}
    after = files(store, "ward_hour")
    assert after["2024-02-03"] == before["2024-02-03"] and not after["2024-01-01"] & before["2024-01-01"]
    # what a run reads of a layer are the partitions of the touched dates alone
    part = store.layer("ward_hour", [JAN.date()])
    assert "PartitionFilters: [isnotnull(stored_part" in part._jdf.queryExecution().executedPlan().toString()
    assert partition_values(part.select("date"), "date") == [JAN.date()]

    whole = AirQualityModels(everything)
    for layer, want in (("ward_hour", whole.ward_hourly), ("ward_day", whole.ward_daily), ("ward_month", whole.ward_monthly),
                        ("province_hour", whole.province("hour")), ("province_day", whole.province("day")), ("province_month", whole.province("month"))):
        got = store.layer(layer)
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got, want.columns) == rows(want, want.columns)
    assert store.layer("traffic_trend").count() == 4
    assert rollup.rollup_daily(store.layer("ward_hour")).count() == 4

    assert store.run(everything).isEmpty()
    assert files(store, "ward_hour") == after


def test_day_ranges_follow_the_days():
    d = [datetime(2024, 1, 1).date() + timedelta(days=k) for k in (0, 1, 2, 400, 30)]
    day = timedelta(days=1)
    first = datetime(2024, 1, 1)
    assert day_ranges(d) == [(first, first + 3 * day), (first + 30 * day, first + 31 * day), (first + 400 * day, first + 401 * day)]
    assert day_ranges(d, most=2) == [(first, first + 31 * day), (first + 400 * day, first + 401 * day)]


def test_stored_facts_meet_without_a_shuffle(spark, tmp_path):
    store, raw = StoredModels(spark, str(tmp_path), buckets=4), raw_tables(spark, late=True)
    weather = [("openweather", "Huế", "16.0_107.0", 16.0, 107.0, at, 20.0, 18.0, 22.0, 20.0, 60.0, 1010, 9000, 0.5, 90, 10, *stamped(datetime(2024, 2, 4), "run-1")) for at in (JAN, FEB)]
    raw["weather"] = spark.createDataFrame(weather, "source string, province_name string, weather_cluster string, cluster_lat double, cluster_lon double, timestamp_utc timestamp, temp double, temp_min double, "
                                                    f"temp_max double, feels_like double, humidity double, pressure int, visibility int, wind_speed double, wind_deg int, clouds_all int, {STAMPS}")
    store.run(raw)
    want = AirQualityModels(raw).unified_env
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = store.unified_environment(raw["wards"])
        facts = store.layer("ward_hour").join(store.layer("weather_hour").select("ward_code", "datetime_hour", "temperature"), ["ward_code", "datetime_hour"]).join(
            store.layer("traffic_hour").select("ward_code", "datetime_hour", "congestion_index"), ["ward_code", "datetime_hour"]).groupBy("ward_code", "date").count()
        assert "Exchange" not in facts._jdf.queryExecution().executedPlan().toString()
        assert rows(got, want.columns) == rows(want, want.columns) and got.count() > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def weather_rows(spark, readings):
    rows = [("openweather", "Huế", "16.0_107.0", 16.0, 107.0, at, temp, 18.0, 22.0, 20.0, 60.0, 1010, 9000, 0.5, 90, 10, *stamped(loaded, run)) for at, temp, loaded, run in readings]
    raw = spark.createDataFrame(rows, "source string, province_name string, weather_cluster string, cluster_lat double, cluster_lon double, timestamp_utc timestamp, temp double, temp_min double, "
                                       f"temp_max double, feels_like double, humidity double, pressure int, visibility int, wind_speed double, wind_deg int, clouds_all int, {STAMPS}")
    return raw.withColumn("weather_cluster", geo.grid_key("cluster_lat", "cluster_lon"))


def test_weather_is_stored_once_for_the_wards_of_a_place(spark, tmp_path):
    store, raw = StoredModels(spark, str(tmp_path), buckets=2), raw_tables(spark, late=True)
    ward = ("00001", "one", "Huế", 16.0, 107.0, 5000.0, 9.0)
    kinds = raw["wards"].schema
    first = datetime(2024, 2, 4)
    raw["wards"] = spark.createDataFrame([ward, *[(f"1{k:04d}", "x", "Huế", 16.01, 107.01, 1.0, 1.0) for k in range(40)]], kinds)
    raw["weather"] = weather_rows(spark, [(at, 20.0, first, "run-1") for at in (JAN, FEB)])
    store.run(raw)
    got = store.unified_environment(raw["wards"])
    want = AirQualityModels(raw).unified_env
    assert rows(got, want.columns) == rows(want, want.columns) and got.filter("temperature = 20").count() > 1
    assert store.layer("weather_place_hour").count() == 2 and not store.table("weather_hour").exists()
    whole = AirQualityModels(raw).weather_hourly
    by_ward = store.layer("weather_hour")
    assert sorted(by_ward.columns) == sorted(whole.columns) and rows(by_ward, whole.columns) == rows(whole, whole.columns) and by_ward.count() == 82

    # other wards from the second run on: hours that no new row touches keep the wards they had
    later = raw | {"wards": spark.createDataFrame([ward, ("20000", "y", "Huế", 16.0, 107.0, 1.0, 1.0)], kinds),
                   "weather": weather_rows(spark, [(JAN, 20.0, first, "run-1"), (FEB, 20.0, first, "run-1"), (FEB, 25.0, datetime(2024, 2, 6), "run-9")])}
    store.run(later)
    by_ward = store.layer("weather_hour")
    assert by_ward.filter(by_ward.datetime_hour == JAN).count() == 41
    assert sorted(r.ward_code for r in by_ward.filter(by_ward.datetime_hour == FEB).collect()) == ["00001", "20000"]
    seen = {(r.datetime_hour, r.temperature) for r in store.unified_environment(later["wards"]).filter("ward_code = '00001' and temperature is not null").collect()}
    assert seen == {(JAN, 20.0), (FEB, 25.0)}
