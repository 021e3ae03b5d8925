"""The driver's tables in the roles of the air-quality raw tables.

Every role reads its whole table; values are plain arithmetic on columns, so
``registry.oracle`` can restate them in SQL.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions import geo
from hazeframe.functions.aqi import sql_strings
from hazeframe.functions.naming import padded_code
from hazeframe.plans.air_quality import AirQualityModels

AS_OF = datetime(2024, 1, 31)
AS_OF_DATE = date(2024, 1, 31)
ROADS = ["motorway", "trunk", "primary", "secondary", "tertiary", "residential", "path"]


def pick(values: list[str], index) -> F.Column:
    return F.get(F.expr(f"array({sql_strings(values)})"), index.cast("int"))


_READ: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The whole table; the plan (not the data) is remembered per session."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _READ:
        _READ[key] = spark.read.parquet(f"{folder}/{name}.parquet")
    return _READ[key]


def province_of_nation(nation) -> F.Column:
    return pick(fv.PROVINCES, F.col(nation) * 3 % len(fv.PROVINCES))


def wards(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        padded_code("c_custkey").alias("ward_code"), F.col("c_name").alias("ward_name"),
        province_of_nation("c_nationkey").alias("province"),
        (F.lit(8.5) + (key * 7919 % 15000) / 1000.0).alias("latitude"),
        (F.lit(102.0) + (key * 104729 % 7500) / 1000.0).alias("longitude"),
        (F.floor(F.abs("c_acctbal") * 10) + 1000).cast("double").alias("population"),
        (key % 97).cast("double").alias("area_km2"),
        pick(ROADS, key % 7).alias("nearest_highway_type"), ((key * 31 % 300) / 100.0).alias("distance_to_road_km"))


def stations(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    base = table(spark, folder, "supplier").withColumn("ward_code", padded_code(key * 11)).join(
        wards(spark, folder).select("ward_code", "province", "latitude", "longitude"), "ward_code")
    base = base.withColumn("latitude", F.col("latitude") + (key % 40) / 1000.0)
    shift = F.when(key % 3 == 0, 0.0).otherwise(0.005)

    def network(prefix, name, lat):
        return base.select(F.concat(F.lit(prefix), key.cast("string")).alias("station_name"), lat.alias("latitude"),
                           "longitude", F.lit(name).alias("station_source"), "ward_code", "province")
    return network("A", "aqiin", F.col("latitude")).unionByName(network("W", "waqi", F.col("latitude") + shift))


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as readings; the odd factor keeps values from ending on a rounding tie."""
    key = (spark.sparkContext.applicationId, folder, "readings")
    if key not in _READ:
        _READ[key] = table(spark, folder, "events").withColumns({
            "k": F.get_json_object("props", "$.k").cast("int"), "value": F.col("value") * 1.000031415926535,
            "sk": F.floor(F.col("user_id") / 10), "custkey": F.floor(F.col("user_id") / 10) * 11 + F.col("user_id") % 2})
    return _READ[key]


def _stamps() -> list:
    loaded = F.date_trunc("second", "ts") + F.make_interval(mins=(F.col("event_id") % 5 * 7).cast("int"))
    return [F.date_trunc("second", "ts").alias("ingest_time"), loaded.alias("raw_loaded_at"),
            F.concat(F.lit("run-"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("raw_sync_run_id"),
            F.date_trunc("hour", "ts").alias("raw_sync_started_at")]


def _narrow(df: DataFrame, values: dict, ids: list) -> DataFrame:
    wide = df.select(*ids, *[c.cast("double").alias(n) for n, c in values.items()])
    names = list(values)
    return wide.unpivot([c for c in wide.columns if c not in names], names, "parameter", "value")


def raw_station(spark: SparkSession, folder: str, source: str) -> DataFrame:
    e = events(spark, folder)
    v, k = F.col("value"), F.col("k")
    gas = F.col("event_type") != "signup"
    scale = F.lit(1.0) if source == "aqiin" else 1 + (k % 10) / 11.0
    co = v * 90 / 7 if source == "aqiin" else v / 7
    values = {
        "pm25": v * 9 / 7 * scale, "pm10": F.when(F.col("event_type") != "error", v * 13 / 7 * scale),
        "co": F.when(gas, co * scale), "no2": F.when(gas, v * 5 / 7 * scale), "so2": F.when(gas, v * 3 / 7 * scale),
        "o3": F.when(gas, v * 4 / 7 * scale), "temp": 10 + k / 4.0, "hum": k * 1.0}
    prefix = "A" if source == "aqiin" else "W"
    rows = _narrow(e, values, [
        F.concat(F.lit(prefix), F.col("sk").cast("string")).alias("station_name"), F.date_trunc("hour", "ts").alias("timestamp_utc"),
        k.alias("aqi_reported"), F.lit("valid").alias("quality_flag"), *_stamps()])
    p = F.col("parameter")
    unit = (F.when(p.isin("pm25", "pm10"), fv.UNIT_UGM3).when(p == "temp", "°C").when(p == "hum", "%")
            .when((p == "co") & F.lit(source == "waqi"), "ppm").otherwise("ppb"))
    return rows.withColumn("unit", unit)


def raw_openweather(spark: SparkSession, folder: str) -> DataFrame:
    e = events(spark, folder).withColumn("ward_code", padded_code("custkey"))
    v = F.col("value")
    values = {
        "pm25": v * 11 / 7, "pm10": F.when(F.col("event_type") != "purchase", v * 15 / 7), "co": v * 300 / 7,
        "no2": v * 2 / 7, "so2": v * 8 / 7, "o3": v * 6 / 7, "nh3": v / 3}
    w = wards(spark, folder).select("ward_code", "ward_name", F.col("province").alias("province_name"), "latitude", "longitude")
    ids = ["ward_code", "ward_name", "province_name", "latitude", "longitude", F.date_trunc("hour", "ts").alias("timestamp_utc"),
           F.col("k").alias("aqi_reported"), *_stamps()]
    return _narrow(e.join(w, "ward_code"), values, ids)


def raw_weather(spark: SparkSession, folder: str) -> DataFrame:
    e = events(spark, folder).withColumn("ward_code", padded_code("custkey"))
    w = wards(spark, folder).select("ward_code", F.col("province").alias("province_name"), "latitude", "longitude")
    k, v = F.col("k"), F.col("value")
    return e.join(w, "ward_code").select(
        F.lit("openweather").alias("source"), "province_name", geo.grid_key("latitude", "longitude").alias("weather_cluster"),
        F.col("latitude").alias("cluster_lat"), F.col("longitude").alias("cluster_lon"), F.col("ts").alias("timestamp_utc"),
        F.when(F.col("event_type") != "error", 15 + k / 5.0).alias("temp"), (10 + k / 5.0).alias("temp_min"),
        (20 + k / 5.0).alias("temp_max"), (16 + k / 5.0).alias("feels_like"), (40 + k * 3 / 5.0).alias("humidity"),
        (1000 + k % 30).alias("pressure"), (k * 100).alias("visibility"),
        F.when(F.col("event_type") != "view", v / 20.0).alias("wind_speed"), (k * 7 % 360).alias("wind_deg"),
        k.alias("clouds_all"), *_stamps())


def raw_traffic(spark: SparkSession, folder: str) -> DataFrame:
    e = events(spark, folder).withColumn("ward_code", padded_code("custkey"))
    w = wards(spark, folder).select("ward_code", "ward_name", F.col("province").alias("province_name"), "latitude", "longitude")
    k, v, kind = F.col("k"), F.col("value"), F.col("event_type")
    timed = ~kind.isin("click", "signup")
    moving = kind != "signup"
    return e.join(w, "ward_code").select(
        F.lit("tomtom").alias("source"), F.concat(F.col("custkey").cast("string"), F.lit(".0")).alias("ward_code"), "ward_name",
        "province_name", "latitude", "longitude", F.col("ts").alias("timestamp_utc"),
        F.when(timed, 100 + k + F.floor(v)).otherwise(0).cast("int").alias("current_travel_time"),
        F.when(timed, 100 + k).otherwise(0).cast("int").alias("free_flow_travel_time"),
        F.when(moving, 20 + k / 3.0).otherwise(0.0).alias("current_speed"),
        F.when(moving, 60.0).otherwise(0.0).alias("free_flow_speed"), F.lit("api").alias("traffic_source"),
        ((k % 10) / 10.0).alias("confidence"), *_stamps())


def calibration(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        F.when(F.col("p_size") % 2 == 0, "openweather").otherwise("waqi").alias("source"),
        pick(fv.POLLUTANTS, key % 6).alias("parameter"),
        F.when(F.col("p_size") > 25, "ALL").otherwise(pick(fv.PROVINCES, key % 34)).alias("location_scope"),
        (F.col("p_retailprice") / 1000.0).alias("calibration_factor"))


def bands(spark: SparkSession) -> DataFrame:
    """Band table with a text per band, from the index breakpoints."""
    rows = [(p, f"{p} band {i_lo}-{i_hi}", float(i_lo), float(i_hi))
            for p, table_ in fv.US_BREAKPOINTS.items() for _, _, i_lo, i_hi in table_]
    return spark.createDataFrame(rows, "pollutant_key string, health_effects string, epa_aqi_bp_lo double, epa_aqi_bp_hi double")


class LazyTables(dict):
    """Role name -> DataFrame, built on first use."""

    def __init__(self, builders):
        super().__init__()
        self.builders = builders

    def __contains__(self, name):
        return name in self.builders

    def __missing__(self, name):
        self[name] = self.builders[name]()
        return self[name]


def models(spark: SparkSession, folder: str) -> AirQualityModels:
    return AirQualityModels(LazyTables({
        "aqiin": lambda: raw_station(spark, folder, "aqiin"), "waqi": lambda: raw_station(spark, folder, "waqi"),
        "openweather": lambda: raw_openweather(spark, folder), "weather": lambda: raw_weather(spark, folder),
        "traffic": lambda: raw_traffic(spark, folder), "stations": lambda: stations(spark, folder),
        "wards": lambda: wards(spark, folder), "calibration": lambda: calibration(spark, folder)}))


def control(spark: SparkSession, folder: str) -> DataFrame:
    """Run log: one run per event user and day; errors are failed runs."""
    e = events(spark, folder)
    ok = F.col("event_type") != "error"
    return e.select(
        F.concat(F.lit("source_"), F.col("sk").cast("string")).alias("source"), F.date_trunc("second", "ts").alias("last_run"),
        F.when(ok, F.date_trunc("second", "ts")).otherwise(F.lit(fv.EPOCH).cast("timestamp")).alias("last_success"),
        F.col("k").cast("bigint").alias("records_ingested"), F.when(ok, 0).otherwise(-1).cast("bigint").alias("lag_seconds"),
        F.when(ok, "").otherwise("failed").alias("error_message"))
