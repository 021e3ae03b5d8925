"""Provider payloads (JSON text) -> typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions import times, units
from hazeframe.functions.aqi import aqi_to_concentration

AIR_SCHEMA = ("list array<struct<dt:bigint, main:struct<aqi:int>, components:struct<"
              + ", ".join(f"{c}:double" for c in fv.AIR_POLLUTION_COMPONENTS) + ">>>")
WEATHER_SCHEMA = ("dt bigint, main struct<temp:double,feels_like:double,temp_min:double,temp_max:double,"
                  "pressure:double,humidity:double>, visibility bigint, wind struct<speed:double,deg:double>, "
                  "clouds struct<all:int>")
_V = "struct<v:double>"
STATION_SCHEMA = ("idx bigint, aqi int, city struct<name:string,geo:array<double>,url:string>, iaqi struct<"
                  + ", ".join(f"{p}:{_V}" for p in fv.STATION_PARAMETERS) + f", t:{_V}, h:{_V}>, "
                  "time struct<iso:string,s:string,tz:string>")
FEED_SCHEMA = ("status string, data array<struct<station:string, latitude:double, longitude:double, iaqi:struct<"
               + ", ".join(f"{p}:double" for p in fv.STATION_PARAMETERS)
               + ", aqi:int>, weather:struct<temp_c:double, humidity:double>>>")
TRAFFIC_SCHEMA = ("flowSegmentData struct<currentSpeed:double,freeFlowSpeed:double,currentTravelTime:int,"
                  "freeFlowTravelTime:int,confidence:double,roadClosure:boolean>")


def explode_air_pollution(df: DataFrame, payload: str, as_of, grace_minutes: int = 5) -> DataFrame:
    """One row per list item and component; items beyond ``as_of`` + grace are dropped."""
    now = F.lit(as_of).cast("timestamp")
    items = (df.withColumn("_p", F.from_json(payload, AIR_SCHEMA)).select(
        *[c for c in df.columns if c != payload], F.explode("_p.list").alias("i"))
        .withColumn("timestamp_utc", F.coalesce(F.timestamp_seconds("i.dt"), now))
        .filter(F.col("timestamp_utc") <= now + F.expr(f"INTERVAL {int(grace_minutes)} MINUTES")))
    cells = F.array(*[F.struct(F.lit(name).alias("parameter"), F.col(f"i.components.{api}").alias("value"))
                      for api, name in fv.AIR_POLLUTION_COMPONENTS.items()])
    return (items.withColumn("aqi_reported", F.col("i.main.aqi")).withColumn("c", F.explode(cells)).drop("i")
            .select("*", "c.*").drop("c").filter(F.col("value").isNotNull())
            .withColumn("quality_flag", units.quality_flag("parameter", "value")))


def _station_unit(parameter):
    return (F.when(parameter == "co", "ppm").when(parameter.isin("no2", "so2", "o3"), "ppb")
            .when(parameter == "temp", "°C").when(parameter == "hum", "%").otherwise(fv.UNIT_UGM3))


def explode_station(df: DataFrame, payload: str, as_of, order: str) -> tuple[DataFrame, DataFrame]:
    """Station payloads -> (measurements, stations), one of each per station id.

    The same physical station answers many requests; the first answer by
    ``order`` is used.  Sub-index readings become concentrations.
    """
    p = df.withColumn("_p", F.from_json(payload, STATION_SCHEMA)).filter(F.col("_p.idx").isNotNull())
    one = p.groupBy(F.col("_p.idx").alias("station_id")).agg(
        F.min_by(F.struct("_p", "station_name", "station_lat", "station_lon"), F.col(order)).alias("r"))
    now = F.lit(as_of).cast("timestamp")
    base = one.select(
        "station_id", F.coalesce("r._p.city.name", "r.station_name").alias("station_name"),
        F.coalesce(F.get("r._p.city.geo", F.lit(0)), "r.station_lat").alias("latitude"),
        F.coalesce(F.get("r._p.city.geo", F.lit(1)), "r.station_lon").alias("longitude"),
        F.coalesce("r._p.city.url", F.lit("")).alias("city_url"),
        times.station_time_to_utc("r._p.time.iso", "r._p.time.s", "r._p.time.tz", now).alias("timestamp_utc"),
        F.coalesce("r._p.aqi", F.lit(0)).alias("aqi_reported"), F.col("r._p.iaqi").alias("iaqi"))
    cells = F.array(
        *[F.struct(F.lit(n).alias("parameter"), F.col(f"iaqi.{n}.v").alias("v")) for n in fv.STATION_PARAMETERS],
        F.struct(F.lit("temp").alias("parameter"), F.col("iaqi.t.v").alias("v")),
        F.struct(F.lit("hum").alias("parameter"), F.col("iaqi.h.v").alias("v")))
    parameter, v = F.col("c.parameter"), F.col("c.v")
    value = F.when(parameter.isin(fv.STATION_PARAMETERS), aqi_to_concentration("c.parameter", "c.v")).otherwise(v)
    rows = base.withColumn("c", F.explode(cells)).filter(v.isNotNull()).select(
        F.lit("waqi").alias("source"), "station_name", "timestamp_utc", parameter.alias("parameter"),
        value.alias("value"), "aqi_reported", _station_unit(parameter).alias("unit"), F.lit("valid").alias("quality_flag"))
    return rows, base.select("station_id", "station_name", "latitude", "longitude", "city_url")


def explode_feed(df: DataFrame, payload: str, ts: str) -> DataFrame:
    """Second station feed: values are concentrations, gases in ppb; failed answers drop out."""
    p = df.withColumn("_p", F.from_json(payload, FEED_SCHEMA)).filter(F.coalesce("_p.status", F.lit("")) != "failed")
    e = p.withColumn("e", F.get("_p.data", F.lit(0))).filter(F.col("e").isNotNull())
    cells = F.array(
        *[F.struct(F.lit(n).alias("parameter"), F.col(f"e.iaqi.{n}").alias("value"),
                   F.lit(fv.UNIT_UGM3 if n.startswith("pm") else "ppb").alias("unit")) for n in fv.STATION_PARAMETERS],
        F.struct(F.lit("temp").alias("parameter"), F.col("e.weather.temp_c").alias("value"), F.lit("°C").alias("unit")),
        F.struct(F.lit("hum").alias("parameter"), F.col("e.weather.humidity").alias("value"), F.lit("%").alias("unit")))
    return (e.withColumn("c", F.explode(cells)).filter(F.col("c.value").isNotNull()).select(
        F.lit("aqiin").alias("source"), F.coalesce("e.station", F.lit("Unknown")).alias("station_name"),
        F.col(ts).alias("timestamp_utc"), "c.*", F.coalesce("e.iaqi.aqi", F.lit(0)).alias("aqi_reported"),
        F.lit("valid").alias("quality_flag")))


def flatten_weather(df: DataFrame, payload: str, as_of) -> DataFrame:
    """Weather payload -> one typed row."""
    p = df.withColumn("_p", F.from_json(payload, WEATHER_SCHEMA))
    keep = [c for c in df.columns if c != payload]
    return p.select(
        *keep, F.coalesce(F.timestamp_seconds("_p.dt"), F.lit(as_of).cast("timestamp")).alias("timestamp_utc"),
        "_p.main.temp", "_p.main.feels_like", "_p.main.temp_min", "_p.main.temp_max", "_p.main.pressure",
        "_p.main.humidity", "_p.visibility", F.col("_p.wind.speed").alias("wind_speed"),
        F.col("_p.wind.deg").alias("wind_deg"), F.col("_p.clouds.all").alias("clouds_all"))


def flatten_traffic(df: DataFrame, payload: str) -> DataFrame:
    """Traffic payload -> speeds and travel times; answers without a speed drop out."""
    p = df.withColumn("_p", F.from_json(payload, TRAFFIC_SCHEMA)["flowSegmentData"]).filter(F.col("_p.currentSpeed").isNotNull())
    return p.select(
        *[c for c in df.columns if c != payload], F.col("_p.currentSpeed").alias("current_speed"),
        F.col("_p.freeFlowSpeed").alias("free_flow_speed"),
        F.coalesce("_p.currentTravelTime", F.lit(0)).alias("current_travel_time"),
        F.coalesce("_p.freeFlowTravelTime", F.lit(0)).alias("free_flow_travel_time"),
        F.coalesce("_p.confidence", F.lit(0.0)).alias("confidence"),
        F.coalesce("_p.roadClosure", F.lit(False)).cast("int").alias("road_closure"))
