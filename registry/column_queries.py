"""Column expressions over the driver's tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions import aqi, geo, naming, times, traffic, units
from hazeframe.functions.aggregates import ratio
from registry import roles as R
from registry.base import query
from registry.ctes import case_category, case_index, case_region3, case_region8, haversine, in_list, num, out, pad5, strict_main, strings

P6 = "['pm25', 'pm10', 'co', 'no2', 'so2', 'o3', 'PM25', 'xx']"
NAMES = ["pm25", "pm10", "co", "no2", "so2", "o3", "PM25", "xx"]
SCALE = {"pm25": 1.3, "pm10": 1.7, "co": 0.13, "no2": 5.1, "so2": 2.9, "o3": 0.7}


def readings(spark, d):
    """Every event as a reading of one of eight parameter names."""
    return R.events(spark, d).withColumns({"parameter": R.pick(NAMES, F.col("k") % 8)}).select(
        "event_id", "parameter", (F.col("value") * 1.3).alias("c"), "k", "value", "ts", "user_id", "event_type", "sk")


_READ = f"(SELECT event_id, ({P6})[k % 8 + 1] AS parameter, value * 1.3e0 AS c, k, value, ts, user_id, event_type, sk FROM ev)"


@query("us_sub_index", "X1", out(f"(SELECT event_id, parameter, c, {case_index('c', fv.US_BREAKPOINTS, 'parameter')} AS aqi FROM {_READ})", "event_id parameter ~c ~aqi"))
def _(spark, d):
    return readings(spark, d).select("event_id", "parameter", "c", aqi.us_aqi("parameter", "c").alias("aqi"))


@query("national_sub_index", "X2", out(f"(SELECT event_id, parameter, c, {case_index('c', fv.VN_BREAKPOINTS, 'parameter')} AS aqi FROM {_READ})", "event_id parameter ~c ~aqi"))
def _(spark, d):
    return readings(spark, d).select("event_id", "parameter", "c", aqi.vn_aqi("parameter", "c").alias("aqi"))


@query("aqi_categories", "X3", out(f"(SELECT o_orderkey, {case_category('o_totalprice / 1000', fv.AQI_CATEGORIES, 'Hazardous')} AS category FROM orders)", "o_orderkey category"))
def _(spark, d):
    return R.table(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000).alias("v")).select("o_orderkey", aqi.aqi_category("v").alias("category"))


def _inverse() -> str:
    text = "CASE WHEN i <= 0 THEN 0e0"
    for p, bands in fv.US_BREAKPOINTS.items():
        for n, (a, b, lo, hi) in enumerate(bands):
            more = f" OR i > {hi}" if n == len(bands) - 1 else ""
            text += f" WHEN lower(parameter) = '{p}' AND (i BETWEEN {lo} AND {hi}{more}) THEN round({num(a)} + (i - {lo}) * ({num(b)} - {num(a)}) / ({num(hi)} - {num(lo)}), 2)"
    return text + " ELSE i END"


@query("index_to_concentration", "X4", out(f"(SELECT event_id, parameter, {_inverse()} AS concentration FROM (SELECT *, c - 20 AS i FROM {_READ}))", "event_id parameter ~concentration"))
def _(spark, d):
    r = readings(spark, d).withColumn("i", F.col("c") - 20)
    return r.select("event_id", "parameter", aqi.aqi_to_concentration("parameter", "i").alias("concentration"))


@query("main_pollutant_modes", "X5", out(f"""(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {strict_main('', '')} AS strict_name, CASE greatest(pm25, pm10, co, no2, so2, o3) WHEN pm25 THEN 'pm25' WHEN pm10 THEN 'pm10' WHEN co THEN 'co' WHEN no2 THEN 'no2' WHEN so2 THEN 'so2' WHEN o3 THEN 'o3' END AS present_name
  FROM (SELECT *, CASE WHEN l_returnflag <> 'A' THEN l_quantity END AS pm25, l_discount * 400 AS pm10, l_tax * 500 AS co, CASE WHEN l_linestatus = 'O' THEN l_extendedprice / 2500 END AS no2, CAST(l_linenumber * 4 AS DOUBLE) AS so2, CAST(l_suppkey % 50 AS DOUBLE) AS o3 FROM lineitem))""", "l_orderkey l_linenumber l_partkey l_suppkey strict_name present_name"))
def _(spark, d):
    li = R.table(spark, d, "lineitem").withColumns({
        "pm25": F.when(F.col("l_returnflag") != "A", F.col("l_quantity")), "pm10": F.col("l_discount") * 400, "co": F.col("l_tax") * 500,
        "no2": F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice") / 2500), "so2": (F.col("l_linenumber") * 4).cast("double"),
        "o3": (F.col("l_suppkey") % 50).cast("double")})
    subs = {p: p for p in fv.POLLUTANTS}
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", aqi.main_pollutant(subs).alias("strict_name"),
                     aqi.main_pollutant(subs, null_safe=True).alias("present_name"))


@query("unit_conversions", "X6 X7", out(f"""(SELECT event_id, parameter, unit, CASE WHEN unit = 'ppb' THEN c * CASE parameter WHEN 'o3' THEN 1.96e0 WHEN 'no2' THEN 1.88e0 WHEN 'so2' THEN 2.62e0 WHEN 'co' THEN 1.145e0 ELSE 1e0 END
  WHEN unit = 'ppm' AND parameter = 'co' THEN CASE WHEN c >= 10 THEN c * 1.145e0 ELSE c * 1145e0 END ELSE c END AS ugm3, CASE parameter WHEN 'co' THEN c / 1145e0 WHEN 'no2' THEN c * 0.532e0 WHEN 'so2' THEN c * 0.382e0 WHEN 'o3' THEN c * 0.51e0 ELSE c END AS us_units
  FROM (SELECT *, (['ppb', 'ppm', 'µg/m³'])[user_id % 3 + 1] AS unit FROM {_READ}))""", "event_id parameter unit ~ugm3 ~us_units"))
def _(spark, d):
    r = readings(spark, d).withColumn("unit", R.pick(["ppb", "ppm", fv.UNIT_UGM3], F.col("user_id") % 3))
    return r.select("event_id", "parameter", "unit", units.to_ugm3("parameter", "c", "unit").alias("ugm3"), units.to_us_units("parameter", "c").alias("us_units"))


@query("region_maps", "X8", out(f"(SELECT c_custkey, province, {case_region3('province')} AS region_3, {case_region8('province')} AS region_8 FROM (SELECT c_custkey, CASE WHEN c_nationkey = 7 THEN c_mktsegment ELSE ({strings(fv.PROVINCES)})[c_custkey % 34 + 1] END AS province FROM customer))", "c_custkey province region_3 region_8"))
def _(spark, d):
    c = R.table(spark, d, "customer").withColumn("province", F.when(F.col("c_nationkey") == 7, F.col("c_mktsegment")).otherwise(R.pick(fv.PROVINCES, F.col("c_custkey") % 34)))
    return c.select("c_custkey", "province", naming.region_3("province").alias("region_3"), naming.region_8("province").alias("region_8"))


ALIASES = [a.upper() if i % 2 else a for i, a in enumerate(x for xs in fv.PARAMETER_ALIASES.values() for x in xs)] + ["NH3", "Uv"]
_STD = "CASE lower(name)" + "".join(f" WHEN '{a}' THEN '{s}'" for s, xs in fv.PARAMETER_ALIASES.items() for a in xs) + " ELSE lower(name) END"


@query("standard_parameter_names", "X9", out(f"(SELECT event_id, name, {_STD} AS standard FROM (SELECT event_id, ({strings(ALIASES)})[k % {len(ALIASES)} + 1] AS name FROM ev))", "event_id name standard"))
def _(spark, d):
    e = R.events(spark, d).withColumn("name", R.pick(ALIASES, F.col("k") % len(ALIASES)))
    return e.select("event_id", "name", naming.standard_parameter("name").alias("standard"))


@query("time_parsing", "X10", out("(SELECT event_id, CASE WHEN k % 10 = 0 THEN NULL ELSE date_trunc('second', ts) END AS from_unix, CASE WHEN k % 10 = 1 THEN NULL WHEN k % 3 = 0 THEN date_trunc('second', ts) - INTERVAL 7 HOUR ELSE date_trunc('second', ts) END AS from_iso, CASE WHEN k % 10 = 2 THEN NULL ELSE CAST(ts AS DATE) END AS from_date FROM ev)", "event_id from_unix from_iso from_date"))
def _(spark, d):
    k = F.col("k")
    e = R.events(spark, d).withColumns({
        "unix_text": F.when(k % 10 == 0, "n/a").otherwise(F.unix_timestamp("ts").cast("string")),
        "iso_text": F.when(k % 10 == 1, "yesterday").otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(k % 3 == 0, "+07:00").otherwise("Z"))),
        "date_text": F.when(k % 10 == 2, "no date").otherwise(F.date_format("ts", "yyyy-MM-dd"))})
    return e.select("event_id", times.parse_unix("unix_text").alias("from_unix"), times.parse_iso("iso_text").alias("from_iso"), times.parse_date("date_text").alias("from_date"))


@query("station_local_time", "X11", out("(SELECT event_id, date_trunc('second', ts) - CASE WHEN k % 4 = 1 THEN INTERVAL 9 HOUR ELSE INTERVAL 7 HOUR END AS utc FROM ev WHERE k % 4 < 3 UNION ALL SELECT event_id, TIMESTAMP '2024-01-31 00:00:00' FROM ev WHERE k % 4 = 3)", "event_id utc"))
def _(spark, d):
    kind, local = F.col("k") % 4, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    e = R.events(spark, d).select(
        "event_id", F.when(kind == 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00"))).alias("iso"),
        F.when(kind < 3, local).alias("s"), F.when(kind == 1, "+09:00").alias("tz"))
    return e.select("event_id", times.station_time_to_utc("iso", "s", "tz", F.lit(R.AS_OF)).alias("utc"))


@query("great_circle", "X12", out(f"(SELECT w.ward_code, s.station_name, {haversine('s.longitude', 's.latitude', 'w.longitude', 'w.latitude')} AS metres FROM stations s JOIN wards w ON s.ward_code = w.ward_code)", "ward_code station_name ~metres"))
def _(spark, d):
    w = R.wards(spark, d).select("ward_code", "province", F.col("latitude").alias("wlat"), F.col("longitude").alias("wlon"))
    return R.stations(spark, d).join(w.drop("province"), "ward_code").select("ward_code", "station_name", geo.great_circle_m("longitude", "latitude", "wlon", "wlat").alias("metres"))


@query("ward_code_padding", "X13", out(f"(SELECT o_orderkey, {pad5('CAST(o_custkey AS VARCHAR)')} AS code FROM orders)", "o_orderkey code"))
def _(spark, d):
    o = R.table(spark, d, "orders").withColumn("text", F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
    return o.select("o_orderkey", naming.padded_code("text").alias("code"))


@query("congestion_ratios", "X14", out("(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, least(5e0, greatest(0e0, CASE WHEN q > 10 THEN (l_extendedprice * 1.000031415926535e0 / 500 - q) / q WHEN l_tax > 0 THEN 0.1e0 / l_tax - 1 ELSE 0e0 END)) AS ratio FROM (SELECT *, l_quantity AS q FROM lineitem))", "l_orderkey l_linenumber l_partkey l_suppkey ~ratio"))
def _(spark, d):
    q = F.col("l_quantity")
    li = R.table(spark, d, "lineitem").withColumns({"ct": F.col("l_extendedprice") * 1.000031415926535 / 500, "ft": F.when(q > 10, q).otherwise(0.0), "fs": F.lit(0.1)})
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", traffic.congestion_ratio("ct", "ft", "l_tax", "fs").alias("ratio"))


@query("quality_flags", "X15", out(f"(SELECT event_id, parameter, CASE WHEN parameter = 'pm25' AND NOT v BETWEEN 0 AND 500 THEN 'implausible' ELSE 'valid' END AS flag FROM (SELECT *, c * 3 - 10 AS v FROM {_READ}))", "event_id parameter flag"))
def _(spark, d):
    r = readings(spark, d).withColumn("v", F.col("c") * 3 - 10)
    return r.select("event_id", "parameter", units.quality_flag("parameter", "v").alias("flag"))


@query("road_proxy", "X16", out("(SELECT ward_code, CASE nearest_highway_type WHEN 'motorway' THEN 0.9e0 WHEN 'trunk' THEN 0.8e0 WHEN 'primary' THEN 0.7e0 WHEN 'secondary' THEN 0.5e0 WHEN 'tertiary' THEN 0.3e0 WHEN 'residential' THEN 0.1e0 ELSE 0.2e0 END * exp(-distance_to_road_km) AS proxy FROM wards)", "ward_code ~proxy"))
def _(spark, d):
    return R.wards(spark, d).select("ward_code", traffic.road_proxy("nearest_highway_type", "distance_to_road_km").alias("proxy"))


@query("time_truncations", "X18", out("(SELECT event_id, date_trunc('hour', ts) AS hour, CAST(date_trunc('month', ts) AS DATE) AS month, CAST(extract(hour FROM ts + INTERVAL 7 HOUR) AS INTEGER) AS local_hour, CAST(isodow(ts) AS INTEGER) AS day_of_week, CAST(floor(epoch(TIMESTAMP '2024-01-31 00:00:00') / 3600) - floor(epoch(ts) / 3600) AS BIGINT) AS lag_hours FROM ev)", "event_id hour month local_hour day_of_week lag_hours"))
def _(spark, d):
    return R.events(spark, d).select("event_id", times.hour_of("ts").alias("hour"), times.month_of(F.to_date("ts")).alias("month"), times.local_hour("ts").alias("local_hour"),
                                     times.iso_day_of_week("ts").alias("day_of_week"), times.hours_between("ts", F.lit(R.AS_OF)).alias("lag_hours"))


@query("exposure_scores", "X19", out("(SELECT o_orderkey, CAST(o_totalprice * c_acctbal / 1000000e0 AS FLOAT) AS exposure, o_totalprice / nullif(c_acctbal, 0) AS share, CASE WHEN c_acctbal > 8000 THEN 1 ELSE 0 END AS high_flag FROM orders JOIN customer ON o_custkey = c_custkey)", "o_orderkey ^exposure ~share high_flag"))
def _(spark, d):
    o = R.table(spark, d, "orders").join(R.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.select("o_orderkey", (F.col("o_totalprice") * F.col("c_acctbal") / 1_000_000.0).cast("float").alias("exposure"),
                    ratio("o_totalprice", "c_acctbal").alias("share"), F.when(F.col("c_acctbal") > 8000, 1).otherwise(0).alias("high_flag"))


REGION_NAMES = list(fv.REGION_ALIASES) + ["Northern", "unknown place"]
CITY_NAMES = list(fv.CITY_PREFIX_ALIASES) + ["  Huế "]


@query("name_normalisation", "X20", out("(SELECT c_custkey, lower(trim(CASE city" + "".join(f" WHEN '{a}' THEN '{b}'" for a, b in fv.CITY_PREFIX_ALIASES.items()) + " ELSE city END)) AS province, CASE lower(trim(alias))" + "".join(f" WHEN '{a}' THEN '{b}'" for a, b in fv.REGION_ALIASES.items()) + f" ELSE alias END AS region FROM (SELECT c_custkey, ({strings(CITY_NAMES)})[c_custkey % {len(CITY_NAMES)} + 1] AS city, ({strings(REGION_NAMES)})[c_custkey % {len(REGION_NAMES)} + 1] AS alias FROM customer))", "c_custkey province region"))
def _(spark, d):
    c = R.table(spark, d, "customer").withColumns({"city": R.pick(CITY_NAMES, F.col("c_custkey") % len(CITY_NAMES)), "alias": R.pick(REGION_NAMES, F.col("c_custkey") % len(REGION_NAMES))})
    return c.select("c_custkey", naming.normalise_province("city").alias("province"), naming.region_alias("alias").alias("region"))


@query("label_columns", "X21 X22 X23 X25", out(f"""(SELECT o_orderkey, CASE WHEN s >= 0.8e0 THEN 'high' WHEN s >= 0.5e0 THEN 'medium' ELSE 'low' END AS confidence, CASE WHEN p IN {in_list(fv.URBAN_PROVINCES)} THEN 'Urban' WHEN p IN {in_list(fv.INDUSTRIAL_PROVINCES)} THEN 'Industrial' ELSE 'Rural' END AS location,
  CASE WHEN lag <= 1 AND pct >= 90 THEN 'operational' WHEN lag <= 3 AND pct >= 70 THEN 'degraded' ELSE 'delayed' END AS platform, CASE WHEN lag <= 1 THEN 'Fresh' WHEN lag <= 3 THEN 'Delayed' WHEN lag <= 24 THEN 'Stale' ELSE 'Offline' END AS health, CASE WHEN extract(month FROM o_orderdate) BETWEEN 5 AND 10 THEN 'rainy' ELSE 'dry' END AS season
  FROM (SELECT *, o_totalprice / 500000 AS s, ({strings(fv.PROVINCES)})[o_custkey % 34 + 1] AS p, o_orderkey % 30 AS lag, o_custkey % 101 AS pct FROM orders))""", "o_orderkey confidence location platform health season"))
def _(spark, d):
    o = R.table(spark, d, "orders").withColumns({"s": F.col("o_totalprice") / 500000, "p": R.pick(fv.PROVINCES, F.col("o_custkey") % 34), "lag": F.col("o_orderkey") % 30, "pct": F.col("o_custkey") % 101})
    return o.select("o_orderkey", naming.confidence_level("s").alias("confidence"), naming.location_class("p").alias("location"),
                    naming.platform_status("lag", "pct").alias("platform"), naming.health_class("lag").alias("health"), naming.season("o_orderdate").alias("season"))


@query("comparison_windows", "X24", out("(SELECT o_custkey, avg(o_totalprice) FILTER (WHERE o_orderdate BETWEEN TIMESTAMP '1998-02-14' AND TIMESTAMP '1998-03-15 23:59:59') AS current_avg, avg(o_totalprice) FILTER (WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-15' AND TIMESTAMP '1998-02-13 23:59:59') AS previous_avg FROM orders GROUP BY o_custkey)", "o_custkey ~current_avg ~previous_avg"))
def _(spark, d):
    r = times.comparison_ranges(date(1998, 1, 1), date(1998, 3, 15))
    now, before = times.in_range("o_orderdate", r["current_start"], r["current_end"], "hour"), times.in_range("o_orderdate", r["previous_start"], r["previous_end"], "hour")
    return R.table(spark, d, "orders").groupBy("o_custkey").agg(F.avg(F.when(now, F.col("o_totalprice"))).alias("current_avg"), F.avg(F.when(before, F.col("o_totalprice"))).alias("previous_avg"))
