"""Sources, sinks, payloads, incremental flow, streaming and quality checks.

File-based queries write what they derive from the whole tables into a new
shared folder and read it back through the loader under test.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.operators import incremental as inc
from hazeframe.operators import quality, spatial
from hazeframe.operators.retract import LEVELS, DeltaRollup
from hazeframe.plans.stored import SOURCES, StoredModels
from hazeframe.session import shared_folder
from hazeframe.sources import landing, payloads, schemas, sinks
from hazeframe.sources.tables import StoredTable
from hazeframe.streaming import hourly
from registry import roles as R
from registry import model_queries  # noqa: F401  (its entries are referred to)
from registry.base import ENTRIES, query
from registry.ctes import AS_OF, SIX, num, out, with_ctes

RUN = datetime(2024, 1, 31, 1, 2, 3)


def _csv(df, path):
    df.write.option("header", True).option("emptyValue", "").csv(path)


@query("landing_load", "S1 S2 S3", out("""(SELECT 'raw_aqiin_measurements' AS target, 'A' || sk AS name, date_trunc('second', ts) - CASE WHEN k % 2 = 0 THEN INTERVAL 7 HOUR ELSE INTERVAL 0 HOUR END AS at_time, CASE WHEN event_type <> 'error' THEN CAST(k AS DOUBLE) END AS reading, NULL::INTEGER AS closed, 'run-1' AS run FROM ev
  UNION ALL SELECT 'raw_tomtom_traffic', CAST(user_id AS VARCHAR), date_trunc('second', ts), CAST(k AS DOUBLE), CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END, 'run-1' FROM ev UNION ALL SELECT 'unrouted', 'other', NULL, NULL, NULL, NULL)""", "target name at_time ~reading closed run"))
def _(spark, d):
    root, e = shared_folder(spark, "landing"), R.events(spark, d)
    k, stamp = F.col("k"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    _csv(e.select(F.concat(F.lit("A"), F.col("sk").cast("string")).alias("station_name"), F.concat(stamp, F.when(k % 2 == 0, "+07:00").otherwise("Z")).alias("timestamp_utc"),
                  F.when(F.col("event_type") != "error", k).cast("string").alias("value"), F.lit("drop me").alias("unknown_column")), f"{root}/aqi_in")
    _csv(e.select(F.col("user_id").alias("ward_code"), stamp.alias("timestamp_utc"), k.alias("current_speed"), F.when(k % 2 == 0, "True").otherwise("f").alias("road_closure")), f"{root}/tomtom/traffic")
    _csv(e.select("event_id"), f"{root}/other")
    tables, unrouted = landing.load_landing(spark, root, "run-1", RUN)
    none = F.lit(None)
    aq = tables["raw_aqiin_measurements"].select(F.lit("raw_aqiin_measurements").alias("target"), F.col("station_name").alias("name"), F.col("timestamp_utc").alias("at_time"),
                                                 F.col("value").cast("double").alias("reading"), none.cast("int").alias("closed"), F.col("raw_sync_run_id").alias("run"))
    tr = tables["raw_tomtom_traffic"].select(F.lit("raw_tomtom_traffic"), "ward_code", "timestamp_utc", F.col("current_speed").cast("double"), F.col("road_closure").cast("int"), "raw_sync_run_id")
    un = unrouted.select(F.lit("unrouted"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1), none.cast("timestamp"), none.cast("double"), none.cast("int"), none.cast("string"))
    return aq.union(tr).union(un.distinct())


@query("typed_coercion", "S2", out("(SELECT event_id, CASE WHEN k % 5 = 0 THEN NULL ELSE date_trunc('second', ts) END AS at_time, CASE WHEN k % 3 = 0 THEN 1 WHEN k % 3 = 1 THEN 0 END AS flag, CASE WHEN event_type <> 'error' THEN k END AS n FROM ev)", "event_id at_time flag n"))
def _(spark, d):
    k = F.col("k")
    text = R.events(spark, d).select(
        "event_id", F.when(k % 5 == 0, "").otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("Z"))).alias("at_time"),
        F.when(k % 3 == 0, "Yes").when(k % 3 == 1, "false").otherwise("").alias("flag"), F.when(F.col("event_type") != "error", F.concat(k.cast("string"), F.lit(".0"))).otherwise("").alias("n"))
    typed = landing.coerce(text.withColumn("event_id", F.col("event_id").cast("string")), "event_id bigint, at_time timestamp, flag smallint, n int")
    return typed.withColumn("flag", F.col("flag").cast("int"))


@query("lineage_stamps", "S3", out("(SELECT event_id, 'run-7' AS raw_sync_run_id, TIMESTAMP '2024-01-31 01:02:03' AS raw_sync_started_at, 'events.parquet' AS raw_source_file_name, 'batch-1' AS ingest_batch_id, TIMESTAMP '2024-01-31 01:02:03' AS ingest_time, 'feed' AS source FROM events)", "event_id raw_sync_run_id raw_sync_started_at raw_source_file_name ingest_batch_id ingest_time source"))
def _(spark, d):
    stamped = landing.stamp_lineage(R.table(spark, d, "events"), "run-7", RUN)
    return landing.stamp_batch(stamped, "batch-1", RUN, "feed").select("event_id", "raw_sync_run_id", "raw_sync_started_at", "raw_source_file_name", "ingest_batch_id", "ingest_time", "source")


@query("csv_sink", "S4 S7", out("(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders)", "o_orderkey o_custkey o_orderstatus ~o_totalprice o_orderpriority"))
def _(spark, d):
    path = shared_folder(spark, "csv")
    sinks.write_csv(R.table(spark, d, "orders").drop("o_orderdate"), path)
    return landing.read_seed(spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string")


@query("table_append", "S5", with_ctes("SELECT source, last_run, last_success, records_ingested, lag_seconds, error_message, NULL::TIMESTAMP AS updated_at, strftime(last_run, '%Y-%m') AS month FROM control UNION ALL SELECT 'orders', NULL, NULL, count(*), NULL, NULL, NULL, NULL FROM orders"))
def _(spark, d):
    path, schema = shared_folder(spark, "table"), schemas.RAW_SCHEMAS["ingestion_control"]
    sinks.append_table(R.control(spark, d), path, schema, "last_run", ["source"])
    sinks.append_table(R.table(spark, d, "orders").agg(F.count(F.lit(1)).alias("records_ingested")).withColumn("source", F.lit("orders")), path, schema, "last_run", ["source"])
    return spark.read.parquet(path)


@query("recent_export", "S6", out(f"(SELECT event_id, ts, user_id FROM events WHERE ts >= {AS_OF} - INTERVAL 14 DAY)", "event_id ts user_id"))
def _(spark, d):
    path = shared_folder(spark, "export")
    sinks.export_recent(R.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id"), path, "ts", 14, R.AS_OF)
    return spark.read.parquet(path)


@query("materialise_delete_insert", "S8", out("(SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(o_totalprice) * CASE WHEN date_trunc('month', o_orderdate) >= DATE '2000-01-01' THEN 2 ELSE 1 END AS total FROM orders GROUP BY o_custkey, date_trunc('month', o_orderdate))", "o_custkey month ~total"))
def _(spark, d):
    path = shared_folder(spark, "model")
    o = R.table(spark, d, "orders").groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("month")).agg(F.sum("o_totalprice").alias("total"))
    o = o.withColumn("year", F.year("month"))
    inc.materialize(o, "totals", "table", path, partition="year")
    redo = o.filter(F.col("month") >= F.lit("2000-01-01").cast("date")).withColumn("total", F.col("total") * 2)
    return inc.materialize(redo, "totals", "delete_insert", path, ["o_custkey", "month"], "year").drop("year")


@query("materialise_schema_growth", "S8", out("(SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal * 2 WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS s_acctbal, CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey END AS rank, s_nationkey FROM supplier)", "s_suppkey s_name ~s_acctbal rank s_nationkey"))
def _(spark, d):
    """A column joins in a first delete-and-insert; a second one into the same partitions keeps its values."""
    path, s = shared_folder(spark, "grown"), R.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
    inc.materialize(s.drop("s_acctbal"), "s", "table", path, partition="s_nationkey")
    inc.materialize(s.filter("s_suppkey % 2 = 0"), "s", "delete_insert", path, ["s_suppkey", "s_nationkey"], "s_nationkey")
    third = s.filter("s_suppkey % 3 = 0").withColumn("s_acctbal", F.col("s_acctbal") * 2).withColumn("rank", F.col("s_nationkey"))
    inc.materialize(inc.materialize(third, "s", "delete_insert", path, ["s_suppkey", "s_nationkey"], "s_nationkey"), "grown_suppliers", "view")
    return spark.table("grown_suppliers").select("s_suppkey", "s_name", "s_acctbal", "rank", "s_nationkey")


@query("materialise_append", "S8", out("(SELECT s_suppkey, s_name, NULL::DOUBLE AS s_acctbal FROM supplier UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier)", "s_suppkey s_name ~s_acctbal"))
def _(spark, d):
    path, s = shared_folder(spark, "append"), R.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    inc.materialize(s.drop("s_acctbal"), "s", "table", path)
    return inc.materialize(s, "s", "append", path)


_LAYERS = {"ward_hour": ("ward_hourly", "datetime_hour", "ward_code", "pm25_avg", "avg_aqi_us"), "ward_day": ("ward_daily", "date", "ward_code", "pm25_avg", "max_aqi_us"),
           "ward_month": ("ward_monthly", "month", "ward_code", "pm25_avg", "max_aqi_us"), "province_hour": ("province_hourly", "datetime_hour", None, "pm25_avg", "avg_aqi_us"),
           "province_day": ("province_daily", "date", None, "pm25_avg", "max_aqi_us"), "province_month": ("province_monthly", "month", None, "pm25_avg", "max_aqi_us"),
           "traffic_trend": ("traffic_trend", "datetime_hour", None, "pm25", "avg_congestion")}


def _layers_sql():
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, CAST({at} AS TIMESTAMP) AS at_time, province, {ward or 'NULL::VARCHAR'} AS ward_code, source_mix, {pm25} AS pm25, {level} AS level, last_ingested_at FROM {cte}"
        for layer, (cte, at, ward, pm25, level) in _LAYERS.items())


@query("stored_layers", "F1 F2 S8 R4", out(f"({_layers_sql()})", "layer at_time province ward_code source_mix ~pm25 ~level last_ingested_at"))
def _(spark, d):
    """A first run over what had been loaded by one moment, in the middle of an hour; a second one over everything."""
    m, store = R.models(spark, d), StoredModels(spark, shared_folder(spark, "layers"))
    early = {s: m.raw[s].filter(F.col("raw_loaded_at") <= F.lit(datetime(2024, 1, 20, 12, 20))) for s in SOURCES}
    store.run(early | {"stations": m.raw["stations"], "wards": m.raw["wards"]})
    store.run({s: m.raw[s] for s in (*SOURCES, "stations", "wards")})
    parts = [store.layer(layer).select(F.lit(layer).alias("layer"), F.col(at).cast("timestamp").alias("at_time"), "province",
                                       (F.col(ward) if ward else F.lit(None).cast("string")).alias("ward_code"), "source_mix", F.col(pm25).alias("pm25"),
                                       F.col(level).alias("level"), "last_ingested_at") for layer, (_, at, ward, pm25, level) in _LAYERS.items()]
    return reduce(DataFrame.unionByName, parts)


@query("stored_environment", "J9 S8 X19", ENTRIES["unified_environment"].sql)
def _(spark, d):
    """The joined facts of ``unified_environment``, read from layers that are clustered by ward."""
    m, store = R.models(spark, d), StoredModels(spark, shared_folder(spark, "layers"))
    store.run(m.raw)
    return store.unified_environment(m.raw["wards"])


# --- payloads ------------------------------------------------------------------------

@query("air_pollution_payload", "S9 X15", out("""(SELECT event_id, date_trunc('second', ts) AS timestamp_utc, k AS aqi_reported, p.parameter, CASE p.parameter WHEN 'co' THEN v WHEN 'no' THEN v + 1 WHEN 'no2' THEN v + 2 WHEN 'o3' THEN v + 3 WHEN 'so2' THEN v + 4 WHEN 'pm25' THEN v * 2 ELSE v + 6 END AS value,
  CASE WHEN p.parameter = 'pm25' AND v * 2 > 500 THEN 'implausible' ELSE 'valid' END AS quality_flag FROM (SELECT *, CAST(floor(value) AS DOUBLE) AS v FROM ev), (VALUES ('co'), ('no'), ('no2'), ('o3'), ('so2'), ('pm25'), ('pm10')) p(parameter) WHERE date_trunc('second', ts) <= TIMESTAMP '2024-01-20 00:05:00' AND NOT (p.parameter = 'pm10' AND event_type = 'view'))""", "event_id timestamp_utc aqi_reported parameter ~value quality_flag"))
def _(spark, d):
    v = F.floor("value").cast("double")
    e = R.events(spark, d)
    item = F.struct(F.unix_timestamp("ts").alias("dt"), F.struct(F.col("k").alias("aqi")).alias("main"),
                    F.struct(v.alias("co"), (v + 1).alias("no"), (v + 2).alias("no2"), (v + 3).alias("o3"), (v + 4).alias("so2"), (v * 2).alias("pm2_5"),
                             F.when(F.col("event_type") != "view", v + 6).alias("pm10")).alias("components"))
    text = e.select("event_id", F.to_json(F.struct(F.array(item).alias("list"))).alias("payload"))
    return payloads.explode_air_pollution(text, "payload", datetime(2024, 1, 20))


def _station_text(spark, d):
    """Each user answers as one physical station; the first event answers first."""
    k = F.col("k").cast("double")

    def v(c):
        return F.struct(c.alias("v"))
    body = F.struct(
        F.col("user_id").alias("idx"), F.col("k").alias("aqi"),
        F.struct(F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("name"), F.array(F.lit(10.5) + k / 100, F.lit(105.25) + k / 100).alias("geo"), F.lit("u").alias("url")).alias("city"),
        F.struct(v(k).alias("pm25"), v(k * 2).alias("pm10"), v(k / 2).alias("co"), v(k + 3).alias("o3"), v(k / 4).alias("t"), v(k).alias("h")).alias("iaqi"),
        F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("s"), F.lit("+07:00").alias("tz")).alias("time"))
    return R.events(spark, d).select(F.to_json(body).alias("payload"), F.lit("x").alias("station_name"), F.lit(0.0).alias("station_lat"), F.lit(0.0).alias("station_lon"), "event_id")


def _inv(p, i):
    text = f"CASE WHEN {i} <= 0 THEN 0e0"
    for n, (a, b, lo, hi) in enumerate(fv.US_BREAKPOINTS[p]):
        more = f" OR {i} > {hi}" if n == len(fv.US_BREAKPOINTS[p]) - 1 else ""
        text += f" WHEN {i} BETWEEN {lo} AND {hi}{more} THEN round({num(a)} + ({i} - {lo}) * ({num(b)} - {num(a)}) / ({num(hi)} - {num(lo)}), 2)"
    return text + f" ELSE {i} END"


_FIRST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM ev) WHERE rn = 1)"


@query("station_payload", "S10 X4 X11", out("(" + " UNION ALL ".join(
    f"SELECT 'waqi' AS source, 'S' || user_id AS station_name, date_trunc('second', ts) - INTERVAL 7 HOUR AS timestamp_utc, '{p}' AS parameter, {val} AS value, k AS aqi_reported, '{unit}' AS unit, 'valid' AS quality_flag FROM {_FIRST}"
    for p, val, unit in (("pm25", _inv("pm25", "CAST(k AS DOUBLE)"), "µg/m³"), ("pm10", _inv("pm10", "CAST(k * 2 AS DOUBLE)"), "µg/m³"), ("co", _inv("co", "(k / 2e0)"), "ppm"), ("o3", _inv("o3", "CAST(k + 3 AS DOUBLE)"), "ppb"),
                         ("temp", "k / 4e0", "°C"), ("hum", "CAST(k AS DOUBLE)", "%"))) + ")", "source station_name timestamp_utc parameter ~value aqi_reported unit quality_flag"))
def _(spark, d):
    return payloads.explode_station(_station_text(spark, d), "payload", R.AS_OF, "event_id")[0]


@query("station_payload_dimension", "S10", out(f"(SELECT user_id AS station_id, 'S' || user_id AS station_name, 10.5e0 + k / 100e0 AS latitude, 105.25e0 + k / 100e0 AS longitude, 'u' AS city_url FROM {_FIRST})", "station_id station_name ~latitude ~longitude city_url"))
def _(spark, d):
    return payloads.explode_station(_station_text(spark, d), "payload", R.AS_OF, "event_id")[1]


@query("station_feed_payload", "S10", out("(" + " UNION ALL ".join(
    f"SELECT event_id, 'aqiin' AS source, 'F' || user_id AS station_name, ts AS timestamp_utc, '{p}' AS parameter, CAST({val} AS DOUBLE) AS value, '{unit}' AS unit, k AS aqi_reported, 'valid' AS quality_flag FROM ev WHERE event_type <> 'error'{cond}"
    for p, val, unit, cond in (("pm25", "k", "µg/m³", ""), ("co", "k * 10", "ppb", " AND event_type <> 'view'"), ("temp", "k / 4e0", "°C", ""))).replace("SELECT event_id, ", "SELECT ") + ")", "source station_name timestamp_utc parameter ~value unit aqi_reported quality_flag"))
def _(spark, d):
    k = F.col("k").cast("double")
    entry = F.struct(F.concat(F.lit("F"), F.col("user_id").cast("string")).alias("station"),
                     F.struct(k.alias("pm25"), F.when(F.col("event_type") != "view", k * 10).alias("co"), F.col("k").alias("aqi")).alias("iaqi"), F.struct((k / 4).alias("temp_c")).alias("weather"))
    body = F.struct(F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"), F.array(entry).alias("data"))
    return payloads.explode_feed(R.events(spark, d).select("ts", F.to_json(body).alias("payload")), "payload", "ts")


@query("weather_payload", "S11", out("(SELECT event_id, date_trunc('second', ts) AS timestamp_utc, k / 4e0 AS temp, k / 4e0 + 1 AS feels_like, CAST(NULL AS DOUBLE) AS temp_min, CAST(NULL AS DOUBLE) AS temp_max, CAST(1000 + k AS DOUBLE) AS pressure, CAST(k AS DOUBLE) AS humidity, CAST(k * 100 AS BIGINT) AS visibility, CASE WHEN event_type <> 'error' THEN k / 8e0 END AS wind_speed, CAST(k * 3 AS DOUBLE) AS wind_deg, k AS clouds_all FROM ev)", "event_id timestamp_utc ~temp ~feels_like ~temp_min ~temp_max ~pressure ~humidity visibility ~wind_speed ~wind_deg clouds_all"))
def _(spark, d):
    k = F.col("k")
    body = F.struct(F.unix_timestamp("ts").alias("dt"), F.struct((k / 4).alias("temp"), (k / 4 + 1).alias("feels_like"), (k + 1000).alias("pressure"), k.alias("humidity")).alias("main"),
                    (k * 100).alias("visibility"), F.struct(F.when(F.col("event_type") != "error", k / 8).alias("speed"), (k * 3).alias("deg")).alias("wind"), F.struct(k.alias("all")).alias("clouds"))
    return payloads.flatten_weather(R.events(spark, d).select("event_id", F.to_json(body).alias("payload")), "payload", R.AS_OF)


@query("traffic_payload", "S9", out("(SELECT event_id, CAST(k AS DOUBLE) AS current_speed, 60e0 AS free_flow_speed, k + 5 AS current_travel_time, 0 AS free_flow_travel_time, k / 100e0 AS confidence, CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS road_closure FROM ev WHERE event_type <> 'error')", "event_id ~current_speed ~free_flow_speed current_travel_time free_flow_travel_time ~confidence road_closure"))
def _(spark, d):
    k = F.col("k")
    body = F.struct(F.struct(F.when(F.col("event_type") != "error", k).alias("currentSpeed"), F.lit(60.0).alias("freeFlowSpeed"), (k + 5).alias("currentTravelTime"), (k / 100).alias("confidence"), (k % 2 == 0).alias("roadClosure")).alias("flowSegmentData"))
    return payloads.flatten_traffic(R.events(spark, d).select("event_id", F.to_json(body).alias("payload")), "payload")


# --- incremental ----------------------------------------------------------------------------

_MARK = "(SELECT max(last_success) FROM control WHERE source = 'source_0' AND last_run < TIMESTAMP '2024-01-20 00:00:00')"


def _log(spark, d):
    return R.control(spark, d).filter(F.col("last_run") < F.lit(datetime(2024, 1, 20)))


_NEWEST = "(SELECT * FROM (SELECT event_type, value, event_id, date_trunc('hour', ts) AS hour, row_number() OVER (PARTITION BY sk, event_type, date_trunc('hour', ts) ORDER BY event_id DESC) AS r FROM ev) WHERE r = 1 AND event_id % 7 <> 0)"
_DELTA = " UNION ALL ".join(f"SELECT '{g}' AS level, event_type, CAST(date_trunc('{g}', hour) AS TIMESTAMP) AS at_time, count(*) AS n, avg(value) AS avg_value, max(value) AS max_value, min(value) AS min_value FROM {_NEWEST} GROUP BY 2, 3" for g in ("hour", "day", "month"))


@query("delta_rollups", "G2 G3 R1 R2", out(f"({_DELTA})", "level event_type at_time n ~avg_value ~max_value ~min_value"))
def _(spark, d):
    """Readings in three batches, dealt by number: later ones replace, withdraw (every seventh) or come late, and change the levels by difference."""
    e = R.events(spark, d).select("sk", "event_type", F.date_trunc("hour", "ts").alias("timestamp_utc"), "event_id",
                                  F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))
    store = DeltaRollup(spark, shared_folder(spark, "delta-rollups"), ["sk", "event_type"], ["event_type"], version="event_id")
    for k in range(3):
        store.apply(e.filter(F.col("event_id") % 3 == k), k)
    levels = [store.level(name).select(F.lit(name).alias("level"), "event_type", F.col("at").cast("timestamp").alias("at_time"), "n", "avg_value", "max_value", "min_value") for name in LEVELS]
    return reduce(DataFrame.unionByName, levels)


@query("high_water_mark", "F1", with_ctes(f"SELECT event_id, ts, user_id FROM events WHERE ts > {_MARK}"))
def _(spark, d):
    return inc.incremental_filter(R.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id"), _log(spark, d), "source_0", "ts")


@query("affected_hours", "F2 U2 J15", with_ctes(f"SELECT e.event_id, date_trunc('hour', e.ts) AS hour FROM events e WHERE date_trunc('hour', e.ts) IN (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'error' AND ts > {_MARK} UNION SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'view' AND value > 100 AND ts > {_MARK})"))
def _(spark, d):
    e = R.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    new = inc.incremental_filter(e, _log(spark, d), "source_0", "ts").withColumn("hour", F.date_trunc("hour", "ts"))
    keys = inc.affected_keys([new.filter("event_type = 'error'").select("hour"), new.filter("event_type = 'view' AND value > 100").select("hour")])
    return inc.restrict(e.select("event_id", F.date_trunc("hour", "ts").alias("hour")), keys, "hour")


@query("run_control", "R4", with_ctes("SELECT r.source, r.last_run, CASE WHEN r.event_type <> 'error' THEN r.last_run ELSE coalesce(b.s, TIMESTAMP '1970-01-01 00:00:00') END AS last_success, CAST(r.k AS BIGINT) AS records_ingested, CAST(CASE WHEN r.event_type <> 'error' THEN 0 WHEN b.s IS NULL THEN -1 ELSE epoch(r.last_run) - epoch(b.s) END AS BIGINT) AS lag_seconds, r.error_message, r.last_run AS updated_at FROM (SELECT 'source_' || sk AS source, date_trunc('second', ts) AS last_run, k, event_type, CASE WHEN event_type = 'error' THEN 'failed' ELSE '' END AS error_message FROM ev WHERE ts >= TIMESTAMP '2024-01-20 00:00:00') r LEFT JOIN (SELECT source, max(last_success) AS s FROM control WHERE last_run < TIMESTAMP '2024-01-20 00:00:00' AND last_success > TIMESTAMP '1970-01-01 00:00:00' GROUP BY source) b ON r.source = b.source"))
def _(spark, d):
    e = R.events(spark, d).filter(F.col("ts") >= F.lit(datetime(2024, 1, 20)))
    runs = e.select(F.concat(F.lit("source_"), F.col("sk").cast("string")).alias("source"), F.date_trunc("second", "ts").alias("last_run"), F.col("k").alias("records_ingested"),
                    (F.col("event_type") != "error").alias("success"), F.when(F.col("event_type") == "error", "failed").otherwise("").alias("error_message"))
    return inc.control_rows(_log(spark, d), runs)


@query("success_ratio", "R5", out("(SELECT user_id, count(*) FILTER (WHERE event_type <> 'error') AS succeeded, count(*) AS total, count(*) FILTER (WHERE event_type <> 'error') / count(*) AS success_ratio, count(*) FILTER (WHERE event_type <> 'error') / count(*) >= 0.9e0 AS passed FROM events GROUP BY user_id)", "user_id succeeded total ~success_ratio passed"))
def _(spark, d):
    return inc.success_ratio(R.table(spark, d, "events"), F.col("event_type") != "error", ["user_id"])


def _legacy_traffic(spark, d, ingest_time=None):
    """Events as legacy rows (no ward) at the centroid of their user's ward, errors without a latitude; and the mapping to wards."""
    w = R.wards(spark, d).select("ward_code", "latitude", "longitude")
    time = F.col("ts").cast("timestamp")
    e = R.events(spark, d).withColumn("ward_code", R.padded_code("user_id")).join(w, "ward_code").select(
        (time if ingest_time is None else ingest_time(time)).alias("ingest_time"), F.date_trunc("hour", "ts").alias("timestamp_utc"), F.when(F.col("event_type") != "error", F.col("latitude")).alias("latitude"), "longitude",
        F.col("k").cast("double").alias("current_speed"), F.lit(60.0).alias("free_flow_speed"))

    def enrich(df):
        refs = R.wards(spark, d).select("ward_code", "ward_name", F.col("province").alias("province_name"), "nearest_highway_type", "distance_to_road_km", F.col("latitude").alias("ref_lat"), F.col("longitude").alias("ref_lon"))
        return spatial.nearest_enrich(df, refs, ref_key="ward_code")
    return e, enrich


@query("backfill_counts", "R6 J5 A3", with_ctes("SELECT CAST(ts AS DATE) AS ingest_date, count(*) AS rows_before, count(DISTINCT CASE WHEN event_type <> 'error' THEN user_id::VARCHAR || '/' || date_trunc('hour', ts)::VARCHAR END) AS rows_after, count(*) = count(DISTINCT CASE WHEN event_type <> 'error' THEN user_id::VARCHAR || '/' || date_trunc('hour', ts)::VARCHAR END) AS matches FROM events GROUP BY 1"))
def _(spark, d):
    """Legacy rows (no ward) mapped to their nearest ward slice by slice, then counted.

    A user's position is the centroid of its own ward, so each user-hour is one row.
    """
    root = shared_folder(spark, "backfill")
    e, enrich = _legacy_traffic(spark, d)
    inc.backfill(e, enrich, timedelta(days=16), f"{root}/good", f"{root}/bad")
    return inc.reconcile_counts(e, inc.backfilled(spark, f"{root}/good"))


@query("backfill_quarantine", "R6 J5", with_ctes("SELECT CASE WHEN user_id % 10 = 0 THEN 'missing_ingest_time' ELSE 'missing_lat_lon' END AS quarantine_reason, CASE WHEN user_id % 10 = 0 THEN 'slicing' ELSE 'legacy_transform' END AS source_stage, CAST(ts AS DATE) AS at_date, count(*) AS n FROM events WHERE user_id % 10 = 0 OR event_type = 'error' GROUP BY ALL"))
def _(spark, d):
    """What a backfill sets aside: rows of every tenth user have no ingest time, errors have no position."""
    root = shared_folder(spark, "backfill")
    e, enrich = _legacy_traffic(spark, d, lambda time: F.when(F.col("user_id") % 10 != 0, time))
    inc.backfill(e, enrich, timedelta(days=16), f"{root}/good", f"{root}/bad")
    return (inc.quarantined(spark, f"{root}/bad").groupBy("quarantine_reason", "source_stage", F.to_date("timestamp_utc").alias("at_date"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("backfill_replay", "R6 A3", with_ctes("SELECT date_trunc('hour', ts) AS timestamp_utc, count(DISTINCT user_id) AS n_wards, max(date_trunc('second', ts)) AS newest FROM events WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-20 12:20:00' GROUP BY 1"))
def _(spark, d):
    """The rows that arrived since a backfill began, one per ward and hour."""
    e, enrich = _legacy_traffic(spark, d)
    good, _ = inc.replay_delta(e, enrich, datetime(2024, 1, 20, 12, 20))
    return good.groupBy("timestamp_utc").agg(F.count(F.lit(1)).alias("n_wards"), F.date_trunc("second", F.max("ingest_time")).alias("newest"))


# --- streaming --------------------------------------------------------------------------------

def _stream(spark, d):
    """The readings as a file stream."""
    folder = shared_folder(spark, "stream")
    rows = R.raw_station(spark, d, "aqiin").select(F.col("station_name").alias("station_id"), "timestamp_utc", F.lit("aqiin").alias("source"), "parameter", "value", "raw_loaded_at", "raw_sync_run_id")
    rows.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{folder}/in").schema).option("maxFilesPerTrigger", 4).parquet(f"{folder}/in")
    return stream, folder


_HOURS = "(SELECT date_trunc('hour', timestamp_utc) AS datetime_hour, station_name AS station_id, 'aqiin' AS source, parameter AS pollutant, avg(value) AS avg_value, count(*) AS measurement_count, max(value) AS max_value, min(value) AS min_value FROM raw_aqiin WHERE value IS NOT NULL GROUP BY ALL)"
_HOUR_COLS = "datetime_hour station_id source pollutant ~avg_value measurement_count ~max_value ~min_value"


@query("stream_hourly_partials", "R1", out(_HOURS, _HOUR_COLS))
def _(spark, d):
    stream, folder = _stream(spark, d)
    hourly.start_hourly_partials(stream, f"{folder}/out", f"{folder}/ck").awaitTermination()
    return hourly.merge_partials(spark.read.parquet(f"{folder}/out"))


@query("stream_upsert", "R3 A2", out("(SELECT station_name AS station_id, timestamp_utc, parameter, max(raw_loaded_at) AS raw_loaded_at, first(value ORDER BY raw_loaded_at DESC, raw_sync_run_id DESC) AS value, first(raw_sync_run_id ORDER BY raw_loaded_at DESC, raw_sync_run_id DESC) AS raw_sync_run_id FROM raw_aqiin GROUP BY ALL)", "station_id timestamp_utc parameter raw_loaded_at ~value raw_sync_run_id"))
def _(spark, d):
    stream, folder = _stream(spark, d)
    dated = stream.withColumn("day", F.to_date("timestamp_utc"))
    hourly.start_upsert(dated, f"{folder}/out", f"{folder}/ck", ["station_id", "timestamp_utc", "parameter", "day"], "raw_loaded_at", "day", ["raw_sync_run_id"]).awaitTermination()
    return StoredTable(spark, f"{folder}/out", "day").rows().drop("day", "source")


@query("stream_affected_hours", "R2 F2", out(f"(SELECT datetime_hour, count(*) AS readings, avg(value) AS avg_value FROM (SELECT date_trunc('hour', timestamp_utc) AS datetime_hour, value FROM raw_aqiin WHERE parameter IN ({SIX})) GROUP BY datetime_hour)", "datetime_hour readings ~avg_value"))
def _(spark, d):
    stream, folder = _stream(spark, d)

    def build(rows):
        return rows.filter(F.col("parameter").isin(fv.POLLUTANTS)).groupBy(F.date_trunc("hour", "timestamp_utc").alias("datetime_hour")).agg(F.count(F.lit(1)).alias("readings"), F.avg("value").alias("avg_value"))
    hourly.recompute_hours(stream, f"{folder}/history", f"{folder}/out", f"{folder}/ck", build).awaitTermination()
    return StoredTable(spark, f"{folder}/out", "day").rows().drop("day")


_ARRIVED = datetime(2024, 1, 20, 12)
_LATE = "right(raw_sync_run_id, 1) = '0'"
_FIRST = f"(NOT {_LATE} AND timestamp_utc < TIMESTAMP '2024-01-20 12:00:00')"


def _in_two_runs(spark, d, transform, copies):
    """Rows of ``transform(stream)`` over two runs from one checkpoint.

    The first run sees what happened before one moment, the second one the rest
    and a tenth of the earlier rows, which come late; copies of rows come in both.
    """
    folder = shared_folder(spark, "late")
    rows = R.raw_station(spark, d, "aqiin").select(F.col("station_name").alias("station_id"), "timestamp_utc", F.lit("aqiin").alias("source"), "parameter", "value", "raw_sync_run_id")
    last = F.substring("raw_sync_run_id", -1, 1)
    first = (last != "0") & (F.col("timestamp_utc") < F.lit(_ARRIVED))
    for chosen, again in ((first, first & (last == "3")), (~first, first & (last == "5"))):
        part = rows.filter(chosen)
        (part.unionByName(rows.filter(again)) if copies else part).write.mode("append").parquet(f"{folder}/in")
        stream = transform(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"))
        (stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck")
         .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


@query("stream_windowed_hours", "R1", out(f"""(SELECT date_trunc('hour', timestamp_utc) AS datetime_hour, station_name AS station_id, 'aqiin' AS source, parameter AS pollutant, avg(value) AS avg_value, count(*) AS measurement_count, max(value) AS max_value, min(value) AS min_value
  FROM raw_aqiin CROSS JOIN (SELECT max(timestamp_utc) FILTER ({_FIRST}) - INTERVAL 2 HOUR AS before, max(timestamp_utc) - INTERVAL 2 HOUR AS after FROM raw_aqiin WHERE value IS NOT NULL) m
  WHERE value IS NOT NULL AND ({_FIRST} OR date_trunc('hour', timestamp_utc) + INTERVAL 1 HOUR > before) AND date_trunc('hour', timestamp_utc) + INTERVAL 1 HOUR <= after GROUP BY ALL)""", _HOUR_COLS))
def _(spark, d):
    """Hours that the watermark has passed; rows that come after it are dropped, later ones within it count."""
    return _in_two_runs(spark, d, hourly.windowed_hours, copies=False)


@query("stream_deduplicated", "R3", out(f"""(SELECT station_name AS station_id, timestamp_utc, parameter, value, raw_sync_run_id
  FROM raw_aqiin CROSS JOIN (SELECT max(timestamp_utc) FILTER ({_FIRST}) - INTERVAL 1 DAY AS before FROM raw_aqiin) m
  WHERE {_FIRST} OR timestamp_utc > before)""", "station_id timestamp_utc parameter ~value raw_sync_run_id"))
def _(spark, d):
    """Copies within a run and across runs vanish; rows later than the watermark do too."""
    kept = _in_two_runs(spark, d, lambda s: hourly.dedup_stream(s, ["station_id", "timestamp_utc", "parameter", "raw_sync_run_id"], "timestamp_utc"), copies=True)
    return kept.drop("source")


# --- quality -------------------------------------------------------------------------------------

@query("range_violations", "D1", out("(SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 5000 OR o_totalprice > 450000)", "o_orderkey ~o_totalprice"))
def _(spark, d):
    return quality.out_of_range(R.table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 5000, 450000)


@query("duplicate_combinations", "D2", with_ctes("SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL HAVING count(*) > 1"))
def _(spark, d):
    return quality.duplicate_keys(R.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], F.col("l_returnflag") != "A")


@query("duplicates_after_collapse", "D3", with_ctes("SELECT o_orderdate, count(*) AS duplicate_count FROM (SELECT o_custkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey) GROUP BY o_orderdate HAVING count(*) > 1"))
def _(spark, d):
    return quality.duplicate_keys_final(R.table(spark, d, "orders").select("o_custkey", "o_orderdate"), ["o_orderdate"], ["o_custkey"], "o_orderdate")


@query("column_checks", "D4", with_ctes("SELECT 'not_null' AS check_name, count(*) AS violations FROM raw_aqiin WHERE value IS NULL UNION ALL SELECT 'unique', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'accepted_values', count(*) FROM (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('O', 'F')) UNION ALL SELECT 'between', count(*) FROM part WHERE p_size NOT BETWEEN 5 AND 45"))
def _(spark, d):
    checks = {"not_null": quality.nulls(R.raw_station(spark, d, "aqiin"), "value"), "unique": quality.not_unique(R.table(spark, d, "lineitem"), "l_orderkey"),
              "accepted_values": quality.not_accepted(R.table(spark, d, "orders"), "o_orderstatus", ["O", "F"]), "between": quality.not_between(R.table(spark, d, "part"), "p_size", 5, 45)}
    out_ = None
    for name, bad in checks.items():
        row = bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        out_ = row if out_ is None else out_.unionByName(row)
    return out_


@query("freshness_status", "D5", with_ctes(f"SELECT user_id, max(date_trunc('second', ts)) AS latest, CAST(epoch({AS_OF}) - epoch(max(date_trunc('second', ts))) AS BIGINT) AS age_seconds, CASE WHEN epoch({AS_OF}) - epoch(max(date_trunc('second', ts))) > 43200 THEN 'error' WHEN epoch({AS_OF}) - epoch(max(date_trunc('second', ts))) > 21600 THEN 'warn' ELSE 'pass' END AS status FROM events GROUP BY user_id"))
def _(spark, d):
    e = R.table(spark, d, "events").withColumn("ts", F.date_trunc("second", F.col("ts").cast("timestamp")))
    return quality.freshness(e, "ts", R.AS_OF, by=["user_id"])


@query("valid_keys", "F7", with_ctes("SELECT c_custkey, tag FROM (SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN '' WHEN c_nationkey = 4 THEN NULL ELSE c_mktsegment END AS tag FROM customer) WHERE tag <> ''"))
def _(spark, d):
    from hazeframe.functions.predicates import present
    c = R.table(spark, d, "customer").withColumn("tag", F.when(F.col("c_nationkey") == 3, "").when(F.col("c_nationkey") != 4, F.col("c_mktsegment")))
    return c.filter(present("tag")).select("c_custkey", "tag")




_GRAINS = {"ward_hour": ("ward_hourly", ["datetime_hour", "province", "ward_code", "source_mix"]), "ward_day": ("ward_daily", ["date", "province", "ward_code", "source_mix"]),
           "ward_month": ("ward_monthly", ["month", "province", "ward_code", "source_mix"]), "province_hour": ("province_hourly", ["datetime_hour", "province", "source_mix"]),
           "province_day": ("province_daily", ["date", "province", "source_mix"]), "province_month": ("province_monthly", ["month", "province", "source_mix"])}
MODEL_GRAIN = {"hour": "hourly", "day": "daily", "month": "monthly"}
_MIXES, _PARTS = ["observed", "modeled"], [*fv.POLLUTANTS]


def _contract_sql():
    for model, (cte, key) in _GRAINS.items():
        for c in [*key, "main_pollutant"]:
            yield f"SELECT '{model}' AS model, 'required {c}' AS \"check\", count_if({c} IS NULL) AS violations FROM {cte}"
        yield f"SELECT '{model}', 'accepted source_mix', count_if(source_mix NOT IN ('observed', 'modeled')) FROM {cte}"
        yield f"SELECT '{model}', 'accepted main_pollutant', count_if(main_pollutant NOT IN ({', '.join(repr(p) for p in _PARTS)})) FROM {cte}"
        yield f"SELECT '{model}', 'between confidence_score', count_if(NOT confidence_score BETWEEN 0 AND 1) FROM {cte}"
        yield f"SELECT '{model}', 'between avg_aqi_us', count_if(NOT avg_aqi_us BETWEEN 0 AND 500) FROM {cte}"
        yield f"SELECT '{model}', 'unique {' '.join(key)}', count(*) - count(DISTINCT ({', '.join(key)})) FROM {cte}"


@query("model_contracts", "D1 D2 D4", with_ctes(f"SELECT model, \"check\", CAST(violations AS BIGINT) AS violations FROM ({' UNION ALL '.join(_contract_sql())})"))
def _(spark, d):
    """The rules declared for the fact models, over the models themselves."""
    m = R.models(spark, d)
    m.keep("ward_hourly", "ward_daily", "ward_monthly")
    models = {f"{area}_{grain}": (m.ward if area == "ward" else m.province)(grain) for area in ("ward", "province") for grain in ("hour", "day", "month")}
    checks = [quality.contract(models[name], name, [*key, "main_pollutant"], key, {"source_mix": _MIXES, "main_pollutant": _PARTS},
                               {"confidence_score": (0, 1), "avg_aqi_us": (0, 500)}) for name, (_, key) in _GRAINS.items()]
    return reduce(DataFrame.unionByName, checks)


@query("observed_contracts", "D1 D2 D4 R5", ENTRIES["model_contracts"].sql)
def _(spark, d):
    """The counts of ``model_contracts``, taken by the jobs that store the models."""
    m, reports = R.models(spark, d), []
    for name, (_, key) in _GRAINS.items():
        area, grain = name.split("_")
        watch = quality.Watch(name, [*key, "main_pollutant"], key, {"source_mix": _MIXES, "main_pollutant": _PARTS},
                              {"confidence_score": (0, 1), "avg_aqi_us": (0, 500)}, strict=False)
        table = StoredTable(spark, shared_folder(spark, name))
        table.replace_all((m.ward if area == "ward" else m.province)(grain), watch)
        if area == "ward" and (rows := table.rows()) is not None:  # coarser models are built from what is stored
            m.use(f"ward_{MODEL_GRAIN[grain]}", rows)
        reports.append(watch.report(spark))
    return reduce(DataFrame.unionByName, reports)
