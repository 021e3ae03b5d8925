"""Facts and marts of the model graph."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions import predicates
from hazeframe.operators import dedup, distinct, joins, rollup, spatial
from hazeframe.plans import air_quality, marts
from hazeframe.session import stored
from registry import roles as R
from registry.base import ENTRIES, query
from registry.ctes import AS_OF, GRID, MODE_MIX, haversine, out, with_ctes

CONC = " ".join(f"~{p}_avg" for p in fv.POLLUTANTS)
SUB = " ".join(f"~{p}_aqi" for p in fv.POLLUTANTS)
LIN = "raw_loaded_at raw_sync_run_id raw_sync_started_at"
REGION = "region_3 region_8"
COUNTS = "aqiin_observation_count openweather_observation_count"
CONF = "source_mix ~confidence_score confidence_level"
RANGE = "~avg_aqi_us ~max_aqi_us ~min_aqi_us ~avg_aqi_vn ~max_aqi_vn ~min_aqi_vn"
M = R.models


# --- staging ---------------------------------------------------------------------
_STAGED = f"station_name timestamp_utc parameter source aqi_reported quality_flag ingest_time {LIN} ~value unit"


@query("staged_station_rows", "A1 X6", out("(SELECT * FROM staged_aqiin UNION ALL BY NAME SELECT * FROM staged_waqi)", _STAGED))
def _(spark, d):
    m = M(spark, d)
    return m.staged("aqiin").unionByName(m.staged("waqi"))


@query("staged_modelled_rows", "A1", out("staged_openweather", f"ward_code ward_name province ~latitude ~longitude timestamp_utc parameter source quality_flag ~value aqi_reported ingest_time {LIN}"))
def _(spark, d):
    return M(spark, d).staged("openweather")


_PROC = f"{_STAGED} ward_code province ~latitude ~longitude ~value_us_standard ~aqi_vn ~aqi_us {REGION}"


@query("station_attach", "J1 X1 X2 X7 X8", out("processed_aqiin", _PROC))
def _(spark, d):
    return M(spark, d).processed("aqiin")


@query("station_attach_second_network", "J1", out("processed_waqi", _PROC))
def _(spark, d):
    return M(spark, d).processed("waqi")


@query("modelled_indices", "X1 X2 X7 X8", out("processed_openweather", f"ward_code ward_name province ~latitude ~longitude timestamp_utc parameter source quality_flag ~value aqi_reported ingest_time {LIN} ~value_us_standard ~aqi_vn ~aqi_us {REGION}"))
def _(spark, d):
    return M(spark, d).processed("openweather")


@query("observed_fusion", "W1 U1 F9", out("observed", f"{_PROC} ~latitude_rounded ~longitude_rounded version"))
def _(spark, d):
    return M(spark, d).observed_processed


_HOURLY = f"datetime_hour date ward_code province {REGION} ~avg_aqi_vn ~avg_aqi_us {CONC} {SUB} observation_count main_pollutant last_ingested_at {LIN}"
for _source in ("aqiin", "waqi", "openweather", "observed"):
    @query(f"hourly_pivot_{_source}", "G1", out(f"hourly_{_source}", _HOURLY))
    def _(spark, d, source=_source):
        return M(spark, d).source_hourly(source)


@query("unified_calibrated", "J7 F8 G9 U1", out("unified", f"source ward_code province ~latitude ~longitude timestamp_utc parameter aqi_reported quality_flag ingest_time {LIN} ~raw_value ~value source_weight {REGION}"))
def _(spark, d):
    return M(spark, d).unified


@query("station_distance_flags", "G9 X12", out("(SELECT ward_code, nearest_station_distance_m, nearest_station_distance_m <= 2000 AS has_nearby_station FROM flags)", "ward_code ~nearest_station_distance_m has_nearby_station"))
def _(spark, d):
    return spatial.station_flags(R.stations(spark, d), R.wards(spark, d))


@query("unified_indices", "F3 X1 X2", with_ctes(f"SELECT source, ward_code, timestamp_utc, parameter, max_aqi_us_in_hour, max_aqi_vn_in_hour, is_dominant_us, is_dominant_vn, round(value_us_standard, 6) + 0e0 AS value_us_standard, raw_sync_run_id, round(value, 6) + 0e0 AS value FROM (SELECT *, CAST(NULL AS DOUBLE) AS max_aqi_us_in_hour, CAST(NULL AS DOUBLE) AS max_aqi_vn_in_hour, false AS is_dominant_us, false AS is_dominant_vn, CASE WHEN parameter = 'co' THEN value / 1145e0 WHEN parameter = 'no2' THEN value * 0.532e0 WHEN parameter = 'so2' THEN value * 0.382e0 WHEN parameter = 'o3' THEN value * 0.51e0 ELSE value END AS value_us_standard FROM unified) WHERE parameter IN ('pm25', 'pm10', 'co', 'no2', 'so2', 'o3')"))
def _(spark, d):
    return air_quality.aqi_calculations(M(spark, d).unified).select(
        "source", "ward_code", "timestamp_utc", "parameter", "max_aqi_us_in_hour", "max_aqi_vn_in_hour", "is_dominant_us",
        "is_dominant_vn", "value_us_standard", "raw_sync_run_id", "value")


@query("other_measurements", "F3", out("(SELECT *, timestamp_utc AS datetime_hour, CAST(timestamp_utc AS DATE) AS date FROM unified WHERE parameter NOT IN ('pm25', 'pm10', 'co', 'no2', 'so2', 'o3'))", f"source ward_code province ~latitude ~longitude datetime_hour date parameter aqi_reported quality_flag ingest_time {LIN} ~raw_value ~value source_weight {REGION}"))
def _(spark, d):
    return air_quality.other_measurements(M(spark, d).unified)


# --- facts ---------------------------------------------------------------------------

@query("ward_hours", "U1 G1", out("ward_hourly", f"datetime_hour date ward_code province {REGION} ~avg_aqi_vn ~avg_aqi_us {CONC} {SUB} {COUNTS} {CONF} main_pollutant last_ingested_at {LIN}"))
def _(spark, d):
    return M(spark, d).ward_hourly


_ROLL = f"{RANGE} {CONC} {SUB} {COUNTS} {CONF} main_pollutant last_ingested_at {LIN} province {REGION}"


@query("ward_days", "G2", out("ward_daily", f"date ward_code {_ROLL}"))
def _(spark, d):
    return M(spark, d).ward_daily


@query("ward_months", "G3", out("ward_monthly", f"month ward_code samples_count {_ROLL}"))
def _(spark, d):
    return M(spark, d).ward_monthly


@query("province_hours", "G4", out("province_hourly", f"datetime_hour date total_ward_count aqiin_ward_count openweather_ward_count ~avg_aqi_us ~avg_aqi_vn {CONC} {SUB} {COUNTS} {CONF} main_pollutant last_ingested_at {LIN} province {REGION}"))
def _(spark, d):
    return M(spark, d).province("hour")


@query("province_days", "G4", out("province_daily", f"date total_ward_count aqiin_ward_count openweather_ward_count {_ROLL}"))
def _(spark, d):
    return M(spark, d).province("day")


@query("province_months", "G4", out("province_monthly", f"month total_ward_count aqiin_ward_count openweather_ward_count {_ROLL}"))
def _(spark, d):
    return M(spark, d).province("month")


def _national(source, grain, ts, mx_us, mx_vn):
    return f"""SELECT '{grain}' AS time_grain, {ts} AS timestamp, avg(avg_aqi_us) AS avg_aqi_us, max({mx_us}) AS max_aqi_us, avg(avg_aqi_vn) AS avg_aqi_vn, max({mx_vn}) AS max_aqi_vn,
      count(DISTINCT CASE WHEN avg_aqi_us IS NOT NULL THEN province END) AS active_provinces_us, count(DISTINCT CASE WHEN avg_aqi_vn IS NOT NULL THEN province END) AS active_provinces_vn, 0 AS active_wards,
      first(main_pollutant ORDER BY avg_aqi_us DESC, province DESC, source_mix DESC) FILTER (WHERE avg_aqi_us IS NOT NULL) AS dominant_pollutant_us,
      first(main_pollutant ORDER BY avg_aqi_vn DESC, province DESC, source_mix DESC) FILTER (WHERE avg_aqi_vn IS NOT NULL) AS dominant_pollutant_vn,
      avg(confidence_score) AS confidence_score, {MODE_MIX} AS dominant_source_mix, max(last_ingested_at) AS last_ingested_at FROM {source} GROUP BY {ts}"""


@query("national_series", "G5 U1", out("(" + _national("province_hourly", "hourly", "datetime_hour", "avg_aqi_us", "avg_aqi_vn") + " UNION ALL " + _national("province_daily", "daily", "CAST(date AS TIMESTAMP)", "max_aqi_us", "max_aqi_vn") + ")", "time_grain timestamp ~avg_aqi_us ~max_aqi_us ~avg_aqi_vn ~max_aqi_vn active_provinces_us active_provinces_vn active_wards dominant_pollutant_us dominant_pollutant_vn ~confidence_score dominant_source_mix last_ingested_at"))
def _(spark, d):
    m = M(spark, d)
    m.keep("ward_hourly")
    return rollup.national_summary(m.province("hour"), m.province("day"))


@query("province_population", "G6", out("population", "location_name ~total_population ~area_km2 ~density_per_km2"))
def _(spark, d):
    return M(spark, d).population


@query("hourly_source_summary", "U1 F10", out("hourly_summary", f"datetime_hour date province ward_code {REGION} source ~source_weight ~final_aqi_us ~final_aqi_vn " + " ".join(f"~{p}_value" for p in fv.POLLUTANTS) + f" {SUB} dominant_pollutant_us dominant_pollutant_vn ingest_time {LIN}"))
def _(spark, d):
    return M(spark, d).hourly_summary


@query("daily_source_summary", "F10", out("daily_summary", f"date province ward_code {REGION} source ~daily_avg_aqi_us ~daily_avg_aqi_vn ~daily_max_aqi_us ~daily_max_aqi_vn " + " ".join(f"~{p}_daily_avg ~{p}_daily_aqi" for p in fv.POLLUTANTS) + f" ~pm25_daily_max ~pm10_daily_max dominant_pollutant_us dominant_pollutant_vn hourly_count ingest_time {LIN}"))
def _(spark, d):
    return rollup.source_summary(M(spark, d).ward_daily, "day")


@query("monthly_source_summary", "F10", out("monthly_summary", f"month province ward_code {REGION} source ~monthly_avg_aqi_us ~monthly_avg_aqi_vn ~monthly_max_aqi_us ~monthly_min_aqi_us " + " ".join(f"~{p}_monthly_avg" for p in fv.POLLUTANTS) + f" dominant_pollutant_vn ingest_time {LIN}"))
def _(spark, d):
    return rollup.source_summary(M(spark, d).ward_monthly, "month")


OVER = (f"province ward_code ward_name {REGION} ~latitude ~longitude ~population ~avg_aqi_us ~max_aqi_us ~avg_aqi_vn ~max_aqi_vn main_pollutant "
        f"{CONC} {COUNTS} {CONF} last_ingested_at")
for _grain, _keys in (("hour", "datetime_hour date"), ("day", "date"), ("month", "date month samples_count")):
    @query(f"overview_{_grain}", "J11 F7", out(f"overview_{_grain}", f"{_keys} {OVER}"))
    def _(spark, d, grain=_grain):
        return M(spark, d).overview(grain)


@query("observed_days", "F6", out("(SELECT * FROM overview_day WHERE confidence_score >= 0.5 AND source_mix IN ('observed', 'mixed'))", f"date {OVER}"))
def _(spark, d):
    return M(spark, d).overview("day").filter(predicates.observed())


@query("modelled_days", "F6", out("(SELECT * FROM overview_day WHERE source_mix = 'modeled' OR confidence_score < 0.5)", f"date {OVER}"))
def _(spark, d):
    return M(spark, d).overview("day").filter(predicates.modeled())


@query("scoped_predicate", "F4", out("(SELECT * FROM overview_day WHERE source_mix = 'observed' AND region_3 = 'Northern' AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' UNION ALL SELECT * FROM overview_day WHERE region_8 = 'Central Highlands' AND date = DATE '2024-01-09' UNION ALL SELECT * FROM overview_day WHERE province = 'Đồng Nai')", f"date {OVER}"))
def _(spark, d):
    o = M(spark, d).overview("day")
    w = predicates.build_where
    scopes = [w("region", "Northern", [date(2024, 1, 5), date(2024, 1, 20)], mix="observed"),
              w("area", "Central Highlands", [date(2024, 1, 9)]), w("province", "Đồng Nai")]
    return predicates.once_per_scope(o, scopes)


@query("scoped_hours", "F4", out("(SELECT * FROM overview_hour WHERE datetime_hour BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-06 05:00:00')", f"datetime_hour date {OVER}"))
def _(spark, d):
    where = predicates.build_where(dates=[datetime(2024, 1, 5, 6), datetime(2024, 1, 6, 5)], unit="hour")
    return M(spark, d).overview("hour").filter(where)


@query("month_aligned_predicate", "F5", out("(SELECT * FROM overview_month WHERE date BETWEEN DATE '2023-12-01' AND DATE '2024-01-01')", f"date month samples_count {OVER}"))
def _(spark, d):
    return M(spark, d).overview("month").filter(predicates.monthly_where([date(2023, 12, 17), date(2024, 1, 20)]))


# --- weather and traffic ----------------------------------------------------------------

@query("grid_weather", "J2 X26", out("staged_weather", f"ward_code ward_name province ~latitude ~longitude timestamp_utc ~temp ~temp_min ~temp_max ~feels_like ~humidity pressure visibility_meters ~wind_speed wind_deg clouds_all ingest_time {LIN}"))
def _(spark, d):
    return air_quality.stage_weather(R.raw_weather(spark, d), R.wards(spark, d)).drop("source")


_W = ("temperature", "humidity", "wind_speed", "wind_direction", "pressure")


@query("weather_hours", "G7 W2", out("weather_hourly", f"datetime_hour date province ward_code {' '.join(f'~{c} ~province_{c}' for c in _W)} is_high_humidity_suppression is_stagnant_air_risk ~stagnant_air_probability {LIN}"))
def _(spark, d):
    return M(spark, d).weather_hourly


@query("province_fallback_window", "W2", out("(SELECT province, ward_code, datetime_hour, temperature, humidity, avg(temperature) OVER w AS province_temperature, avg(humidity) OVER w AS province_humidity FROM weather_hourly WINDOW w AS (PARTITION BY province, datetime_hour))", "province ward_code datetime_hour ~temperature ~humidity ~province_temperature ~province_humidity"))
def _(spark, d):
    base = M(spark, d).weather_hourly.select("province", "ward_code", "datetime_hour", "temperature", "humidity")
    return air_quality.partition_mean(base, ["province", "datetime_hour"], ["temperature", "humidity"])


@query("traffic_latest", "W4 X13 X14", out("staged_traffic", f"source ward_code ward_name province_name ~latitude ~longitude timestamp_utc ~value parameter traffic_source ~quality_flag ingest_time {LIN}"))
def _(spark, d):
    return M(spark, d).traffic_staged


@query("traffic_pattern", "F11", out("(SELECT ward_code, ward_name AS station_name, province_name, latitude, longitude, timestamp_utc, value AS estimated_congestion_ratio, quality_flag AS data_quality_flag FROM staged_traffic)", "ward_code station_name province_name ~latitude ~longitude timestamp_utc ~estimated_congestion_ratio ~data_quality_flag"))
def _(spark, d):
    return air_quality.traffic_pattern(M(spark, d).traffic_staged)


@query("traffic_hours", "G8", out("traffic_hourly", f"ward_code province datetime_hour date ~congestion_index traffic_data_type {LIN}"))
def _(spark, d):
    return M(spark, d).traffic_hourly


_ENV = f"""(SELECT a.* EXCLUDE (raw_loaded_at, raw_sync_run_id, raw_sync_started_at), g.latitude, g.longitude, w.* EXCLUDE (province, ward_code, datetime_hour, wl, wr, ws), t.congestion_index, t.traffic_data_type,
  CASE WHEN w.humidity > 80 THEN 1 ELSE 0 END AS is_high_humidity_suppression, CASE WHEN w.wind_speed < 1 THEN 1 ELSE 0 END AS is_stagnant_air_risk,
  CASE WHEN w.wind_speed < 1 THEN 1e0 ELSE 0e0 END AS stagnant_air_probability, 0e0 AS weather_influence_pct, CAST(p.total_population AS BIGINT) AS provincial_population,
  a.pm25 * CAST(p.total_population AS BIGINT) / 1000000e0 AS population_exposure_score, a.pm25 * t.congestion_index AS traffic_pollution_impact_score, 0e0 AS traffic_contribution_pct,
  CASE WHEN t.congestion_index > 0 THEN a.pm25 / t.congestion_index ELSE 0e0 END AS traffic_pollution_ratio,
  greatest(a.raw_loaded_at, coalesce(w.wl, a.raw_loaded_at), coalesce(t.raw_loaded_at, a.raw_loaded_at)) AS raw_loaded_at, coalesce(t.raw_sync_run_id, w.wr, a.raw_sync_run_id, '') AS raw_sync_run_id,
  greatest(a.raw_sync_started_at, coalesce(w.ws, a.raw_sync_started_at), coalesce(t.raw_sync_started_at, a.raw_sync_started_at)) AS raw_sync_started_at
  FROM (SELECT datetime_hour, province, ward_code, {', '.join(f"first({s} ORDER BY last_ingested_at DESC, source_mix DESC) FILTER (WHERE {s} IS NOT NULL) AS {t}" for s, t in (('date', 'date'), ('region_3', 'region_3'), ('region_8', 'region_8'), ('avg_aqi_us', 'aqi_us'), ('avg_aqi_vn', 'aqi_vn'), ('pm25_avg', 'pm25'), ('pm10_avg', 'pm10'), ('co_avg', 'co'), ('main_pollutant', 'main_pollutant'), ('source_mix', 'source_mix'), ('confidence_score', 'confidence_score'), ('confidence_level', 'confidence_level')))},
    CAST(sum(aqiin_observation_count) AS BIGINT) AS aqiin_observation_count, CAST(sum(openweather_observation_count) AS BIGINT) AS openweather_observation_count, max(raw_loaded_at) AS raw_loaded_at,
    first(raw_sync_run_id ORDER BY raw_loaded_at DESC, raw_sync_run_id DESC) AS raw_sync_run_id, first(raw_sync_started_at ORDER BY raw_loaded_at DESC, raw_sync_run_id DESC) AS raw_sync_started_at
    FROM ward_hourly GROUP BY datetime_hour, province, ward_code) a
  LEFT JOIN (SELECT province, ward_code, datetime_hour, {', '.join(f'coalesce({c}, province_{c}) AS {c}' for c in _W)}, raw_loaded_at AS wl, raw_sync_run_id AS wr, raw_sync_started_at AS ws FROM weather_hourly) w
    ON a.province = w.province AND a.ward_code = w.ward_code AND a.datetime_hour = w.datetime_hour
  LEFT JOIN traffic_hourly t ON a.ward_code = t.ward_code AND a.datetime_hour = t.datetime_hour LEFT JOIN dim g ON a.ward_code = g.ward_code LEFT JOIN population p ON a.province = p.location_name)"""


@query("unified_environment", "J9 X19", out(_ENV, f"datetime_hour date province ward_code {REGION} ~latitude ~longitude ~aqi_us ~aqi_vn ~pm25 ~pm10 ~co main_pollutant {CONF} {COUNTS} {' '.join('~' + c for c in _W)} ~congestion_index traffic_data_type is_high_humidity_suppression is_stagnant_air_risk ~stagnant_air_probability ~weather_influence_pct provincial_population ^population_exposure_score ^traffic_pollution_impact_score ~traffic_contribution_pct ^traffic_pollution_ratio {LIN}"))
def _(spark, d):
    return M(spark, d).unified_env


# --- marts ---------------------------------------------------------------------------------

@query("current_status", "G10", out("current_status", f"province ward_code {REGION} ~latitude ~longitude latest_hour ~current_aqi_us ~current_aqi_vn ~pm25 ~pm10 main_pollutant {COUNTS} {CONF} data_source ingest_time"))
def _(spark, d):
    m = M(spark, d)
    return marts.current_status(m.ward_hourly, m.dim)


@query("compliance_days", "G11", out("compliance", f"date province {REGION} ~pm25_avg ~pm10_avg ~confidence_score source_mix who_pm25_breach who_pm10_breach tcvn_pm25_breach tcvn_pm10_breach compliance_status ingest_time"))
def _(spark, d):
    return marts.compliance(M(spark, d).province("day"))


@query("health_impact", "G12 J8", out("""(SELECT date, province, ward_code, min(h.region_3) AS region_3, min(h.region_8) AS region_8, count(*) AS total_hours, count(*) FILTER (WHERE avg_aqi_us IS NULL OR avg_aqi_us > 150) AS high_risk_hours,
  count(*) FILTER (WHERE avg_aqi_us IS NULL OR avg_aqi_us > 150) / count(*) AS high_risk_exposure_pct,
  first(health_effects ORDER BY avg_aqi_us DESC, source_mix DESC, datetime_hour DESC) FILTER (WHERE health_effects IS NOT NULL) AS primary_health_advice, avg(confidence_score) AS confidence_score,
  """ + f"CASE WHEN count(*) FILTER (WHERE confidence_level = 'medium') > count(*) FILTER (WHERE confidence_level = 'high') THEN 'medium' ELSE 'high' END AS confidence_level, {MODE_MIX} AS source_mix" + """, max(last_ingested_at) AS ingest_time
  FROM ward_hourly h LEFT JOIN bands b ON h.main_pollutant = b.pollutant_key AND h.avg_aqi_us >= b.lo AND h.avg_aqi_us <= b.hi GROUP BY date, province, ward_code)""", f"date province ward_code {REGION} total_hours high_risk_hours ~high_risk_exposure_pct primary_health_advice ~confidence_score confidence_level source_mix ingest_time"))
def _(spark, d):
    return marts.health_impact(M(spark, d).ward_hourly, R.bands(spark))


@query("temporal_patterns", "G13 X18", out(f"(SELECT province, region_3, region_8, CAST(extract(hour FROM datetime_hour) AS INTEGER) AS hour_of_day, CAST(isodow(datetime_hour) AS INTEGER) AS day_of_week, avg(avg_aqi_us) AS avg_aqi_us, avg(avg_aqi_vn) AS avg_aqi_vn, avg(pm25_avg) AS avg_pm25, avg(pm10_avg) AS avg_pm10, avg(confidence_score) AS confidence_score, {MODE_MIX} AS dominant_source_mix, count(*) AS reading_count, max(last_ingested_at) AS ingest_time FROM province_hourly GROUP BY ALL)", f"province {REGION} hour_of_day day_of_week ~avg_aqi_us ~avg_aqi_vn ~avg_pm25 ~avg_pm10 ~confidence_score dominant_source_mix reading_count ingest_time"))
def _(spark, d):
    return marts.temporal_patterns(M(spark, d).province("hour"))


@query("source_fingerprint", "G14", out("fingerprint", f"date province ward_code {REGION} source_mix ~pm25 ~pm10 ~confidence_score confidence_level ingest_time ~pm25_pm10_ratio probable_source"))
def _(spark, d):
    return marts.fingerprint(M(spark, d).ward_hourly)


def trend(m):
    return marts.traffic_trend(m.traffic_staged, m.dim, m.province("hour"))


def weather_rows(m):
    return marts.weather_trend(*m.ward_hourly_placed, ward="place")


def weather_values(m):
    """``weather_rows`` for marts that return no lineage."""
    return weather_rows(m.values)


@query("traffic_trend", "G15", out("traffic_trend", f"datetime_hour date province ward_code {REGION} ~pm25 ~pm10 ~co {CONF} ~avg_congestion ~congestion_index traffic_sample_count traffic_ward_count positive_traffic_ward_count last_traffic_ingested_at last_ingested_at ^traffic_coverage_ratio ^traffic_pollution_impact_score ^traffic_contribution_pct"))
def _(spark, d):
    return trend(M(spark, d))


@query("weather_trend", "G16", out("weather_trend", f"datetime_hour date province ward_code {REGION} ~pm25 ~pm10 ~wind_speed ~humidity ~wind_direction ~temperature ^weather_influence_pct ~stagnant_air_probability {CONF} {LIN}"))
def _(spark, d):
    return weather_rows(M(spark, d))


@query("traffic_correlation", "G17 J12 X22", out("traffic_daily", f"date province ward_code {REGION} location_type ~pm25_daily_avg ~pm10_daily_avg ~congestion_daily_avg ~sum_pm25 ~sum_pm10 total_hours ~avg_traffic_ward_count ~avg_positive_traffic_ward_count ~avg_traffic_coverage_ratio {CONF} ~low_congestion_threshold ~high_congestion_threshold ~pm25_low_congestion_avg ~pm25_high_congestion_avg low_congestion_hours high_congestion_hours ^pm25_congestion_uplift ^traffic_pollution_impact_score ^traffic_contribution_pct"))
def _(spark, d):
    return marts.traffic_correlation(trend(M(spark, d)))


@query("weather_correlation", "G18", out("weather_daily", f"date province ward_code {REGION} ~pm25_daily_avg ~pm10_daily_avg ~temp_daily_avg ~humidity_daily_avg ~wind_daily_avg ~sum_pm25 ~sum_pm10 total_hours ~stagnant_pm25_sum ~stagnant_pm10_sum stagnant_hours ~dispersive_pm25_sum ~dispersive_pm10_sum dispersive_hours ^wind_dispersal_risk_index ^weather_influence_pct ~stagnant_air_probability {CONF}"))
def _(spark, d):
    return marts.weather_correlation(weather_values(M(spark, d)))


def health(m):
    return marts.data_health(m.hourly_summary, R.AS_OF)


@query("source_health_rows", "G19 X23", out("health", f"province {REGION} ward_code source last_seen last_ingested_at last_loaded_at observation_lag_hours ingest_lag_hours lag_hours health_status is_reliable"))
def _(spark, d):
    return health(M(spark, d))


def _health_sql(by=""):
    lag = "CAST(floor(epoch(TIMESTAMP '2024-01-31 00:00:00') / 3600) - floor(epoch({0}) / 3600) AS BIGINT)"
    return f"""SELECT {by} count(*) AS source_ward_count, count(*) FILTER (WHERE is_reliable) AS reliable_count, round(100e0 * count(*) FILTER (WHERE is_reliable) / nullif(count(*), 0), 1) AS reliable_pct,
  max(last_seen) AS latest_reading_at, {lag.format('max(last_seen)')} AS latest_lag_hours, max(last_ingested_at) AS latest_ingested_at, {lag.format('max(last_ingested_at)')} AS latest_ingest_lag_hours,
  round(avg(observation_lag_hours) FILTER (WHERE health_status <> 'Offline'), 2) AS active_avg_lag_hours, round(avg(observation_lag_hours), 2) AS all_avg_lag_hours,
  count(*) FILTER (WHERE health_status = 'Fresh') AS fresh_count, count(*) FILTER (WHERE health_status = 'Delayed') AS delayed_count, count(*) FILTER (WHERE health_status = 'Stale') AS stale_count,
  count(*) FILTER (WHERE health_status = 'Offline') AS offline_count, count(*) FILTER (WHERE health_status IN ('Stale', 'Offline')) AS attention_count, max(observation_lag_hours) AS worst_lag_hours FROM health"""


HEALTH_SQL = _health_sql()
HEALTH_BY_SOURCE_SQL = _health_sql("source,") + " GROUP BY source"


@query("platform_health", "G20", with_ctes(HEALTH_SQL))
def _(spark, d):
    return marts.health_summary(health(M(spark, d)), R.AS_OF)


@query("platform_health_by_source", "G20", with_ctes(HEALTH_BY_SOURCE_SQL))
def _(spark, d):
    return marts.health_summary(health(M(spark, d)), R.AS_OF, ["source"])


@query("platform_status_distribution", "G20", with_ctes("SELECT source, health_status, count(*) AS source_ward_count, round(avg(observation_lag_hours), 2) AS avg_lag_hours FROM health GROUP BY source, health_status"))
def _(spark, d):
    return marts.status_distribution(health(M(spark, d)))


_BIAS = """(SELECT *, a - o AS aqi_bias, abs(a - o) AS aqi_mae, (a - o) / nullif(o, 0) * 100 AS aqi_pct_diff, a AS aqiin_aqi, o AS ow_aqi,
  CASE WHEN a > 150 AND o > 150 THEN 'both_unhealthy' WHEN a <= 50 AND o <= 50 THEN 'both_good' WHEN a IS NULL OR o IS NULL THEN 'one_source_only' ELSE 'disagree' END AS category_agreement,
  aqiin_wards > 0 AS has_ground_data, aqiin_wards * 100e0 / nullif(ow_wards, 0) AS ground_coverage_pct
  FROM (SELECT coalesce(x.date, y.date) AS date, coalesce(x.province, y.province) AS province, x.aqi AS a, y.aqi AS o, x.pm AS aqiin_pm25, y.pm AS ow_pm25, x.n AS aqiin_wards, y.n AS ow_wards
    FROM (SELECT date, province, avg(avg_aqi_vn) AS aqi, avg(pm25_avg) AS pm, count(DISTINCT ward_code) AS n FROM ward_daily WHERE source_mix = 'observed' GROUP BY date, province) x
    FULL JOIN (SELECT date, province, avg(avg_aqi_vn) AS aqi, avg(pm25_avg) AS pm, count(DISTINCT ward_code) AS n FROM ward_daily WHERE source_mix = 'modeled' GROUP BY date, province) y
    ON x.date = y.date AND x.province = y.province))"""


@query("source_bias", "G21 J10", out(_BIAS, "date province ~aqiin_aqi ~ow_aqi ~aqiin_pm25 ~ow_pm25 ~aqi_bias ~aqi_mae ~aqi_pct_diff category_agreement aqiin_wards ow_wards has_ground_data ~ground_coverage_pct"))
def _(spark, d):
    return joins.compare_sources(M(spark, d).ward_daily)


@query("source_coverage", "J13", out(f"""(SELECT t.province, t.n AS total_ward_count, count(DISTINCT a.ward_code) AS aqiin_ward_count, count(DISTINCT o.ward_code) AS ow_ward_count, count(DISTINCT a.ward_code) * 100e0 / nullif(t.n, 0) AS aqiin_coverage_pct,
  max(a.h) AS aqiin_latest_hour, max(o.h) AS ow_latest_hour FROM (SELECT province, count(DISTINCT ward_code) AS n FROM dim WHERE province <> '' GROUP BY province) t
  LEFT JOIN (SELECT province, ward_code, max(datetime_hour) AS h FROM hourly_aqiin WHERE datetime_hour >= {AS_OF} - INTERVAL 7 DAY GROUP BY ALL) a ON t.province = a.province
  LEFT JOIN (SELECT province, ward_code, max(datetime_hour) AS h FROM hourly_openweather WHERE datetime_hour >= {AS_OF} - INTERVAL 7 DAY GROUP BY ALL) o ON t.province = o.province GROUP BY t.province, t.n)""", "province total_ward_count aqiin_ward_count ow_ward_count ~aqiin_coverage_pct aqiin_latest_hour ow_latest_hour"))
def _(spark, d):
    m = M(spark, d)
    return joins.coverage(m.dim, m.source_hourly("aqiin"), m.source_hourly("openweather"), R.AS_OF)


RANKING = f"province {REGION} ~population ~time_weighted_pm25 ~confidence_score confidence_level source_mix ^total_exposure_index_m risk_category exposure_risk_category pollution_rank exposure_rank national_risk_rank"


@query("risk_ranking", "W3", out("ranking", RANKING))
def _(spark, d):
    m = M(spark, d)
    return marts.risk_ranking(m.province("day"), m.population, R.AS_OF)


# --- spatial -----------------------------------------------------------------------------------

def unmapped(spark, d):
    """Stations with a claimed ward and province; half the claims are right."""
    s = R.table(spark, d, "supplier")
    key = F.col("s_suppkey")
    c = R.table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_nationkey"))
    x = s.join(c, key == F.col("c_custkey"), "left")
    nation = F.when(key % 2 == 0, F.col("c_nationkey")).otherwise(F.col("s_nationkey"))
    return x.select(
        F.col("s_name").alias("station_name"), (F.lit(8.5) + (key * 6367 % 15000) / 1000.0).alias("latitude"),
        (F.lit(102.0) + (key * 4421 % 7500) / 1000.0).alias("longitude"),
        R.pick(fv.PROVINCES, nation * 3 % 34).alias("province"), F.concat(F.lit("  "), F.upper("c_name")).alias("ward"))


_UNMAPPED = f"""SELECT s.s_name AS station_name, 8.5e0 + ((s_suppkey * 6367) % 15000) / 1000e0 AS latitude, 102e0 + ((s_suppkey * 4421) % 7500) / 1000e0 AS longitude,
  lower(trim({"(" + "[" + ", ".join("'" + p + "'" for p in fv.PROVINCES) + "]" + ")"}[(CASE WHEN s_suppkey % 2 = 0 THEN c_nationkey ELSE s_nationkey END * 3) % 34 + 1])) AS np, lower(trim('  ' || upper(c_name))) AS nw
  FROM supplier s LEFT JOIN customer c ON s.s_suppkey = c.c_custkey"""


@query("station_mapping", "J3 J4 X20", out(f"""(SELECT * FROM (SELECT s.station_name, s.latitude, s.longitude, w.ward_code, w.province, 'name' AS match FROM ({_UNMAPPED}) s JOIN wards w ON lower(trim(w.province)) = s.np AND lower(trim(w.ward_name)) = s.nw)
  UNION ALL SELECT station_name, latitude, longitude, ward_code, province, 'nearest' FROM (SELECT s.station_name, s.latitude, s.longitude, w.ward_code, w.province,
    row_number() OVER (PARTITION BY s.station_name ORDER BY {haversine('s.longitude', 's.latitude', 'w.longitude', 'w.latitude')}, w.ward_code) AS rn
    FROM ({_UNMAPPED}) s, wards w WHERE NOT EXISTS (SELECT 1 FROM wards q WHERE lower(trim(q.province)) = s.np AND lower(trim(q.ward_name)) = s.nw)) WHERE rn = 1)""", "station_name ~latitude ~longitude ward_code province match"))
def _(spark, d):
    from hazeframe.functions import naming
    st = unmapped(spark, d).withColumns({"norm_province": naming.normalise_province("province"), "norm_ward": naming.normalise("ward")})
    w = R.wards(spark, d).select("ward_code", "province", naming.normalise("province").alias("norm_province"),
                                 naming.normalise("ward_name").alias("norm_ward"), F.col("latitude").alias("ref_lat"), F.col("longitude").alias("ref_lon"))
    return spatial.map_stations(st, w)


def ward_refs(spark, d):
    return R.wards(spark, d).select(F.col("ward_code").alias("ref_key"), F.col("province").alias("ref_province"),
                                    F.col("latitude").alias("ref_lat"), F.col("longitude").alias("ref_lon"))


@query("nearest_ward", "J4 X12", out(f"(SELECT * FROM (SELECT s.station_name, s.latitude, s.longitude, w.ward_code AS ref_key, w.province AS ref_province, {haversine('s.longitude', 's.latitude', 'w.longitude', 'w.latitude')} AS distance, row_number() OVER (PARTITION BY s.station_name ORDER BY {haversine('s.longitude', 's.latitude', 'w.longitude', 'w.latitude')}, w.ward_code) AS rn FROM ({_UNMAPPED}) s, wards w) WHERE rn = 1)", "station_name ~latitude ~longitude ref_key ref_province ~distance"))
def _(spark, d):
    pts = unmapped(spark, d).select("station_name", "latitude", "longitude")
    return spatial.nearest_join(pts, ward_refs(spark, d)).drop("ref_lat", "ref_lon")


def roadside(spark, d):
    """One point per part; every eleventh lacks its longitude."""
    key = F.col("p_partkey")
    return R.table(spark, d, "part").select(
        "p_partkey", (F.lit(8.5) + (key * 7127 % 15000) / 1000.0 + 0.00037).alias("latitude"),
        F.when(key % 11 != 0, F.lit(102.0) + (key * 5209 % 7500) / 1000.0 + 0.00019).alias("longitude"))


_ROADSIDE = "SELECT p_partkey, 8.5e0 + ((p_partkey * 7127) % 15000) / 1000e0 + 0.00037e0 AS latitude, CASE WHEN p_partkey % 11 <> 0 THEN 102e0 + ((p_partkey * 5209) % 7500) / 1000e0 + 0.00019e0 END AS longitude FROM part"


@query("nearest_enrich", "J5", out(f"""(SELECT p_partkey, latitude, longitude, ref_key, d * 111 AS distance_km, NULL::VARCHAR AS quarantine_reason FROM (SELECT p.p_partkey, p.latitude, p.longitude, w.ward_code AS ref_key,
  sqrt((p.latitude - w.latitude) * (p.latitude - w.latitude) + (p.longitude - w.longitude) * (p.longitude - w.longitude)) AS d, row_number() OVER (PARTITION BY p_partkey ORDER BY
  sqrt((p.latitude - w.latitude) * (p.latitude - w.latitude) + (p.longitude - w.longitude) * (p.longitude - w.longitude)), w.ward_code) AS rn FROM ({_ROADSIDE}) p, wards w WHERE p.longitude IS NOT NULL) WHERE rn = 1
  UNION ALL SELECT p_partkey, latitude, longitude, NULL, NULL, 'missing_lat_lon' FROM ({_ROADSIDE}) WHERE longitude IS NULL)""", "p_partkey ~latitude ~longitude ref_key ~distance_km quarantine_reason"))
def _(spark, d):
    ok, bad = spatial.nearest_enrich(roadside(spark, d), ward_refs(spark, d))
    keep = ["p_partkey", "latitude", "longitude", "ref_key", "distance_km"]
    return ok.select(*keep).unionByName(bad, allowMissingColumns=True)


def measured(spark, d):
    """Measured traffic at the wards that have events: mean speeds."""
    w = R.wards(spark, d).select("ward_code", "latitude", "longitude")
    e = R.events(spark, d).withColumn("ward_code", R.padded_code("custkey"))
    return e.groupBy("ward_code").agg(F.avg(20 + F.col("k") / 3.0).alias("current_speed"), F.avg(50 + F.col("k") / 5.0).alias("free_flow_speed")).join(w, "ward_code")


_MEASURED = "SELECT e.ward_code, w.latitude, w.longitude, e.cs, e.ff FROM (SELECT ward_code, avg(20 + k / 3e0) AS cs, avg(50 + k / 5e0) AS ff FROM ev GROUP BY ward_code) e JOIN wards w ON e.ward_code = w.ward_code"
ROAD_CASE = "CASE nearest_highway_type WHEN 'motorway' THEN 0.9e0 WHEN 'trunk' THEN 0.8e0 WHEN 'primary' THEN 0.7e0 WHEN 'secondary' THEN 0.5e0 WHEN 'tertiary' THEN 0.3e0 WHEN 'residential' THEN 0.1e0 ELSE 0.2e0 END"


@query("idw_fill", "J6 X16", out(f"""(SELECT ward_code, latitude, longitude, neighbours, free_flow_speed, r AS congestion_ratio, free_flow_speed * (1 - r) AS current_speed FROM (SELECT *, least(1e0, greatest(0e0, ir * 0.65e0 + {ROAD_CASE} * exp(-distance_to_road_km) * (1 - 0.65e0))) AS r
  FROM (SELECT ward_code, latitude, longitude, nearest_highway_type, distance_to_road_km, count(*) AS neighbours, sum(w * ratio) / sum(w) AS ir, sum(w * ff) / sum(w) AS free_flow_speed FROM
    (SELECT *, 1 / (greatest(d, 1e-6) * greatest(d, 1e-6)) AS w, row_number() OVER (PARTITION BY ward_code ORDER BY d, ref) AS rn FROM (SELECT t.*, m.ward_code AS ref, m.ff, 1 - m.cs / greatest(m.ff, 1e0) AS ratio,
      sqrt((t.latitude - m.latitude) * (t.latitude - m.latitude) + (t.longitude - m.longitude) * (t.longitude - m.longitude)) AS d FROM wards t, ({_MEASURED}) m WHERE t.ward_code NOT IN (SELECT ward_code FROM ev)))
    WHERE rn <= 10 GROUP BY ALL)))""", "ward_code ~latitude ~longitude neighbours ~free_flow_speed ~congestion_ratio ~current_speed"))
def _(spark, d):
    targets = R.wards(spark, d).select("ward_code", "latitude", "longitude", "nearest_highway_type", "distance_to_road_km")
    return spatial.idw_fill(targets, measured(spark, d)).select("ward_code", "latitude", "longitude", "neighbours", "free_flow_speed", "congestion_ratio", "current_speed")


@query("tier_selection", "T3", with_ctes("SELECT ward_code, round(population, 6) + 0e0 AS population, round(distance_to_road_km, 6) + 0e0 AS distance_to_road_km FROM wards WHERE distance_to_road_km <= 1 OR (SELECT count(*) FROM wards WHERE distance_to_road_km <= 1) < 40 ORDER BY population DESC, ward_code LIMIT 40"))
def _(spark, d):
    return spatial.select_tier(R.wards(spark, d), 40).select("ward_code", "population", "distance_to_road_km")


@query("grid_clusters", "X26", out(f"(SELECT cluster_id, min(ward_code) AS representative, first(latitude ORDER BY ward_code) AS lat, first(longitude ORDER BY ward_code) AS lon, count(*) AS members FROM (SELECT *, {GRID('latitude', 'longitude')} AS cluster_id FROM wards) GROUP BY cluster_id)", "cluster_id representative ~lat ~lon members"))
def _(spark, d):
    return spatial.grid_clusters(R.wards(spark, d), "ward_code")


@query("grid_cluster_members", "X26", with_ctes(f"SELECT ward_code, {GRID('latitude', 'longitude')} AS cluster_id FROM wards"))
def _(spark, d):
    return spatial.cluster_members(R.wards(spark, d)).select("ward_code", "cluster_id")


@query("offpeak_traffic", "X17 X16", out(f"""(SELECT *, 60e0 * (1 - congestion_ratio) AS current_speed FROM (SELECT h.ward_code, h.timestamp_utc, {ROAD_CASE} * exp(-distance_to_road_km) * CASE h.hour WHEN 21 THEN 0.85e0 WHEN 22 THEN 0.7e0 WHEN 23 THEN 0.5e0 WHEN 0 THEN 0.3e0 WHEN 1 THEN 0.2e0 WHEN 2 THEN 0.2e0
  WHEN 3 THEN 0.2e0 WHEN 4 THEN 0.3e0 WHEN 5 THEN 0.6e0 WHEN 6 THEN 0.8e0 ELSE 0.5e0 END AS congestion_ratio, 'offpeak_model' AS traffic_source, 0.4e0 AS confidence FROM
  (SELECT DISTINCT ward_code, date_trunc('hour', ts) AS timestamp_utc, extract(hour FROM ts + INTERVAL 7 HOUR) AS hour FROM ev) h JOIN wards w ON h.ward_code = w.ward_code WHERE h.hour NOT BETWEEN 7 AND 20))""", "ward_code timestamp_utc ~congestion_ratio ~current_speed traffic_source ~confidence"))
def _(spark, d):
    hours = R.events(spark, d).select(R.padded_code("custkey").alias("ward_code"), F.date_trunc("hour", "ts").alias("timestamp_utc")).distinct()
    return air_quality.offpeak_traffic(R.wards(spark, d), hours).select("ward_code", "timestamp_utc", "congestion_ratio", "current_speed", "traffic_source", "confidence")


# --- dedup on driver tables ---------------------------------------------------------------------

@query("final_rows", "A2", out("(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1)", "l_orderkey l_partkey l_suppkey l_linenumber ~l_quantity ~l_extendedprice ~l_discount ~l_tax l_returnflag l_linestatus l_shipdate"))
def _(spark, d):
    return dedup.final(R.table(spark, d, "lineitem"), ["l_partkey"], "l_shipdate", ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query("final_rows_late", "A2 A3", ENTRIES["final_rows"].sql)
def _(spark, d):
    return dedup.final_late(R.table(spark, d, "lineitem"), ["l_partkey"], "l_shipdate", ["l_orderkey", "l_linenumber", "l_extendedprice"])


_DISTINCT = " UNION ALL ".join(
    f"SELECT '{grain}' AS grain, CAST({at} AS TIMESTAMP) AS at_time, {area} AS province, count(DISTINCT ward_code) AS wards, count(DISTINCT date) AS days FROM ward_hourly GROUP BY ALL"
    for grain, at, area in (("hour", "datetime_hour", "province"), ("day", "date", "province"), ("month", "date_trunc('month', date)", "province"), ("nation_month", "date_trunc('month', date)", "NULL::VARCHAR")))


@query("distinct_by_bitmap", "G4 G5 G15 G22 J13", out(f"({_DISTINCT})", "grain at_time province wards days"))
def _(spark, d):
    """Wards and days at four grains, all from the stored bitmaps of province-hours."""
    hours = stored(M(spark, d).ward_hourly.select("datetime_hour", "date", "province", "ward_code"), "ward-hours")
    numbers = distinct.number_keys(hours, "ward_code")
    by = ["datetime_hour", "province"]
    wards = distinct.distinct_bitmaps(hours.join(numbers, "ward_code"), by, "number").withColumn("kind", F.lit("wards"))
    days = distinct.distinct_bitmaps(hours, by, distinct.day_number("date")).withColumn("kind", F.lit("days"))
    bits = stored(wards.unionByName(days), "ward-bitmaps")
    none = F.lit(None).cast("string")
    grains = {"hour": (F.col("datetime_hour"), F.col("province")), "day": (F.to_date("datetime_hour"), F.col("province")),
              "month": (F.trunc("datetime_hour", "month"), F.col("province")), "nation_month": (F.trunc("datetime_hour", "month"), none)}
    parts = []
    for grain, (at, area) in grains.items():
        placed = bits.select(at.cast("timestamp").alias("at_time"), area.alias("province"), "kind", "block", "bits")
        counts = distinct.distinct_counts(placed, ["at_time", "province", "kind"], "n")
        parts.append(counts.groupBy("at_time", "province").agg(*[F.max(F.when(F.col("kind") == k, F.col("n"))).alias(k) for k in ("wards", "days")]).withColumn("grain", F.lit(grain)))
    return reduce(DataFrame.unionByName, parts)


@query("band_join_cells", "J8", out("(SELECT l_orderkey, l_linenumber, o_orderkey AS band FROM lineitem LEFT JOIN orders ON l_extendedprice >= o_totalprice AND l_extendedprice <= o_totalprice + CASE WHEN o_orderkey % 8 = 0 THEN 40 ELSE 0.5e0 END)", "l_orderkey l_linenumber band"))
def _(spark, d):
    """Prices between the bounds of thousands of bands that share one key."""
    one = F.lit("price")
    bands = R.table(spark, d, "orders").select(
        one.alias("name"), F.col("o_totalprice").cast("double").alias("low"),
        (F.col("o_totalprice") + F.when(F.col("o_orderkey") % 8 == 0, 40.0).otherwise(0.5)).cast("double").alias("high"), F.col("o_orderkey").alias("band"))
    rows = R.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", one.alias("parameter"))
    return joins.band_join_cells(rows, bands, "parameter", "l_extendedprice", "name", "low", "high").select("l_orderkey", "l_linenumber", "band")


@query("keep_last_record", "A3", out("(SELECT o_custkey, o_orderpriority, max(o_orderdate) AS o_orderdate, first(o_orderkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS o_orderkey, first(o_totalprice ORDER BY o_orderdate DESC, o_orderkey DESC) AS o_totalprice, first(o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS o_orderstatus FROM orders GROUP BY o_custkey, o_orderpriority)", "o_custkey o_orderpriority o_orderdate o_orderkey ~o_totalprice o_orderstatus"))
def _(spark, d):
    return dedup.keep_last(R.table(spark, d, "orders"), ["o_custkey", "o_orderpriority"], "o_orderdate", ["o_orderkey"])


@query("first_rows_per_key", "W4", out("(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3)", "o_custkey o_orderkey ~o_totalprice o_orderdate o_orderstatus o_orderpriority"))
def _(spark, d):
    return dedup.limit_by(R.table(spark, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)


@query("latest_values_by_part", "A1", out("(SELECT l_partkey, max(l_shipdate) AS l_shipdate, first(CASE WHEN l_returnflag <> 'N' THEN l_quantity END ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) FILTER (WHERE l_returnflag <> 'N') AS settled_quantity, first(l_linestatus ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS l_linestatus FROM lineitem GROUP BY l_partkey)", "l_partkey l_shipdate ~settled_quantity l_linestatus"))
def _(spark, d):
    li = R.table(spark, d, "lineitem").withColumn("settled_quantity", F.when(F.col("l_returnflag") != "N", F.col("l_quantity")))
    return dedup.latest_by_key(li, ["l_partkey"], "l_shipdate", ["settled_quantity", "l_linestatus"], ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query("generic_pivot", "G1", out("(SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, " + ", ".join(f"avg(l_extendedprice) FILTER (WHERE l_returnflag = '{f}') AS \"{f}_avg\"" for f in "ANR") + ", max(l_extendedprice) AS max_value, count(*) AS observation_count FROM lineitem GROUP BY ALL)", "l_suppkey month ~A_avg ~N_avg ~R_avg ~max_value observation_count"))
def _(spark, d):
    li = R.table(spark, d, "lineitem")
    return rollup.pivot_mean(li, ["l_suppkey", F.trunc("l_shipdate", "month").alias("month")], "l_returnflag", "l_extendedprice", ["A", "N", "R"])


@query("generic_rollup", "G2 G3", out("(SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, avg(l_extendedprice) AS avg_value, max(l_extendedprice) AS max_value, min(l_extendedprice) AS min_value, count(*) AS samples FROM lineitem GROUP BY ALL)", "l_suppkey day ~avg_value ~max_value ~min_value samples"))
def _(spark, d):
    return rollup.rollup(R.table(spark, d, "lineitem"), ["l_suppkey", F.to_date("l_shipdate").alias("day")], "l_extendedprice")


