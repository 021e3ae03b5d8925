"""Parameterised queries over the marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions import naming, times
from hazeframe.operators import joins, ranking, rollup
from hazeframe.plans import alerts, marts, reports
from registry import roles as R
from registry.base import query
from registry.ctes import AS_OF, AS_OF_DATE, MODE_MIX, case_category, case_index, mode_any, out, with_ctes
from registry.model_queries import HEALTH_BY_SOURCE_SQL, HEALTH_SQL, M, RANKING, _BIAS, health, trend, weather_values

RANGES = times.comparison_ranges(date(2024, 1, 17), date(2024, 1, 30))
NOW = "date BETWEEN DATE '2024-01-17' AND DATE '2024-01-30'"
BEFORE = "date BETWEEN DATE '2024-01-03' AND DATE '2024-01-16'"
LEVEL = "CASE WHEN confidence_score >= 0.8e0 THEN 'high' WHEN confidence_score >= 0.5e0 THEN 'medium' ELSE 'low' END"
SUMS = "CAST(sum(aqiin_observation_count) AS BIGINT) AS aqiin_observation_count, CAST(sum(openweather_observation_count) AS BIGINT) AS openweather_observation_count"


def obs():
    return F.col("source_mix") == "observed"


def status(m):
    return marts.current_status(m.ward_hourly, m.dim)


def over(spark, d, grain="day"):
    return M(spark, d).overview(grain)


def board(spark, d):
    return reports.current_status_by_province(status(M(spark, d)), R.AS_OF)


BOARD_SQL = out(f"(SELECT *, {LEVEL} AS confidence_level FROM (SELECT province, max(current_aqi_vn) AS current_aqi, first(main_pollutant ORDER BY latest_hour DESC, ward_code DESC) FILTER (WHERE main_pollutant IS NOT NULL) AS main_pollutant, avg(confidence_score) AS confidence_score, {MODE_MIX} AS source_mix, {SUMS}, max(latest_hour) AS as_of_hour FROM current_status WHERE latest_hour >= {AS_OF} - INTERVAL 3 HOUR AND province <> '' AND current_aqi_vn IS NOT NULL GROUP BY province))", "province ~current_aqi main_pollutant ~confidence_score confidence_level source_mix aqiin_observation_count openweather_observation_count as_of_hour")
query("status_board", "Q1", BOARD_SQL)(board)


@query("national_kpi", "Q2", out(f"(SELECT avg(avg_aqi_vn) AS avg_val, max(coalesce(max_aqi_vn, avg_aqi_vn)) AS max_val, first(province ORDER BY coalesce(max_aqi_vn, avg_aqi_vn) DESC, date DESC, ward_code DESC, source_mix DESC) AS max_val_province, first(ward_name ORDER BY coalesce(max_aqi_vn, avg_aqi_vn) DESC, date DESC, ward_code DESC, source_mix DESC) AS max_val_ward, count(DISTINCT province) AS province_count, count(DISTINCT ward_code) AS ward_count, {mode_any('main_pollutant')} AS dominant_pollutant FROM overview_day WHERE avg_aqi_vn IS NOT NULL AND province <> '' AND source_mix = 'observed')", "~avg_val ~max_val max_val_province max_val_ward province_count ward_count dominant_pollutant"))
def _(spark, d):
    return reports.national_kpi(over(spark, d), "avg_aqi_vn", "max_aqi_vn", obs())


def _map_sql(by_ward):
    keys, spot = ("ward_code, ward_name, province", "min") if by_ward else ("province", "avg")
    return f"(SELECT *, {LEVEL} AS confidence_level FROM (SELECT {keys}, {spot}(latitude) AS latitude, {spot}(longitude) AS longitude, avg(avg_aqi_vn) AS display_val, {mode_any('main_pollutant')} AS main_pollutant, avg(confidence_score) AS confidence_score, {MODE_MIX} AS source_mix, {SUMS} FROM overview_day WHERE avg_aqi_vn IS NOT NULL AND province <> '' AND latitude <> 0 AND longitude <> 0 GROUP BY {keys}))"


_MAP = "~latitude ~longitude ~display_val main_pollutant ~confidence_score confidence_level source_mix aqiin_observation_count openweather_observation_count"


@query("map_wards", "Q3", out(_map_sql(True), f"ward_code ward_name province {_MAP}"))
def _(spark, d):
    return reports.map_wards(over(spark, d), "avg_aqi_vn")


@query("map_provinces", "Q3", out(_map_sql(False), f"province {_MAP}"))
def _(spark, d):
    return reports.map_wards(over(spark, d), "avg_aqi_vn", by_ward=False)


_STATION_MAP = "s.ward_code, t.station_name AS ward_name, coalesce(d.ward_name, t.station_name) AS actual_ward_name, s.province, s.latitude, s.longitude, t.display_val, t.main_pollutant, 1e0 AS confidence_score, 'high' AS confidence_level, 'observed' AS source_mix, t.n AS aqiin_observation_count, CAST(0 AS BIGINT) AS openweather_observation_count"
_STATION_COLS = f"ward_code ward_name actual_ward_name province {_MAP}"


@query("map_station_index", "Q3", out(f"(SELECT {_STATION_MAP} FROM (SELECT station_name, avg(v) AS display_val, {mode_any('p')} AS main_pollutant, CAST(sum(c) AS BIGINT) AS n FROM (SELECT station_name, timestamp_utc, max(a) AS v, first(parameter ORDER BY a DESC, parameter DESC) FILTER (WHERE a IS NOT NULL) AS p, count(*) AS c FROM (SELECT *, {case_index('value', fv.VN_BREAKPOINTS, 'parameter')} AS a FROM observed WHERE parameter IN ('pm25', 'pm10', 'co', 'no2', 'so2', 'o3')) GROUP BY ALL) GROUP BY station_name) t JOIN stations s ON t.station_name = s.station_name LEFT JOIN dim d ON s.ward_code = d.ward_code)", _STATION_COLS))
def _(spark, d):
    m = M(spark, d)
    return reports.map_stations_index(m.observed_processed, m.raw["stations"], m.dim)


@query("map_station_value", "Q3", out(f"(SELECT {_STATION_MAP} FROM (SELECT station_name, avg(value) AS display_val, 'pm10' AS main_pollutant, count(DISTINCT timestamp_utc) AS n FROM observed WHERE parameter = 'pm10' GROUP BY station_name) t JOIN stations s ON t.station_name = s.station_name LEFT JOIN dim d ON s.ward_code = d.ward_code)", _STATION_COLS))
def _(spark, d):
    m = M(spark, d)
    return reports.map_stations_value(m.observed_processed, m.raw["stations"], m.dim, "pm10")


@query("category_histogram", "Q4", with_ctes("SELECT " + case_category("avg_aqi_vn", fv.AQI_HISTOGRAM_KEYS, "aqi_hazardous") + " AS aqi_category_key, count(*) AS count FROM overview_day WHERE avg_aqi_vn IS NOT NULL AND province <> '' GROUP BY 1"))
def _(spark, d):
    return reports.category_histogram(over(spark, d), "avg_aqi_vn")


@query("worst_trend", "Q5 G23", out(f"(SELECT *, (curr_avg - prev_avg) / prev_avg AS rise FROM (SELECT province, avg(CASE WHEN {BEFORE} THEN avg_aqi_vn END) AS prev_avg, avg(CASE WHEN {NOW} THEN avg_aqi_vn END) AS curr_avg FROM overview_day WHERE province <> '' GROUP BY province HAVING prev_avg > 0 AND curr_avg > prev_avg) ORDER BY rise DESC, province LIMIT 3)", "province ~prev_avg ~curr_avg ~rise"))
def _(spark, d):
    return reports.worst_trend(over(spark, d), "avg_aqi_vn", RANGES, n=3)


@query("best_places", "Q5 T1", out(f"(SELECT province, avg(avg_aqi_vn) AS avg_val FROM overview_day WHERE {NOW} GROUP BY province ORDER BY avg_val, province LIMIT 2)", "province ~avg_val"))
def _(spark, d):
    return reports.best_places(over(spark, d), "avg_aqi_vn", RANGES)


@query("pollutant_improvement", "Q5", out("(" + " UNION ALL ".join(f"SELECT '{p}' AS pollutant, a AS prev_avg, b AS curr_avg, (a - b) / nullif(a, 0) * 100 AS decrease_pct, coalesce(b < a, false) AS improved FROM (SELECT avg(CASE WHEN {BEFORE} THEN {p}_avg END) AS a, avg(CASE WHEN {NOW} THEN {p}_avg END) AS b FROM overview_day)" for p in fv.POLLUTANTS) + ")", "pollutant ~prev_avg ~curr_avg ~decrease_pct improved"))
def _(spark, d):
    return reports.pollutant_improvement(over(spark, d), RANGES)


def weather_days(spark, d):
    return marts.weather_correlation(weather_values(M(spark, d)))


@query("stagnation_leader", "Q6", out(f"(SELECT province, avg(wind_daily_avg) AS avg_wind, avg(stagnant_hours) AS avg_stagnant_hours, avg(pm25_daily_avg) AS avg_pm25 FROM weather_daily WHERE {NOW} GROUP BY province ORDER BY avg_stagnant_hours DESC, avg_pm25 DESC, province LIMIT 1)", "province ~avg_wind ~avg_stagnant_hours ~avg_pm25"))
def _(spark, d):
    return reports.stagnation_leader(weather_days(spark, d), RANGES)


@query("breach_counts", "Q7", out("(SELECT *, CASE WHEN pm25_pm10_ratio > 0.6e0 THEN 'Combustion/Traffic' WHEN pm25_pm10_ratio < 0.4e0 THEN 'Dust/Construction' ELSE 'Mixed' END AS probable_source FROM (SELECT count(*) AS total_records, count(*) FILTER (WHERE pm25_avg > 15) AS who_breach_cnt, count(*) FILTER (WHERE pm25_avg <= 50) AS tcvn_compliance_cnt, count(*) FILTER (WHERE pm25_avg > 15) / count(*) * 100 AS who_breach_pct, count(*) FILTER (WHERE pm25_avg <= 50) / count(*) * 100 AS tcvn_compliance_pct, avg(pm25_avg) / avg(pm10_avg) AS pm25_pm10_ratio FROM overview_day WHERE pm25_avg IS NOT NULL))", "total_records who_breach_cnt tcvn_compliance_cnt ~who_breach_pct ~tcvn_compliance_pct ~pm25_pm10_ratio probable_source"))
def _(spark, d):
    return reports.breach_counts(over(spark, d), "pm25_avg", fv.WHO_DAILY["pm25"], fv.NATIONAL_DAILY["pm25"])


@query("breach_spotlight", "Q7", with_ctes("SELECT province, count(*) AS total_days, count(*) FILTER (WHERE pm25_avg > 50) AS breach_days FROM overview_day WHERE pm25_avg IS NOT NULL AND province <> '' GROUP BY province ORDER BY breach_days DESC, total_days DESC, province LIMIT 3"))
def _(spark, d):
    return reports.breach_spotlight(over(spark, d), "pm25_avg", 50.0, n=3)


def daily_summary(m):
    return rollup.source_summary(m.ward_daily, "day")


_SUB1 = " ".join(f"~{p}_aqi" for p in fv.POLLUTANTS)


@query("sub_index_trend_hours", "Q8", out("(SELECT datetime_hour AS time_key, " + ", ".join(f"round(avg({p}_aqi), 1) AS {p}_aqi" for p in fv.POLLUTANTS) + " FROM hourly_summary GROUP BY datetime_hour)", f"time_key {_SUB1}"))
def _(spark, d):
    return reports.sub_index_trend(M(spark, d).hourly_summary, "hour")


@query("sub_index_trend_days", "Q8", out("(SELECT date AS time_key, " + ", ".join(f"round(avg({p}_daily_aqi), 1) AS {p}_aqi" for p in fv.POLLUTANTS) + " FROM daily_summary WHERE source = 'aqiin' GROUP BY date)", f"time_key {_SUB1}"))
def _(spark, d):
    return reports.sub_index_trend(daily_summary(M(spark, d)), "day", F.col("source") == "aqiin")


@query("source_value_trend", "Q8 Q10", out("(SELECT date AS time_key, source, round(avg(daily_avg_aqi_us), 1) AS value FROM daily_summary GROUP BY ALL)", "time_key source ~value"))
def _(spark, d):
    return reports.source_value_trend(daily_summary(M(spark, d)), "daily_avg_aqi_us", "day")


@query("fingerprint_counts", "Q9", with_ctes("SELECT probable_source, count(*) AS cnt FROM fingerprint WHERE source_mix = 'observed' GROUP BY probable_source"))
def _(spark, d):
    return reports.class_counts(marts.fingerprint(M(spark, d).ward_hourly), ["probable_source"], obs())


def comp(spark, d):
    return marts.compliance(M(spark, d).province("day"))


@query("compliance_counts", "Q9", with_ctes("SELECT province, compliance_status, count(*) AS cnt FROM compliance WHERE source_mix = 'observed' GROUP BY province, compliance_status"))
def _(spark, d):
    return reports.class_counts(comp(spark, d), ["province", "compliance_status"], obs())


@query("source_statistics", "Q10", out("(SELECT source, round(avg(daily_avg_aqi_us), 1) AS avg_aqi, round(max(daily_max_aqi_us), 0) AS max_aqi, round(min(daily_avg_aqi_us), 1) AS min_aqi, count(*) AS day_count, count(*) FILTER (WHERE daily_avg_aqi_us <= 50) AS good_days FROM daily_summary GROUP BY source)", "source ~avg_aqi ~max_aqi ~min_aqi day_count good_days"))
def _(spark, d):
    return reports.source_stats(daily_summary(M(spark, d)))


@query("source_distribution", "Q10", out("(SELECT source, daily_avg_aqi_us AS avg_aqi FROM daily_summary)", "source ~avg_aqi"))
def _(spark, d):
    return reports.source_distribution(daily_summary(M(spark, d)))


@query("source_freshness", "Q10", with_ctes(f"SELECT source, reliable_pct, latest_lag_hours, latest_ingest_lag_hours, stale_count, offline_count FROM ({HEALTH_BY_SOURCE_SQL})"))
def _(spark, d):
    return reports.source_freshness(marts.health_summary(health(M(spark, d)), R.AS_OF, ["source"]))


@query("history_statistics", "Q11 G22", out("(SELECT count(DISTINCT date) AS total_days, round(avg(avg_aqi_vn), 1) AS overall_avg, round(min(avg_aqi_vn), 1) AS overall_min, round(max(avg_aqi_vn), 0) AS overall_max FROM overview_day WHERE source_mix = 'observed' AND avg_aqi_vn IS NOT NULL)", "total_days ~overall_avg ~overall_min ~overall_max"))
def _(spark, d):
    return reports.history_stats(over(spark, d), "avg_aqi_vn", obs())


@query("daily_trend", "Q11 Q21", out("(SELECT date, round(avg(avg_aqi_vn), 1) AS avg_val, round(max(max_aqi_vn), 0) AS max_val FROM overview_day WHERE source_mix = 'observed' GROUP BY date)", "date ~avg_val ~max_val"))
def _(spark, d):
    return reports.period_trend(over(spark, d), "avg_aqi_vn", obs(), "max_aqi_vn")


@query("monthly_trend", "Q11 F5", out("(SELECT date, round(avg(avg_aqi_vn), 1) AS avg_val, round(max(avg_aqi_vn), 0) AS max_val FROM overview_month WHERE source_mix = 'observed' AND date BETWEEN DATE '2023-12-01' AND DATE '2024-01-01' GROUP BY date)", "date ~avg_val ~max_val"))
def _(spark, d):
    return reports.monthly_trend(over(spark, d, "month"), "avg_aqi_vn", [date(2023, 12, 5), date(2024, 1, 30)], "observed")


_HEAT = "SELECT province, CAST(date AS VARCHAR) AS date_str, round(avg(avg_aqi_vn), 1) AS display_val FROM overview_day WHERE province <> '' AND avg_aqi_vn IS NOT NULL AND source_mix = '{0}' GROUP BY ALL"


@query("heat_map", "Q11", out(f"({_HEAT.format('observed')})", "province date_str ~display_val"))
def _(spark, d):
    return reports.heat_map(over(spark, d), "avg_aqi_vn", obs())


@query("ground_versus_model", "J17 Q11", out(f"(SELECT a.province, a.date_str, a.display_val AS display_val_ground, b.display_val AS display_val_sat, a.display_val - b.display_val AS difference FROM ({_HEAT.format('observed')}) a JOIN ({_HEAT.format('modeled')}) b ON a.province = b.province AND a.date_str = b.date_str)", "province date_str ~display_val_ground ~display_val_sat ~difference"))
def _(spark, d):
    o = over(spark, d)
    a, b = (reports.heat_map(o, "avg_aqi_vn", F.col("source_mix") == m) for m in ("observed", "modeled"))
    return joins.side_by_side(a, b, ["province", "date_str"]).withColumn("difference", F.col("display_val_ground") - F.col("display_val_sat"))


@query("compliance_timeline", "Q12", with_ctes(f"SELECT date, compliance_status, count(*) AS cnt FROM compliance WHERE date >= {AS_OF_DATE} - 14 GROUP BY ALL"))
def _(spark, d):
    return reports.compliance_timeline(comp(spark, d), R.AS_OF_DATE, 14)


@query("breach_by_province", "Q12 T1", with_ctes(f"SELECT province, CAST(sum(who_pm25_breach) AS BIGINT) AS who_breach_days, CAST(sum(tcvn_pm25_breach) AS BIGINT) AS tcvn_breach_days FROM compliance WHERE date >= {AS_OF_DATE} - 30 AND province <> '' GROUP BY province ORDER BY sum(who_pm25_breach) + sum(tcvn_pm25_breach) DESC, province LIMIT 15"))
def _(spark, d):
    return reports.breach_by_province(comp(spark, d), R.AS_OF_DATE, 30)


_RISK = f"SELECT province, date, least(24, count(*) FILTER (WHERE h > 150)) AS high_risk_hours FROM (SELECT province, date, datetime_hour, max(avg_aqi_us) AS h FROM province_hourly WHERE date >= {AS_OF_DATE} - 30 AND source_mix = 'observed' AND province <> '' GROUP BY ALL) GROUP BY province, date"


@query("high_risk_hours", "Q12", with_ctes(_RISK))
def _(spark, d):
    return reports.high_risk_hours(M(spark, d).province("hour"), R.AS_OF_DATE, 30)


DAYS = [f"2024-01-{n:02d}" for n in range(1, 31)]


@query("high_risk_matrix", "T2", with_ctes("SELECT province, " + ", ".join(f"CAST(sum(high_risk_hours) FILTER (WHERE date = DATE '{x}') AS BIGINT) AS \"{x}\"" for x in DAYS) + f" FROM ({_RISK}) WHERE province IN (SELECT province FROM ({_RISK}) GROUP BY province ORDER BY sum(high_risk_hours) DESC, province LIMIT 12) GROUP BY province"))
def _(spark, d):
    risk = reports.high_risk_hours(M(spark, d).province("hour"), R.AS_OF_DATE, 30).withColumn("day", F.col("date").cast("string"))
    return ranking.top_groups_matrix(risk, "province", "day", "high_risk_hours", 12, DAYS)


@query("traffic_profile", "Q13 X18", out("(SELECT CAST(extract(hour FROM datetime_hour + INTERVAL 7 HOUR) AS INTEGER) AS hour_val, avg(avg_congestion) AS avg_congestion, avg(pm25) AS avg_p FROM traffic_trend WHERE source_mix = 'observed' GROUP BY 1)", "hour_val ~avg_congestion ~avg_p"))
def _(spark, d):
    return reports.traffic_profile(trend(M(spark, d)), "pm25", obs())


def traffic_days(m):
    return marts.traffic_correlation(trend(m))


@query("traffic_summary", "Q13", out("(SELECT avg(pm25_daily_avg) AS avg_pm25, avg(congestion_daily_avg) AS avg_congestion, avg(pm25_congestion_uplift) AS avg_pm25_uplift, avg(traffic_pollution_impact_score) AS avg_comovement_score, avg(avg_traffic_coverage_ratio) AS avg_traffic_coverage_ratio, CAST(sum(total_hours) AS BIGINT) AS observed_hours, CAST(sum(low_congestion_hours) AS BIGINT) AS low_congestion_hours, CAST(sum(high_congestion_hours) AS BIGINT) AS high_congestion_hours, count(pm25_congestion_uplift) AS uplift_sample_days FROM traffic_daily WHERE source_mix = 'observed')", "~avg_pm25 ~avg_congestion ~avg_pm25_uplift ~avg_comovement_score ~avg_traffic_coverage_ratio observed_hours low_congestion_hours high_congestion_hours uplift_sample_days"))
def _(spark, d):
    return reports.traffic_summary(traffic_days(M(spark, d)), obs())


@query("traffic_ranking_wards", "Q14 J16", out("(SELECT d.ward_code, min(d.ward_name) AS label_col, min(CASE WHEN d.province IN ('Hà Nội', 'Hồ Chí Minh', 'Đà Nẵng', 'Hải Phòng', 'Cần Thơ') THEN 'Urban' WHEN d.province IN ('Đồng Nai', 'Bắc Ninh', 'Hưng Yên', 'Quảng Ninh', 'Thái Nguyên') THEN 'Industrial' ELSE 'Rural' END) AS location_type, avg(h.pm25 * t.c) AS impact_score FROM dim d JOIN (SELECT ward_code, timestamp_utc, avg(value) AS c FROM staged_traffic GROUP BY ALL) t ON d.ward_code = t.ward_code JOIN traffic_trend h ON d.province = h.province AND t.timestamp_utc = h.datetime_hour WHERE h.pm25 IS NOT NULL AND t.c > 0 AND h.source_mix = 'observed' GROUP BY d.ward_code ORDER BY impact_score DESC, d.ward_code LIMIT 12)", "ward_code label_col location_type ~impact_score"))
def _(spark, d):
    m = M(spark, d)
    return reports.traffic_ranking_wards(m.traffic_staged, m.dim, trend(m), "pm25", "observed")


@query("traffic_ranking_provinces", "Q14", out("(SELECT province AS label_col, min(location_type) AS location_type, avg(pm25_daily_avg * congestion_daily_avg) AS impact_score FROM traffic_daily WHERE source_mix = 'observed' GROUP BY province ORDER BY impact_score DESC, province LIMIT 12)", "label_col location_type ~impact_score"))
def _(spark, d):
    return reports.traffic_ranking_provinces(traffic_days(M(spark, d)), "pm25", obs())


_STAG = "sum(stagnant_pm25_sum) / nullif(sum(stagnant_hours), 0) AS avg_stag, sum(dispersive_pm25_sum) / nullif(sum(dispersive_hours), 0) AS avg_disp"
_INF = "(avg_stag - avg_disp) / nullif(avg_stag, 0) * 100 AS influence_pct"


@query("weather_summary", "Q15", out(f"(SELECT *, {_INF} FROM (SELECT {_STAG}, avg(stagnant_air_probability) AS stagnant_prob, avg(wind_daily_avg) AS avg_wind FROM weather_daily WHERE source_mix = 'observed'))", "~avg_stag ~avg_disp ~stagnant_prob ~avg_wind ~influence_pct"))
def _(spark, d):
    return reports.weather_summary(weather_days(spark, d), "pm25", obs())


def _rank_sql(key):
    return f"SELECT *, {_INF} FROM (SELECT {key}, avg(pm25_daily_avg / nullif(wind_daily_avg, 0)) AS risk_index, {_STAG} FROM weather_daily WHERE source_mix = 'observed' AND {key} <> '' GROUP BY {key}) ORDER BY risk_index DESC, {key} LIMIT 10"


@query("weather_ranking_provinces", "Q15", out(f"(SELECT * EXCLUDE (province), province AS label_col FROM ({_rank_sql('province')}))", "label_col ~risk_index ~avg_stag ~avg_disp ~influence_pct"))
def _(spark, d):
    return reports.weather_ranking(weather_days(spark, d), "pm25", obs())


@query("weather_ranking_wards", "Q15", out(f"(SELECT r.* EXCLUDE (ward_code), r.ward_code AS label_key, coalesce(d.ward_name, r.ward_code) AS label_col FROM ({_rank_sql('ward_code')}) r LEFT JOIN dim d ON r.ward_code = d.ward_code)", "label_key label_col ~risk_index ~avg_stag ~avg_disp ~influence_pct"))
def _(spark, d):
    m = M(spark, d)
    return reports.weather_ranking(marts.weather_correlation(weather_values(m)), "pm25", obs(), m.dim)


_SERIES = "time_key ~avg_val ~avg_temp ~avg_hum ~avg_wind ~stagnant_prob"


def _series_sql(key, source, v, t, h, w):
    return f"SELECT {key} AS time_key, avg({v}) AS avg_val, avg({t}) AS avg_temp, avg({h}) AS avg_hum, avg({w}) AS avg_wind, avg(stagnant_air_probability) AS stagnant_prob FROM {source} WHERE source_mix = 'observed' GROUP BY 1 HAVING avg({t}) IS NOT NULL"


_DAYCOLS = ("weather_daily", "pm25_daily_avg", "temp_daily_avg", "humidity_daily_avg", "wind_daily_avg")


@query("weather_series_hours", "Q15", out("(" + _series_sql("datetime_hour + INTERVAL 7 HOUR", "weather_trend", "pm25", "temperature", "humidity", "wind_speed") + ")", _SERIES))
def _(spark, d):
    return reports.weather_series(weather_values(M(spark, d)), "hour", "pm25", obs())


@query("weather_series_days", "Q15", out("(" + _series_sql("CAST(date AS TIMESTAMP)", *_DAYCOLS) + ")", _SERIES))
def _(spark, d):
    return reports.weather_series(weather_days(spark, d), "day", "pm25", obs())


@query("weather_series_months", "Q15", out("(" + _series_sql("CAST(date_trunc('month', date) AS TIMESTAMP)", *_DAYCOLS) + ")", _SERIES))
def _(spark, d):
    return reports.weather_series(weather_days(spark, d), "month", "pm25", obs())


@query("weather_correlations", "G24", out("(SELECT x, y, CASE " + " ".join(f"WHEN x = '{a}' AND y = '{b}' THEN corr_{a}_{b}" for a in ("avg_val", "avg_temp", "avg_hum", "avg_wind") for b in ("avg_val", "avg_temp", "avg_hum", "avg_wind")) + " END AS r FROM (SELECT " + ", ".join(f"corr({a}, {b}) AS corr_{a}_{b}" for a in ("avg_val", "avg_temp", "avg_hum", "avg_wind") for b in ("avg_val", "avg_temp", "avg_hum", "avg_wind")) + " FROM (" + _series_sql("CAST(date AS TIMESTAMP)", *_DAYCOLS) + ")), (VALUES ('avg_val'), ('avg_temp'), ('avg_hum'), ('avg_wind')) a(x), (VALUES ('avg_val'), ('avg_temp'), ('avg_hum'), ('avg_wind')) b(y))", "x y ~r"))
def _(spark, d):
    return ranking.corr_matrix(reports.weather_series(weather_days(spark, d), "day", "pm25", obs()), ["avg_val", "avg_temp", "avg_hum", "avg_wind"])


@query("weather_trend_line", "G24", out("(SELECT regr_slope(avg_val, avg_wind) AS slope, regr_intercept(avg_val, avg_wind) AS intercept, CAST(regr_count(avg_val, avg_wind) AS BIGINT) AS n, corr(avg_val, avg_wind) AS r FROM (" + _series_sql("CAST(date AS TIMESTAMP)", *_DAYCOLS) + "))", "~slope ~intercept n ~r"))
def _(spark, d):
    return ranking.ols(reports.weather_series(weather_days(spark, d), "day", "pm25", obs()), "avg_val", "avg_wind")


@query("source_correlation", "G24 G21", out(f"(SELECT corr(aqiin_pm25, ow_pm25) AS r, avg(aqi_bias) AS avg_bias, avg(aqi_mae) AS avg_mae, count(*) FILTER (WHERE category_agreement IN ('both_good', 'both_unhealthy')) * 100e0 / count(*) AS agree_pct FROM {_BIAS} WHERE category_agreement <> 'one_source_only')", "~r ~avg_bias ~avg_mae ~agree_pct"))
def _(spark, d):
    both = joins.compare_sources(M(spark, d).ward_daily).filter(F.col("category_agreement") != "one_source_only")
    agree = F.count_if(F.col("category_agreement").isin("both_good", "both_unhealthy"))
    return both.agg(F.corr("aqiin_pm25", "ow_pm25").alias("r"), F.avg("aqi_bias").alias("avg_bias"), F.avg("aqi_mae").alias("avg_mae"), (agree * 100.0 / F.count(F.lit(1))).alias("agree_pct"))


def ranked(spark, d):
    m = M(spark, d)
    return marts.risk_ranking(m.province("day"), m.population, R.AS_OF)


@query("health_ranking", "Q16", out("ranking", RANKING.replace("region_3 region_8 ", "")))
def _(spark, d):
    return reports.health_ranking(ranked(spark, d))


@query("health_kpis", "Q16", out("(SELECT first(province ORDER BY time_weighted_pm25 DESC, province DESC) AS worst_province, max(time_weighted_pm25) AS worst_pm25, avg(time_weighted_pm25) AS mean_pm25, count(*) FILTER (WHERE risk_category IN ('CRITICAL', 'HIGH RISK')) AS critical_high_risk_provinces, sum(population) / 1000000e0 AS exposed_population_m FROM ranking)", "worst_province ~worst_pm25 ~mean_pm25 critical_high_risk_provinces ~exposed_population_m"))
def _(spark, d):
    return reports.health_kpis(ranked(spark, d))


@query("risk_distribution", "Q16", out("(SELECT risk_category, count(*) AS provinces, count(*) * 100e0 / sum(count(*)) OVER () AS pct FROM ranking GROUP BY risk_category)", "risk_category provinces ~pct"))
def _(spark, d):
    return reports.risk_distribution(ranked(spark, d))


@query("latest_confidence", "Q17 J15", out("(SELECT source_mix, confidence_level, count(*) AS ward_count, round(avg(confidence_score), 2) AS confidence_score, CAST(sum(aqiin_observation_count) AS BIGINT) AS aqiin_observations, CAST(sum(openweather_observation_count) AS BIGINT) AS openweather_observations FROM overview_day WHERE source_mix = 'observed' AND date = (SELECT max(date) FROM overview_day WHERE source_mix = 'observed') GROUP BY ALL)", "source_mix confidence_level ward_count ~confidence_score aqiin_observations openweather_observations"))
def _(spark, d):
    return reports.latest_confidence(over(spark, d))


@query("platform_state", "Q17 X23", with_ctes(f"SELECT latest_lag_hours, reliable_pct, CASE WHEN latest_lag_hours <= 1 AND reliable_pct >= 90 THEN 'operational' WHEN latest_lag_hours <= 3 AND reliable_pct >= 70 THEN 'degraded' ELSE 'delayed' END AS status FROM ({HEALTH_SQL})"))
def _(spark, d):
    s = marts.health_summary(health(M(spark, d)), R.AS_OF)
    return s.select("latest_lag_hours", "reliable_pct", naming.platform_status("latest_lag_hours", "reliable_pct").alias("status"))


@query("model_freshness", "Q17", with_ctes("SELECT 'staged_aqiin' AS model, CAST(epoch(max(timestamp_utc)) AS BIGINT) AS latest_epoch FROM staged_aqiin UNION ALL SELECT 'hourly_summary', CAST(epoch(max(datetime_hour)) AS BIGINT) FROM hourly_summary UNION ALL SELECT 'overview', CAST(epoch(max(last_ingested_at)) AS BIGINT) FROM overview_day"))
def _(spark, d):
    m = M(spark, d)
    return reports.model_freshness({"staged_aqiin": (m.staged("aqiin"), "timestamp_utc"), "hourly_summary": (m.hourly_summary, "datetime_hour"),
                                    "overview": (m.overview("day"), "last_ingested_at")})


@query("run_history", "Q17", with_ctes("SELECT * FROM control ORDER BY last_run DESC, source LIMIT 20"))
def _(spark, d):
    return reports.run_history(R.control(spark, d))


@query("attention_list", "T4", with_ctes("SELECT source, province, ward_code, last_seen, lag_hours, health_status FROM health WHERE health_status IN ('Stale', 'Offline') ORDER BY lag_hours DESC, source, province, ward_code LIMIT 100"))
def _(spark, d):
    return reports.attention_list(health(M(spark, d)))


WEEK = f"date >= {AS_OF_DATE} - 7"


@query("weekly_city_average", "Q18 T1", out(f"(SELECT *, {case_category('weekly_avg', fv.AQI_CATEGORIES, 'Hazardous')} AS category FROM (SELECT province, round(avg(avg_aqi_vn), 1) AS weekly_avg FROM overview_day WHERE {WEEK} GROUP BY province ORDER BY weekly_avg DESC, province LIMIT 20))", "province ~weekly_avg category"))
def _(spark, d):
    return reports.weekly_city_average(over(spark, d), R.AS_OF_DATE)


@query("weekly_worst_wards", "Q18 T1", out(f"(SELECT province, ward_name, round(max(max_aqi_vn), 0) AS peak_aqi, first(main_pollutant ORDER BY max_aqi_vn DESC, date DESC, source_mix DESC) FILTER (WHERE max_aqi_vn IS NOT NULL) AS pollutant FROM overview_day WHERE {WEEK} AND ward_name <> '' GROUP BY ALL ORDER BY peak_aqi DESC, province, ward_name LIMIT 5)", "province ward_name ~peak_aqi pollutant"))
def _(spark, d):
    return reports.weekly_worst_wards(over(spark, d), R.AS_OF_DATE)


@query("week_over_week", "Q18 G23", out(f"(SELECT *, this_week - last_week AS delta, CASE WHEN this_week - last_week > 0 THEN 'up' ELSE 'down' END AS trend FROM (SELECT province, round(avg(CASE WHEN {WEEK} THEN avg_aqi_vn END), 1) AS this_week, round(avg(CASE WHEN date BETWEEN {AS_OF_DATE} - 14 AND {AS_OF_DATE} - 8 THEN avg_aqi_vn END), 1) AS last_week FROM overview_day WHERE date >= {AS_OF_DATE} - 14 GROUP BY province) WHERE this_week IS NOT NULL AND last_week IS NOT NULL)", "province ~this_week ~last_week ~delta trend"))
def _(spark, d):
    return reports.week_over_week(over(spark, d), R.AS_OF_DATE)


@query("weekly_dominant_pollutant", "Q18 W5", with_ctes(f"SELECT province, pollutant, hours FROM (SELECT *, row_number() OVER (PARTITION BY province ORDER BY hours DESC, pollutant) AS rn FROM (SELECT province, main_pollutant AS pollutant, count(*) AS hours FROM overview_day WHERE {WEEK} AND main_pollutant IS NOT NULL GROUP BY province, main_pollutant)) WHERE rn = 1"))
def _(spark, d):
    return reports.weekly_dominant_pollutant(over(spark, d), R.AS_OF_DATE)


@query("alert_rules", "Q19", out(f"""(SELECT r.rule, m.subject, m.metric, m.observed, r.threshold FROM (
  SELECT province AS subject, 'aqi_2h' AS metric, max(CASE WHEN latest_hour >= {AS_OF} - INTERVAL 2 HOUR THEN current_aqi_vn END) AS observed FROM current_status WHERE latest_hour >= {AS_OF} - INTERVAL 3 HOUR GROUP BY province
  UNION ALL SELECT province, 'pm25_3h', max(pm25) FROM current_status WHERE latest_hour >= {AS_OF} - INTERVAL 3 HOUR GROUP BY province
  UNION ALL SELECT province, 'pm10_3h', max(pm10) FROM current_status WHERE latest_hour >= {AS_OF} - INTERVAL 3 HOUR GROUP BY province
  UNION ALL SELECT 'platform', 'latest_ingest_lag_hours', CAST(latest_ingest_lag_hours AS DOUBLE) FROM ({HEALTH_SQL}) UNION ALL SELECT 'platform', 'latest_lag_hours', CAST(latest_lag_hours AS DOUBLE) FROM ({HEALTH_SQL})
  UNION ALL SELECT 'platform', 'reliable_pct', reliable_pct FROM ({HEALTH_SQL}) UNION ALL SELECT 'platform', 'attention_count', CAST(attention_count AS DOUBLE) FROM ({HEALTH_SQL})) m
  JOIN (VALUES ('aqi_vn_warning', 'aqi_2h', 1, 150e0), ('aqi_vn_critical', 'aqi_2h', 1, 200e0), ('pm25_warning', 'pm25_3h', 1, 75e0), ('pm10_warning', 'pm10_3h', 1, 150e0), ('ingest_lag', 'latest_ingest_lag_hours', 1, 3e0), ('observation_lag', 'latest_lag_hours', 1, 3e0), ('reliable_coverage', 'reliable_pct', -1, 70e0), ('attention_count', 'attention_count', 1, 500e0)) r(rule, metric, sign, threshold)
  ON m.metric = r.metric AND r.sign * m.observed > r.sign * r.threshold)""", "rule subject metric ~observed ~threshold"))
def _(spark, d):
    m = M(spark, d)
    return alerts.alerts(status(m), marts.health_summary(health(m), R.AS_OF), R.AS_OF)


@query("month_over_month", "Q20", out("(SELECT province, avg(CASE WHEN month = DATE '2024-01-01' THEN avg_aqi_vn END) AS this_month_aqi, avg(CASE WHEN month = DATE '2023-12-01' THEN avg_aqi_vn END) AS last_month_aqi FROM province_monthly WHERE month >= DATE '2023-12-01' GROUP BY province)", "province ~this_month_aqi ~last_month_aqi"))
def _(spark, d):
    return reports.month_over_month(M(spark, d).province("month"), R.AS_OF_DATE)


@query("province_gap", "Q20 J14", out("(SELECT 'Tuyên Quang' AS group_1, a.m AS max_1, 'Đắk Lắk' AS group_2, b.m AS max_2, a.m - b.m AS difference FROM (SELECT max(pm25_avg) AS m FROM province_daily WHERE province = 'Tuyên Quang') a CROSS JOIN (SELECT max(pm25_avg) AS m FROM province_daily WHERE province = 'Đắk Lắk') b)", "group_1 ~max_1 group_2 ~max_2 ~difference"))
def _(spark, d):
    return joins.group_gap(M(spark, d).province("day"), "province", "Tuyên Quang", "Đắk Lắk", "pm25_avg")


@query("question_averages", "Q20", out(f"(SELECT province, avg(humidity_daily_avg) AS avg_humidity, avg(wind_daily_avg) AS avg_wind, avg(pm25_daily_avg) AS avg_pm25 FROM weather_daily WHERE date >= {AS_OF_DATE} - 30 GROUP BY province)", "province ~avg_humidity ~avg_wind ~avg_pm25"))
def _(spark, d):
    return reports.averages_since(weather_days(spark, d), R.AS_OF_DATE, 30, ["province"], avg_humidity="humidity_daily_avg", avg_wind="wind_daily_avg", avg_pm25="pm25_daily_avg")


@query("region_averages", "Q20", out(f"(SELECT region_3, avg(avg_aqi_vn) AS avg_aqi, avg(pm25_avg) AS avg_pm25 FROM province_daily WHERE date >= {AS_OF_DATE} - 7 GROUP BY region_3)", "region_3 ~avg_aqi ~avg_pm25"))
def _(spark, d):
    return reports.averages_since(M(spark, d).province("day"), R.AS_OF_DATE, 7, ["region_3"], avg_aqi="avg_aqi_vn", avg_pm25="pm25_avg")


@query("most_polluted_region", "Q20 T1", out(f"(SELECT region_3, avg(pm25_avg) AS average FROM province_daily WHERE date >= {AS_OF_DATE} - 7 AND region_3 <> '' GROUP BY region_3 ORDER BY average DESC NULLS LAST, region_3 LIMIT 1)", "region_3 ~average"))
def _(spark, d):
    return reports.most_polluted(M(spark, d).province("day"), R.AS_OF_DATE, 7, "region_3")


@query("breach_days_since", "Q20", with_ctes(f"SELECT province, count(*) AS breach_days FROM compliance WHERE {WEEK} AND who_pm25_breach = 1 GROUP BY province"))
def _(spark, d):
    return reports.breach_days_since(comp(spark, d), R.AS_OF_DATE, 7)


@query("top_province_of_day", "Q20 T1", out("(SELECT province, max(pm25_avg) AS highest FROM province_daily WHERE date = DATE '2024-01-30' GROUP BY province ORDER BY highest DESC, province LIMIT 1)", "province ~highest"))
def _(spark, d):
    return reports.top_metric_on(M(spark, d).province("day"), date(2024, 1, 30), "pm25_avg")


@query("monthly_context", "Q21", out("(SELECT CAST(date_trunc('month', date) AS DATE) AS month, avg(avg_aqi_vn) AS avg_aqi, max(max_aqi_vn) AS max_aqi FROM overview_day WHERE source_mix = 'observed' AND avg_aqi_vn IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 6)", "month ~avg_aqi ~max_aqi"))
def _(spark, d):
    return reports.monthly_context(over(spark, d), "avg_aqi_vn", "max_aqi_vn", "observed")


@query("pollution_spikes", "Q21", out("(SELECT CAST(date AS VARCHAR) AS date, province, ward_code, avg_aqi_vn AS avg_aqi, max_aqi_vn AS max_aqi FROM overview_day WHERE source_mix = 'observed' AND max_aqi_vn > 150)", "date province ward_code ~avg_aqi ~max_aqi"))
def _(spark, d):
    return reports.spikes(over(spark, d), "avg_aqi_vn", "max_aqi_vn", "observed")


@query("active_counts", "G22", with_ctes("SELECT source_mix, count(DISTINCT date) FILTER (WHERE avg_aqi_vn IS NOT NULL) AS days, count(DISTINCT province) FILTER (WHERE avg_aqi_vn IS NOT NULL) AS provinces, count(DISTINCT ward_code) FILTER (WHERE avg_aqi_vn IS NOT NULL) AS wards FROM overview_day GROUP BY source_mix"))
def _(spark, d):
    return reports.active_counts(over(spark, d), "avg_aqi_vn")


@query("hierarchy", "U3", with_ctes("SELECT DISTINCT region_3, region_8, province FROM dim"))
def _(spark, d):
    return reports.hierarchy(M(spark, d).dim)


@query("ward_list", "U3", with_ctes("SELECT DISTINCT ward_code, ward_name FROM dim WHERE province = 'Đắk Lắk'"))
def _(spark, d):
    return reports.ward_list(M(spark, d).dim, "Đắk Lắk")


@query("extreme_days", "T5", out("(SELECT 'max' AS kind, * FROM (SELECT date, round(avg(avg_aqi_vn), 1) AS avg_val, round(max(avg_aqi_vn), 0) AS max_val FROM overview_day WHERE avg_aqi_vn IS NOT NULL GROUP BY date ORDER BY avg_val DESC, date DESC LIMIT 1) UNION ALL SELECT 'min', * FROM (SELECT date, round(avg(avg_aqi_vn), 1) AS avg_val, round(max(avg_aqi_vn), 0) AS max_val FROM overview_day WHERE avg_aqi_vn IS NOT NULL GROUP BY date ORDER BY avg_val, date LIMIT 1))", "kind date ~avg_val ~max_val"))
def _(spark, d):
    return ranking.arg_rows(reports.period_trend(over(spark, d), "avg_aqi_vn"), "avg_val", ["date"])


# --- the same operators on the large driver tables -----------------------------------------------

@query("top_customers", "T1", out("(SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey ORDER BY total DESC, o_custkey LIMIT 20)", "o_custkey ~total"))
def _(spark, d):
    return ranking.top_n(R.table(spark, d, "orders"), ["o_custkey"], F.sum("o_totalprice"), 20, "total")


@query("dominant_customer", "W5", with_ctes("SELECT l_suppkey, l_partkey, n FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) AS rn FROM (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY l_suppkey, l_partkey)) WHERE rn = 1"))
def _(spark, d):
    return ranking.dominant(R.table(spark, d, "lineitem"), ["l_suppkey"], "l_partkey")


@query("exact_quantiles", "G17", out("(SELECT l_returnflag, l_linestatus, p, list_sort(list(l_extendedprice))[CAST(least(floor(count(*) * p), count(*) - 1) AS BIGINT) + 1] AS quantile FROM lineitem, (VALUES (0.25e0), (0.75e0)) v(p) GROUP BY l_returnflag, l_linestatus, p)", "l_returnflag l_linestatus ~p ~quantile"))
def _(spark, d):
    return ranking.exact_quantiles(R.table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", [0.25, 0.75])


@query("large_ranking", "W3", with_ctes("SELECT o_orderkey, rank() OVER (ORDER BY floor(o_totalprice / 10) DESC) AS price_rank FROM orders"))
def _(spark, d):
    o = R.table(spark, d, "orders").withColumn("band", F.floor(F.col("o_totalprice") / 10).cast("double"))
    return ranking.rank_large(o, "band", "price_rank").select("o_orderkey", "price_rank")


@query("busy_suppliers", "G23", out("(SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders, avg(l_quantity) AS avg_quantity FROM lineitem GROUP BY l_suppkey HAVING count(DISTINCT l_orderkey) > 100 AND avg(l_quantity) > 25)", "l_suppkey orders ~avg_quantity"))
def _(spark, d):
    return R.table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count_distinct("l_orderkey").alias("orders"), F.avg("l_quantity").alias("avg_quantity")).filter(
        (F.col("orders") > 100) & (F.col("avg_quantity") > 25))


@query("band_join", "J8", out("(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, b.health_effects FROM lineitem LEFT JOIN bands b ON b.pollutant_key = CASE WHEN l_returnflag = 'A' THEN 'pm25' WHEN l_returnflag = 'N' THEN 'o3' ELSE 'xx' END AND l_extendedprice / 200 >= b.lo AND l_extendedprice / 200 <= b.hi)", "l_orderkey l_linenumber l_partkey l_suppkey health_effects"))
def _(spark, d):
    li = R.table(spark, d, "lineitem").withColumns({"key": F.when(F.col("l_returnflag") == "A", "pm25").when(F.col("l_returnflag") == "N", "o3").otherwise("xx"), "v": F.col("l_extendedprice") / 200})
    b = R.bands(spark).withColumnsRenamed({"pollutant_key": "_p", "epa_aqi_bp_lo": "_lo", "epa_aqi_bp_hi": "_hi"})
    return joins.band_join(li, b, "key", "v", "_p", "_lo", "_hi").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "health_effects")


@query("conditional_distinct", "G15 G22", with_ctes("SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned_parts FROM lineitem GROUP BY l_suppkey"))
def _(spark, d):
    pairs = R.table(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.max((F.col("l_returnflag") == "R").cast("int")).alias("r"))
    return pairs.groupBy("l_suppkey").agg(F.count("l_partkey").alias("parts"), F.count_if(F.col("r") == 1).alias("returned_parts"))


