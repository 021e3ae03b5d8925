"""Parameterised queries over the marts (dashboard, weekly report, alerts)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions import naming, times
from hazeframe.functions.aggregates import arg_max, avg_where, count_distinct_where, mode_of, ratio
from hazeframe.functions.aqi import aqi_category, aqi_histogram_key, vn_aqi
from hazeframe.functions.predicates import monthly_where, present
from hazeframe.operators.joins import latest_only
from hazeframe.operators.ranking import dominant

def _on(where: Column | None) -> Column:
    """An optional filter as a predicate."""
    return F.lit(True) if where is None else where


def _hours_back(column: str, as_of, hours: int) -> Column:
    return F.col(column) >= F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS")


def _days_back(column: str, as_of, days: int) -> Column:
    return F.col(column) >= F.date_sub(F.lit(as_of).cast("date"), days)


# --- overview -------------------------------------------------------------------

def current_status_by_province(status: DataFrame, as_of, hours: int = 3) -> DataFrame:
    """Worst current index per province over wards seen in the last hours."""
    rows = status.filter(_hours_back("latest_hour", as_of, hours) & present("province") & F.col("current_aqi_vn").isNotNull())
    return rows.groupBy("province").agg(
        F.max("current_aqi_vn").alias("current_aqi"),
        arg_max("main_pollutant", "latest_hour", "ward_code").alias("main_pollutant"),
        F.avg("confidence_score").alias("confidence_score"), mode_of("source_mix").alias("source_mix"),
        F.sum("aqiin_observation_count").alias("aqiin_observation_count"),
        F.sum("openweather_observation_count").alias("openweather_observation_count"),
        F.max("latest_hour").alias("as_of_hour"),
    ).withColumn("confidence_level", naming.confidence_level("confidence_score"))


def national_kpi(overview: DataFrame, column: str, max_column: str, where: Column | None = None) -> DataFrame:
    """Average, peak and the place of the peak."""
    top = F.coalesce(max_column, column)
    rows = overview.filter(_on(where) & F.col(column).isNotNull() & present("province"))
    place = ["date", "ward_code", "source_mix"]
    return rows.agg(
        F.avg(column).alias("avg_val"), F.max(top).alias("max_val"),
        arg_max("province", top, *place).alias("max_val_province"), arg_max("ward_name", top, *place).alias("max_val_ward"),
        F.count_distinct("province").alias("province_count"), F.count_distinct("ward_code").alias("ward_count"),
        mode_of("main_pollutant").alias("dominant_pollutant"))


def map_wards(overview: DataFrame, column: str, where: Column | None = None, by_ward: bool = True) -> DataFrame:
    """Map points: one per ward, or one per province at the mean position."""
    rows = overview.filter(_on(where) & F.col(column).isNotNull() & present("province")
                           & (F.col("latitude") != 0) & (F.col("longitude") != 0))
    keys = ["province"]
    if by_ward:
        rows, keys = rows.filter(present("ward_name")), ["ward_code", "ward_name", "province"]
    spot = F.min if by_ward else F.avg
    return rows.groupBy(*keys).agg(
        spot("latitude").alias("latitude"), spot("longitude").alias("longitude"), F.avg(column).alias("display_val"),
        mode_of("main_pollutant").alias("main_pollutant"), F.avg("confidence_score").alias("confidence_score"),
        mode_of("source_mix").alias("source_mix"), F.sum("aqiin_observation_count").alias("aqiin_observation_count"),
        F.sum("openweather_observation_count").alias("openweather_observation_count"),
    ).withColumn("confidence_level", naming.confidence_level("confidence_score"))


def _station_points(per_station: DataFrame, stations: DataFrame, dim: DataFrame) -> DataFrame:
    spots = stations.filter((F.col("latitude") != 0) & (F.col("longitude") != 0)).groupBy(
        "station_name", "ward_code", "province").agg(
        F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude"))
    names = dim.groupBy("ward_code").agg(F.min(F.nullif(F.col("ward_name"), F.lit(""))).alias("_ward"))
    return (per_station.join(spots, "station_name").join(names, "ward_code", "left").select(
        "ward_code", F.col("station_name").alias("ward_name"),
        F.coalesce("_ward", "station_name").alias("actual_ward_name"), "province", "latitude", "longitude",
        "display_val", "main_pollutant", F.lit(1.0).alias("confidence_score"), F.lit("high").alias("confidence_level"),
        F.lit("observed").alias("source_mix"), "aqiin_observation_count",
        F.lit(0).cast("bigint").alias("openweather_observation_count")))


def map_stations_index(observed: DataFrame, stations: DataFrame, dim: DataFrame, where: Column | None = None) -> DataFrame:
    """Station points by mean of per-time worst sub-index.

    Reduced per station before it meets the station list, so that join moves
    one row per station.
    """
    sub = vn_aqi("parameter", "value")
    at_time = observed.filter(F.col("parameter").isin(fv.POLLUTANTS) & _on(where)).groupBy("station_name", "timestamp_utc").agg(
        F.max(sub).alias("overall_aqi"), arg_max("parameter", sub, "parameter").alias("main_pollutant"),
        F.count(F.lit(1)).alias("obs_count"))
    per_station = at_time.groupBy("station_name").agg(
        F.avg("overall_aqi").alias("display_val"), mode_of("main_pollutant").alias("main_pollutant"),
        F.sum("obs_count").alias("aqiin_observation_count"))
    return _station_points(per_station, stations, dim)


def map_stations_value(observed: DataFrame, stations: DataFrame, dim: DataFrame, parameter: str,
                       where: Column | None = None) -> DataFrame:
    """Station points by mean concentration of one parameter."""
    per_station = observed.filter((F.col("parameter") == parameter) & _on(where)).groupBy("station_name").agg(
        F.avg("value").alias("display_val"), F.count_distinct("timestamp_utc").alias("aqiin_observation_count"),
    ).withColumn("main_pollutant", F.lit(parameter))
    return _station_points(per_station, stations, dim)


def category_histogram(overview: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    rows = overview.filter(_on(where) & F.col(column).isNotNull() & present("province"))
    return rows.groupBy(aqi_histogram_key(column).alias("aqi_category_key")).agg(F.count(F.lit(1)).alias("count"))


def _two_windows(ranges: dict[str, date], column: str = "date", unit: str = "day") -> tuple[Column, Column]:
    return (times.in_range(column, ranges["previous_start"], ranges["previous_end"], unit),
            times.in_range(column, ranges["current_start"], ranges["current_end"], unit))


def worst_trend(overview: DataFrame, column: str, ranges: dict[str, date], where: Column | None = None, n: int = 1) -> DataFrame:
    """Provinces with the steepest relative rise between two adjacent windows."""
    before, now = _two_windows(ranges)
    rows = overview.filter(_on(where) & present("province") & F.col(column).isNotNull() & (before | now))
    out = rows.groupBy("province").agg(avg_where(column, before).alias("prev_avg"), avg_where(column, now).alias("curr_avg"))
    rise = (F.col("curr_avg") - F.col("prev_avg")) / F.col("prev_avg")
    return (out.filter((F.col("prev_avg") > 0) & (F.col("curr_avg") > F.col("prev_avg")))
            .withColumn("rise", rise).orderBy(F.desc("rise"), "province").limit(n))


def best_places(overview: DataFrame, column: str, ranges: dict[str, date], where: Column | None = None, n: int = 2) -> DataFrame:
    _, now = _two_windows(ranges)
    rows = overview.filter(_on(where) & now & present("province") & F.col(column).isNotNull())
    return rows.groupBy("province").agg(F.avg(column).alias("avg_val")).orderBy("avg_val", "province").limit(n)


def pollutant_improvement(overview: DataFrame, ranges: dict[str, date], where: Column | None = None) -> DataFrame:
    """Relative change of every pollutant between two windows, best first."""
    before, now = _two_windows(ranges)
    one = overview.filter(_on(where) & (before | now)).agg(
        *[f.alias(f"{p}_{w}") for p in fv.POLLUTANTS
          for w, f in (("prev", avg_where(f"{p}_avg", before)), ("curr", avg_where(f"{p}_avg", now)))])
    rows = F.array(*[F.struct(F.lit(p).alias("pollutant"), F.col(f"{p}_prev").alias("prev_avg"),
                              F.col(f"{p}_curr").alias("curr_avg")) for p in fv.POLLUTANTS])
    return (one.select(F.explode(rows).alias("r")).select("r.*")
            .withColumn("decrease_pct", ratio(F.col("prev_avg") - F.col("curr_avg"), "prev_avg") * 100)
            .withColumn("improved", F.coalesce(F.col("curr_avg") < F.col("prev_avg"), F.lit(False))))


def stagnation_leader(weather_daily: DataFrame, ranges: dict[str, date], n: int = 1) -> DataFrame:
    _, now = _two_windows(ranges)
    return (weather_daily.filter(now & present("province")).groupBy("province").agg(
        F.avg("wind_daily_avg").alias("avg_wind"), F.avg("stagnant_hours").alias("avg_stagnant_hours"),
        F.avg("pm25_daily_avg").alias("avg_pm25"))
        .orderBy(F.desc("avg_stagnant_hours"), F.desc("avg_pm25"), "province").limit(n))


# --- pollutants --------------------------------------------------------------------

def breach_counts(overview: DataFrame, column: str, who: float, national: float, where: Column | None = None) -> DataFrame:
    """Records, limit breaches, compliant records and the particulate ratio."""
    rows = overview.filter(_on(where) & F.col(column).isNotNull())
    n = F.count(F.lit(1))
    breaches, fine = F.count_if(F.col(column) > who), F.count_if(F.col(column) <= national)
    r = F.coalesce(ratio(F.avg("pm25_avg"), F.avg("pm10_avg")), F.lit(0.0))
    return rows.agg(
        n.alias("total_records"), breaches.alias("who_breach_cnt"), fine.alias("tcvn_compliance_cnt"),
        (ratio(breaches, n) * 100).alias("who_breach_pct"), (ratio(fine, n) * 100).alias("tcvn_compliance_pct"),
        r.alias("pm25_pm10_ratio"), naming.fingerprint_class(r).alias("probable_source"))


def breach_spotlight(df: DataFrame, column: str, limit: float, where: Column | None = None, n: int = 1) -> DataFrame:
    """Provinces with most records over a limit."""
    rows = df.filter(_on(where) & F.col(column).isNotNull() & present("province"))
    return (rows.groupBy("province").agg(F.count(F.lit(1)).alias("total_days"), F.count_if(F.col(column) > limit).alias("breach_days"))
            .orderBy(F.desc("breach_days"), F.desc("total_days"), "province").limit(n))


def sub_index_trend(summary: DataFrame, grain: str, where: Column | None = None) -> DataFrame:
    """Mean sub-index of each pollutant per hour or day."""
    key, part = ("datetime_hour", "") if grain == "hour" else ("date", "daily_")
    return summary.filter(_on(where)).groupBy(F.col(key).alias("time_key")).agg(
        *[F.round(F.avg(f"{p}_{part}aqi"), 1).alias(f"{p}_aqi") for p in fv.POLLUTANTS])


def source_value_trend(summary: DataFrame, column: str, grain: str, where: Column | None = None) -> DataFrame:
    key = "datetime_hour" if grain == "hour" else "date"
    return summary.filter(_on(where)).groupBy(F.col(key).alias("time_key"), "source").agg(F.round(F.avg(column), 1).alias("value"))


def class_counts(df: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """Row counts per class (fingerprint, compliance status, ...)."""
    return df.filter(_on(where)).groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))


# --- sources and history ---------------------------------------------------------------

SOURCES = ["aqiin", "waqi", "openweather"]


def source_stats(summary_daily: DataFrame, where: Column | None = None) -> DataFrame:
    rows = summary_daily.filter(_on(where) & F.col("source").isin(SOURCES))
    return rows.groupBy("source").agg(
        F.round(F.avg("daily_avg_aqi_us"), 1).alias("avg_aqi"), F.round(F.max("daily_max_aqi_us"), 0).alias("max_aqi"),
        F.round(F.min("daily_avg_aqi_us"), 1).alias("min_aqi"), F.count(F.lit(1)).alias("day_count"),
        F.count_if(F.col("daily_avg_aqi_us") <= 50).alias("good_days"))


def source_distribution(summary_daily: DataFrame, where: Column | None = None) -> DataFrame:
    return summary_daily.filter(_on(where) & F.col("source").isin(SOURCES)).select("source", F.col("daily_avg_aqi_us").alias("avg_aqi"))


def source_freshness(source_health: DataFrame) -> DataFrame:
    return source_health.filter(F.col("source").isin(SOURCES)).select(
        "source", "reliable_pct", "latest_lag_hours", "latest_ingest_lag_hours", "stale_count", "offline_count")


def history_stats(overview: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    return overview.filter(_on(where) & F.col(column).isNotNull()).agg(
        F.count_distinct("date").alias("total_days"), F.round(F.avg(column), 1).alias("overall_avg"),
        F.round(F.min(column), 1).alias("overall_min"), F.round(F.max(column), 0).alias("overall_max"))


def period_trend(overview: DataFrame, column: str, where: Column | None = None, max_column: str | None = None) -> DataFrame:
    """Mean and peak per date (a month's first day in monthly tables)."""
    return overview.filter(_on(where) & F.col(column).isNotNull()).groupBy("date").agg(
        F.round(F.avg(column), 1).alias("avg_val"), F.round(F.max(max_column or column), 0).alias("max_val"))


def monthly_trend(monthly: DataFrame, column: str, dates, mix: str) -> DataFrame:
    return period_trend(monthly, column, monthly_where(dates) & (F.col("source_mix") == mix))


def heat_map(overview: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    rows = overview.filter(_on(where) & present("province") & F.col(column).isNotNull())
    return rows.groupBy("province", F.col("date").cast("string").alias("date_str")).agg(
        F.round(F.avg(column), 1).alias("display_val"))


def hierarchy(dim: DataFrame) -> DataFrame:
    return dim.select("region_3", "region_8", "province").distinct()


def ward_list(dim: DataFrame, province: str) -> DataFrame:
    return dim.filter(F.col("province") == province).select("ward_code", "ward_name").distinct().orderBy("ward_name")


# --- alerts page ---------------------------------------------------------------------------

def compliance_timeline(compliance: DataFrame, as_of, days: int, where: Column | None = None) -> DataFrame:
    return class_counts(compliance, ["date", "compliance_status"], _on(where) & _days_back("date", as_of, days))


def breach_by_province(compliance: DataFrame, as_of, days: int, n: int = 15) -> DataFrame:
    rows = compliance.filter(_days_back("date", as_of, days) & present("province"))
    return (rows.groupBy("province").agg(F.sum("who_pm25_breach").alias("who_breach_days"),
                                         F.sum("tcvn_pm25_breach").alias("tcvn_breach_days"))
            .orderBy(F.desc(F.col("who_breach_days") + F.col("tcvn_breach_days")), "province").limit(n))


def high_risk_hours(province_hourly: DataFrame, as_of, days: int, where: Column | None = None) -> DataFrame:
    rows = province_hourly.filter(_days_back("date", as_of, days) & (F.col("source_mix") == "observed") & present("province") & _on(where))
    hours = rows.groupBy("province", "date", "datetime_hour").agg(F.max("avg_aqi_us").alias("hourly_aqi_us"))
    return hours.groupBy("province", "date").agg(
        F.count_if(F.col("hourly_aqi_us") > 150).alias("high_risk_hours"))


# --- traffic ----------------------------------------------------------------------------------

def traffic_profile(trend: DataFrame, column: str = "pm25", where: Column | None = None) -> DataFrame:
    """Mean congestion and concentration per local hour of day."""
    return trend.filter(_on(where)).groupBy(times.local_hour("datetime_hour").alias("hour_val")).agg(
        F.avg("avg_congestion").alias("avg_congestion"), F.avg(column).alias("avg_p"))


def traffic_summary(daily: DataFrame, where: Column | None = None) -> DataFrame:
    return daily.filter(_on(where)).agg(
        F.avg("pm25_daily_avg").alias("avg_pm25"), F.avg("congestion_daily_avg").alias("avg_congestion"),
        F.avg("pm25_congestion_uplift").alias("avg_pm25_uplift"),
        F.avg("traffic_pollution_impact_score").alias("avg_comovement_score"),
        F.avg("avg_traffic_coverage_ratio").alias("avg_traffic_coverage_ratio"),
        F.sum("total_hours").alias("observed_hours"), F.sum("low_congestion_hours").alias("low_congestion_hours"),
        F.sum("high_congestion_hours").alias("high_congestion_hours"),
        F.count("pm25_congestion_uplift").alias("uplift_sample_days"))


def traffic_ranking_wards(staged: DataFrame, dim: DataFrame, trend: DataFrame, column: str, mix: str,
                          where: Column | None = None, n: int = 12) -> DataFrame:
    """Wards by mean (province concentration x ward congestion)."""
    ward = staged.groupBy("ward_code", F.col("timestamp_utc").alias("datetime_hour")).agg(F.avg("value").alias("ward_congestion"))
    hours = trend.filter((F.col("source_mix") == mix) & F.col(column).isNotNull() & _on(where)).select(
        "province", "datetime_hour", F.col(column).alias("_c"))
    names = dim.filter(present("province", "ward_code")).select("ward_code", "ward_name", "province")
    rows = (ward.filter(F.col("ward_congestion") > 0).join(names, "ward_code").join(hours, ["province", "datetime_hour"]))
    return (rows.groupBy("ward_code").agg(
        F.min("ward_name").alias("label_col"), F.min(naming.location_class("province")).alias("location_type"),
        F.avg(F.col("_c") * F.col("ward_congestion")).alias("impact_score"))
        .orderBy(F.desc("impact_score"), "ward_code").limit(n))


def traffic_ranking_provinces(daily: DataFrame, column: str, where: Column | None = None, n: int = 12) -> DataFrame:
    rows = daily.filter(_on(where) & present("province"))
    return (rows.groupBy(F.col("province").alias("label_col")).agg(
        F.min("location_type").alias("location_type"),
        F.avg(F.col(f"{column}_daily_avg") * F.col("congestion_daily_avg")).alias("impact_score"))
        .orderBy(F.desc("impact_score"), "label_col").limit(n))


# --- weather ------------------------------------------------------------------------------------

def _stagnation(pollutant: str) -> list[Column]:
    return [ratio(F.sum(f"stagnant_{pollutant}_sum"), F.sum("stagnant_hours")).alias("avg_stag"),
            ratio(F.sum(f"dispersive_{pollutant}_sum"), F.sum("dispersive_hours")).alias("avg_disp")]


def _influence() -> Column:
    return ratio(F.col("avg_stag") - F.col("avg_disp"), "avg_stag") * 100


def weather_summary(daily: DataFrame, pollutant: str = "pm25", where: Column | None = None) -> DataFrame:
    return daily.filter(_on(where)).agg(
        *_stagnation(pollutant), F.avg("stagnant_air_probability").alias("stagnant_prob"),
        F.avg("wind_daily_avg").alias("avg_wind")).withColumn("influence_pct", _influence())


def weather_ranking(daily: DataFrame, pollutant: str = "pm25", where: Column | None = None, dim: DataFrame | None = None,
                    n: int = 10) -> DataFrame:
    """Provinces (or wards, given the dimension) by low-wind pollution risk."""
    key = "province" if dim is None else "ward_code"
    out = (daily.filter(_on(where) & present(key)).groupBy(key).agg(
        F.avg(ratio(f"{pollutant}_daily_avg", "wind_daily_avg")).alias("risk_index"), *_stagnation(pollutant))
        .withColumn("influence_pct", _influence()).orderBy(F.desc("risk_index"), key).limit(n))
    if dim is None:
        return out.withColumnRenamed("province", "label_col")
    names = dim.select("ward_code", F.nullif(F.col("ward_name"), F.lit("")).alias("_n"))
    return (out.join(names, "ward_code", "left").withColumn("label_col", F.coalesce("_n", "ward_code"))
            .drop("_n").withColumnRenamed("ward_code", "label_key"))


def weather_series(df: DataFrame, grain: str, column: str = "pm25", where: Column | None = None) -> DataFrame:
    """Concentration with weather per hour (local time), day or month."""
    if grain == "hour":
        key, names = F.from_utc_timestamp("datetime_hour", fv.LOCAL_ZONE), (column, "temperature", "humidity", "wind_speed")
    else:
        day = F.col("date") if grain == "day" else times.month_of("date")
        key, names = day.cast("timestamp"), (f"{column}_daily_avg", "temp_daily_avg", "humidity_daily_avg", "wind_daily_avg")
    value, temp, hum, wind = names
    return df.filter(_on(where)).groupBy(key.alias("time_key")).agg(
        F.avg(value).alias("avg_val"), F.avg(temp).alias("avg_temp"), F.avg(hum).alias("avg_hum"),
        F.avg(wind).alias("avg_wind"), F.avg("stagnant_air_probability").alias("stagnant_prob"),
    ).filter(F.col("avg_temp").isNotNull())


# --- health and platform ----------------------------------------------------------------------------

def health_kpis(ranking: DataFrame, where: Column | None = None) -> DataFrame:
    return ranking.filter(_on(where)).agg(
        F.max_by("province", F.struct("time_weighted_pm25", "province")).alias("worst_province"),
        F.max("time_weighted_pm25").alias("worst_pm25"), F.avg("time_weighted_pm25").alias("mean_pm25"),
        F.count_if(F.col("risk_category").isin("CRITICAL", "HIGH RISK")).alias("critical_high_risk_provinces"),
        (F.sum("population") / 1_000_000.0).alias("exposed_population_m"))


def risk_distribution(ranking: DataFrame, where: Column | None = None) -> DataFrame:
    """Share of provinces per risk category, in percent."""
    counts = ranking.filter(_on(where)).groupBy("risk_category").agg(F.count(F.lit(1)).alias("provinces"))
    total = F.sum("provinces").over(Window.partitionBy())  # over at most four categories
    return counts.withColumn("pct", F.col("provinces") * 100.0 / total)


def health_ranking(ranking: DataFrame, where: Column | None = None) -> DataFrame:
    return ranking.filter(_on(where)).select(
        "province", "population", "time_weighted_pm25", "confidence_score", "confidence_level", "source_mix",
        "total_exposure_index_m", "risk_category", "exposure_risk_category", "pollution_rank", "exposure_rank",
        "national_risk_rank").orderBy("national_risk_rank", "province")


def latest_confidence(overview_daily: DataFrame, mix: str = "observed") -> DataFrame:
    """Confidence of the wards reported on the latest day of a mix."""
    rows = latest_only(overview_daily.filter(F.col("source_mix") == mix))
    return rows.groupBy("source_mix", "confidence_level").agg(
        F.count(F.lit(1)).alias("ward_count"), F.round(F.avg("confidence_score"), 2).alias("confidence_score"),
        F.sum("aqiin_observation_count").alias("aqiin_observations"),
        F.sum("openweather_observation_count").alias("openweather_observations"))


def model_freshness(models: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Newest timestamp of each model, as epoch seconds."""
    out = None
    for name, (df, column) in models.items():
        part = df.agg(F.unix_timestamp(F.max(F.col(column).cast("timestamp"))).alias("latest_epoch")).select(
            F.lit(name).alias("model"), "latest_epoch")
        out = part if out is None else out.unionByName(part)
    return out


def run_history(control: DataFrame, n: int = 20) -> DataFrame:
    return control.select("source", "last_run", "last_success", "records_ingested", "lag_seconds", "error_message").orderBy(
        F.desc("last_run"), "source").limit(n)


def attention_list(health: DataFrame, n: int = 100) -> DataFrame:
    """Stale and offline sources, worst first."""
    return (health.filter(F.col("health_status").isin("Stale", "Offline"))
            .select("source", "province", "ward_code", "last_seen", "lag_hours", "health_status")
            .orderBy(F.desc("lag_hours"), "source", "province", "ward_code").limit(n))


# --- weekly report -------------------------------------------------------------------------------------

def weekly_city_average(overview: DataFrame, as_of, n: int = 20) -> DataFrame:
    rows = overview.filter(_days_back("date", as_of, 7))
    return (rows.groupBy("province").agg(F.round(F.avg("avg_aqi_vn"), 1).alias("weekly_avg"))
            .orderBy(F.desc("weekly_avg"), "province").limit(n).withColumn("category", aqi_category("weekly_avg")))


def weekly_worst_wards(overview: DataFrame, as_of, n: int = 5) -> DataFrame:
    rows = overview.filter(_days_back("date", as_of, 7) & present("ward_name"))
    return (rows.groupBy("province", "ward_name").agg(
        F.round(F.max("max_aqi_vn"), 0).alias("peak_aqi"),
        arg_max("main_pollutant", "max_aqi_vn", "date", "source_mix").alias("pollutant"))
        .orderBy(F.desc("peak_aqi"), "province", "ward_name").limit(n))


def week_over_week(overview: DataFrame, as_of: date) -> DataFrame:
    this = F.col("date") >= F.lit(as_of - timedelta(days=7))
    last = F.col("date").between(F.lit(as_of - timedelta(days=14)), F.lit(as_of - timedelta(days=8)))
    rows = overview.filter(_days_back("date", as_of, 14))
    return (rows.groupBy("province").agg(F.round(avg_where("avg_aqi_vn", this), 1).alias("this_week"),
                                         F.round(avg_where("avg_aqi_vn", last), 1).alias("last_week"))
            .filter(F.col("this_week").isNotNull() & F.col("last_week").isNotNull())
            .withColumn("delta", F.col("this_week") - F.col("last_week"))
            .withColumn("trend", F.when(F.col("delta") > 0, "up").otherwise("down")))


def weekly_dominant_pollutant(overview: DataFrame, as_of) -> DataFrame:
    rows = overview.filter(_days_back("date", as_of, 7) & F.col("main_pollutant").isNotNull())
    return dominant(rows, ["province"], "main_pollutant", "hours").withColumnRenamed("main_pollutant", "pollutant")


# --- question templates and context -----------------------------------------------------------------------

def month_over_month(province_monthly: DataFrame, as_of: date) -> DataFrame:
    this = F.trunc(F.lit(as_of), "month")
    last = F.add_months(this, -1)
    rows = province_monthly.filter(F.col("month") >= last)
    return rows.groupBy("province").agg(avg_where("avg_aqi_vn", F.col("month") == this).alias("this_month_aqi"),
                                        avg_where("avg_aqi_vn", F.col("month") == last).alias("last_month_aqi"))


def averages_since(daily: DataFrame, as_of, days: int, keys: list[str], **columns: str) -> DataFrame:
    """Means of chosen columns per key over the last days (question templates)."""
    return daily.filter(_days_back("date", as_of, days)).groupBy(*keys).agg(
        *[F.avg(c).alias(name) for name, c in columns.items()])


def most_polluted(daily: DataFrame, as_of, days: int, key: str, column: str = "pm25_avg", n: int = 1) -> DataFrame:
    """The ``n`` values of ``key`` (a region, a province) with the highest mean over the last days."""
    return (averages_since(daily.filter(present(key)), as_of, days, [key], average=column)
            .orderBy(F.desc_nulls_last("average"), key).limit(n))


def breach_days_since(compliance: DataFrame, as_of, days: int) -> DataFrame:
    rows = compliance.filter(_days_back("date", as_of, days) & (F.col("who_pm25_breach") == 1))
    return rows.groupBy("province").agg(F.count(F.lit(1)).alias("breach_days"))


def top_metric_on(province_daily: DataFrame, day: date, column: str, n: int = 1) -> DataFrame:
    return (province_daily.filter(F.col("date") == F.lit(day)).groupBy("province").agg(F.max(column).alias("highest"))
            .orderBy(F.desc("highest"), "province").limit(n))


def monthly_context(overview: DataFrame, column: str, max_column: str, mix: str, n: int = 6) -> DataFrame:
    rows = overview.filter(present("province") & F.col(column).isNotNull() & (F.col("source_mix") == mix))
    return (rows.groupBy(times.month_of("date").alias("month")).agg(F.avg(column).alias("avg_aqi"), F.max(max_column).alias("max_aqi"))
            .orderBy(F.desc("month")).limit(n))


def spikes(overview: DataFrame, column: str, max_column: str, mix: str, where: Column | None = None, over: float = 150) -> DataFrame:
    rows = overview.filter(_on(where) & (F.col(max_column) > over) & present("province") & (F.col("source_mix") == mix))
    return rows.select(F.col("date").cast("string").alias("date"), "province", "ward_code",
                       F.col(column).alias("avg_aqi"), F.col(max_column).alias("max_aqi"))


def active_counts(overview: DataFrame, column: str) -> DataFrame:
    """Distinct days, provinces and wards with a value, per mix."""
    has = F.col(column).isNotNull()
    return overview.groupBy("source_mix").agg(
        count_distinct_where("date", has).alias("days"), count_distinct_where("province", has).alias("provinces"),
        count_distinct_where("ward_code", has).alias("wards"))


