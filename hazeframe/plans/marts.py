"""Analytics marts over the facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions import naming, times
from hazeframe.functions.aggregates import arg_max, avg_where, mode_of, ratio, sum_where
from hazeframe.functions.aqi import aqi_category
from hazeframe.operators import joins
from hazeframe.operators.ranking import rank_desc


def current_status(ward_hourly: DataFrame, dim: DataFrame) -> DataFrame:
    """Latest known values of every ward (newest non-NULL per column)."""
    columns = {"region_3": "region_3", "region_8": "region_8", "avg_aqi_us": "current_aqi_us",
               "avg_aqi_vn": "current_aqi_vn", "pm25_avg": "pm25", "pm10_avg": "pm10",
               "main_pollutant": "main_pollutant", "aqiin_observation_count": "aqiin_observation_count",
               "openweather_observation_count": "openweather_observation_count", "source_mix": "source_mix",
               "confidence_score": "confidence_score", "confidence_level": "confidence_level",
               "last_ingested_at": "ingest_time"}
    latest = ward_hourly.groupBy("province", "ward_code").agg(
        *[arg_max(src, "datetime_hour", "source_mix").alias(dst) for src, dst in columns.items()],
        F.max("datetime_hour").alias("latest_hour"))
    where = dim.groupBy("ward_code").agg(F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude"))
    return latest.join(where, "ward_code", "left").withColumn("data_source", F.lit("consolidated"))


def compliance(province_daily: DataFrame) -> DataFrame:
    """Daily limit breaches (WHO, national) and status per province and mix."""
    def breach(p, limits):
        return F.coalesce((F.col(f"{p}_avg") > limits[p]).cast("int"), F.lit(0))
    return province_daily.select(
        "date", "province", "region_3", "region_8", "pm25_avg", "pm10_avg", "confidence_score", "source_mix",
        breach("pm25", fv.WHO_DAILY).alias("who_pm25_breach"), breach("pm10", fv.WHO_DAILY).alias("who_pm10_breach"),
        breach("pm25", fv.NATIONAL_DAILY).alias("tcvn_pm25_breach"),
        breach("pm10", fv.NATIONAL_DAILY).alias("tcvn_pm10_breach"),
        F.when(F.col("pm25_avg") > fv.NATIONAL_DAILY["pm25"], "Unhealthy (TCVN Breach)")
        .when(F.col("pm25_avg") > fv.WHO_DAILY["pm25"], "Warning (WHO Breach)")
        .otherwise("Good/Safe").alias("compliance_status"),
        F.col("last_ingested_at").alias("ingest_time"))


def health_impact(ward_hourly: DataFrame, bands: DataFrame) -> DataFrame:
    """Hours at high risk per ward-day with the advice at the day's peak.

    ``bands``: pollutant_key, health_effects, epa_aqi_bp_lo, epa_aqi_bp_hi.
    """
    b = bands.select(F.col("pollutant_key").alias("_p"), "health_effects", F.col("epa_aqi_bp_lo").alias("_lo"),
                     F.col("epa_aqi_bp_hi").alias("_hi"))
    joined = joins.band_join(ward_hourly, b, "main_pollutant", "avg_aqi_us", "_p", "_lo", "_hi")
    # an absent index compares false at every step and so counts as hazardous
    category = F.coalesce(aqi_category("avg_aqi_us"), F.lit(fv.AQI_CATEGORY_ABOVE))
    high, n = F.count_if(category.isin(fv.HIGH_RISK_CATEGORIES)), F.count(F.lit(1))
    return joined.groupBy("date", "province", "ward_code").agg(
        n.alias("total_hours"), high.alias("high_risk_hours"), (high / n).alias("high_risk_exposure_pct"),
        arg_max("health_effects", "avg_aqi_us", "source_mix", "datetime_hour").alias("primary_health_advice"),
        F.avg("confidence_score").alias("confidence_score"), mode_of("confidence_level").alias("confidence_level"),
        mode_of("source_mix").alias("source_mix"), F.max("last_ingested_at").alias("ingest_time"),
    ).withColumns({"region_3": naming.region_3("province"), "region_8": naming.region_8("province")})


def temporal_patterns(province_hourly: DataFrame) -> DataFrame:
    """Hour-of-day by day-of-week profile per province."""
    return province_hourly.groupBy(
        "province", "region_3", "region_8", F.hour("datetime_hour").alias("hour_of_day"),
        times.iso_day_of_week("datetime_hour").alias("day_of_week")).agg(
        F.avg("avg_aqi_us").alias("avg_aqi_us"), F.avg("avg_aqi_vn").alias("avg_aqi_vn"),
        F.avg("pm25_avg").alias("avg_pm25"), F.avg("pm10_avg").alias("avg_pm10"),
        F.avg("confidence_score").alias("confidence_score"), mode_of("source_mix").alias("dominant_source_mix"),
        F.count(F.lit(1)).alias("reading_count"), F.max("last_ingested_at").alias("ingest_time"))


def fingerprint(ward_hourly: DataFrame) -> DataFrame:
    """PM2.5 / PM10 ratio class per ward-day and mix."""
    rows = ward_hourly.filter((F.col("pm25_avg") > 0) & (F.col("pm10_avg") > 0))
    return rows.groupBy("date", "province", "ward_code", "region_3", "region_8", "source_mix").agg(
        F.avg("pm25_avg").alias("pm25"), F.avg("pm10_avg").alias("pm10"),
        F.avg("confidence_score").alias("confidence_score"), mode_of("confidence_level").alias("confidence_level"),
        F.max("last_ingested_at").alias("ingest_time"),
    ).withColumn("pm25_pm10_ratio", ratio("pm25", "pm10")).withColumn(
        "probable_source", naming.fingerprint_class("pm25_pm10_ratio"))


def traffic_trend(staged: DataFrame, dim: DataFrame, province_hourly: DataFrame) -> DataFrame:
    """Province-hour congestion beside air quality.

    Traffic is reduced to ward-hours first, so distinct wards are counted by
    counting rows.
    """
    ward = staged.groupBy("ward_code", "province_name", "timestamp_utc").agg(
        F.sum("value").alias("s"), F.count("value").alias("n"), F.count(F.lit(1)).alias("rows"),
        F.max("value").alias("top"), F.max("ingest_time").alias("i"))
    geography = dim.select("ward_code", F.col("province").alias("_p"))
    located = ward.join(geography, "ward_code", "left").withColumn("province", F.coalesce("_p", "province_name"))
    once = located.groupBy("province", F.col("timestamp_utc").alias("datetime_hour"), "ward_code").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("rows").alias("rows"), F.max("top").alias("top"), F.max("i").alias("i"))
    traffic = once.groupBy("province", "datetime_hour").agg(
        (F.sum("s") / F.sum("n")).alias("avg_congestion"), F.sum("rows").alias("traffic_sample_count"),
        F.count("ward_code").alias("traffic_ward_count"), F.count_if(F.col("top") > 0).alias("positive_traffic_ward_count"),
        F.max("i").alias("last_traffic_ingested_at"))
    wards = dim.groupBy("province").agg(F.count(F.lit(1)).alias("_wards"))
    aq = province_hourly.select(
        "datetime_hour", "date", "province", "region_3", "region_8", F.col("pm25_avg").alias("pm25"),
        F.col("pm10_avg").alias("pm10"), F.col("co_avg").alias("co"), "source_mix", "confidence_score",
        "confidence_level", "last_ingested_at")
    return (aq.join(traffic, ["province", "datetime_hour"]).join(wards, "province", "left").withColumns({
        "ward_code": F.lit(""), "congestion_index": F.col("avg_congestion"),
        "traffic_coverage_ratio": ratio("traffic_ward_count", "_wards").cast("float"),
        "traffic_pollution_impact_score": (F.col("pm25") * F.col("avg_congestion")).cast("float"),
        "traffic_contribution_pct": F.lit(0.0).cast("float")}).drop("_wards"))


def weather_trend(ward_hourly: DataFrame, weather: DataFrame, ward: str = "ward_code") -> DataFrame:
    """Ward-hour particulates with weather, province average as fallback.

    ``ward`` names what weather belongs to: the ward, or the place that ``ward_hourly`` gives for it.
    """
    lineage = ["raw_loaded_at", "raw_sync_run_id", "raw_sync_started_at"]
    w = weather.select(
        ward, "datetime_hour",
        *[F.coalesce(c, f"province_{c}").alias(c) for c in ("temperature", "humidity", "wind_speed", "wind_direction")],
        "stagnant_air_probability", F.struct(*lineage).alias("_w"))
    a = ward_hourly.select(
        *dict.fromkeys([ward, "datetime_hour", "date", "province", "ward_code"]), "region_3", "region_8", F.col("pm25_avg").alias("pm25"),
        F.col("pm10_avg").alias("pm10"), "source_mix", "confidence_score", "confidence_level",
        F.struct(*lineage).alias("_a"))
    epoch = F.lit(0).cast("timestamp")
    both = a.join(w, [ward, "datetime_hour"], "left")
    return both.select(*dict.fromkeys(["ward_code", "datetime_hour", *[c for c in both.columns if c in ("ward_code", "datetime_hour") or c != ward]])).withColumns({
        "weather_influence_pct": F.lit(0.0).cast("float"),
        "raw_loaded_at": F.greatest(F.coalesce("_a.raw_loaded_at", epoch), F.coalesce("_w.raw_loaded_at", epoch)),
        "raw_sync_run_id": F.coalesce("_w.raw_sync_run_id", "_a.raw_sync_run_id", F.lit("")),
        "raw_sync_started_at": F.greatest(F.coalesce("_a.raw_sync_started_at", epoch),
                                          F.coalesce("_w.raw_sync_started_at", epoch)),
    }).drop("_a", "_w")


def _sorted_element(values: Column, p: float) -> Column:
    """Element floor(p*n) of a small array (at most the hours of a day)."""
    a = F.sort_array(values)
    return F.get(a, F.least(F.floor(F.size(a) * p), F.size(a) - 1).cast("int"))


def traffic_correlation(trend: DataFrame) -> DataFrame:
    """Daily PM2.5 at low and high congestion per province and mix.

    A group holds one row per hour of one day, at most 24, so its readings
    travel as one short array: thresholds and band means come from a single
    shuffle with no join back.
    """
    reading = F.struct(F.col("avg_congestion").alias("c"), F.col("pm25").alias("p"))
    day = trend.groupBy("date", "province", "source_mix", "region_3", "region_8").agg(
        F.avg("pm25").alias("pm25_daily_avg"), F.avg("pm10").alias("pm10_daily_avg"),
        F.avg("avg_congestion").alias("congestion_daily_avg"), F.sum("pm25").alias("sum_pm25"),
        F.sum("pm10").alias("sum_pm10"), F.count(F.lit(1)).alias("total_hours"),
        F.avg("confidence_score").alias("confidence_score"), mode_of("confidence_level").alias("confidence_level"),
        F.avg("traffic_ward_count").alias("avg_traffic_ward_count"),
        F.avg("positive_traffic_ward_count").alias("avg_positive_traffic_ward_count"),
        F.avg("traffic_coverage_ratio").alias("avg_traffic_coverage_ratio"),
        F.array_sort(F.collect_list(reading)).alias("_r"))
    congestion = F.transform("_r", lambda r: r["c"])
    day = day.withColumns({
        "low_congestion_threshold": _sorted_element(congestion, 0.25),
        "high_congestion_threshold": _sorted_element(congestion, 0.75)})
    low = F.filter("_r", lambda r: r["c"] <= F.col("low_congestion_threshold"))
    high = F.filter("_r", lambda r: r["c"] >= F.col("high_congestion_threshold"))

    def mean_p(rows):
        present = F.filter(F.transform(rows, lambda r: r["p"]), lambda p: p.isNotNull())
        return ratio(F.aggregate(present, F.lit(0.0), lambda a, p: a + p), F.size(present))

    day = day.withColumns({
        "pm25_low_congestion_avg": mean_p(low), "pm25_high_congestion_avg": mean_p(high),
        "low_congestion_hours": F.size(low).cast("bigint"), "high_congestion_hours": F.size(high).cast("bigint")}).drop("_r")
    enough = (F.col("total_hours") >= 24) & (F.col("low_congestion_hours") >= 3) & (F.col("high_congestion_hours") >= 3)
    return day.withColumns({
        "ward_code": F.lit(None).cast("string"), "location_type": naming.location_class("province"),
        "pm25_congestion_uplift": F.when(
            enough, F.col("pm25_high_congestion_avg") - F.col("pm25_low_congestion_avg")).cast("float"),
        "traffic_pollution_impact_score": (F.col("pm25_daily_avg") * F.col("congestion_daily_avg")).cast("float"),
        "traffic_contribution_pct": F.lit(None).cast("float")}).filter(F.col("congestion_daily_avg") > 0)


def weather_correlation(trend: DataFrame) -> DataFrame:
    """Daily particulates in stagnant and dispersive hours per ward and mix."""
    still, breezy = F.col("wind_speed") < 1.0, F.col("wind_speed") >= 2.0
    rows = trend.filter((F.col("province") != "") & (F.col("ward_code") != ""))
    day = rows.groupBy("date", "province", "ward_code", "source_mix", "region_3", "region_8").agg(
        F.avg("pm25").alias("pm25_daily_avg"), F.avg("pm10").alias("pm10_daily_avg"),
        F.avg("temperature").alias("temp_daily_avg"), F.avg("humidity").alias("humidity_daily_avg"),
        F.avg("wind_speed").alias("wind_daily_avg"), F.sum("pm25").alias("sum_pm25"), F.sum("pm10").alias("sum_pm10"),
        F.count(F.lit(1)).alias("total_hours"), F.avg("confidence_score").alias("confidence_score"),
        mode_of("confidence_level").alias("confidence_level"),
        sum_where("pm25", still).alias("stagnant_pm25_sum"), sum_where("pm10", still).alias("stagnant_pm10_sum"),
        F.count_if(still).alias("stagnant_hours"),
        sum_where("pm25", breezy).alias("dispersive_pm25_sum"), sum_where("pm10", breezy).alias("dispersive_pm10_sum"),
        F.count_if(breezy).alias("dispersive_hours"))
    stagnant = ratio("stagnant_pm25_sum", "stagnant_hours")
    dispersive = ratio("dispersive_pm25_sum", "dispersive_hours")
    return day.withColumns({
        "wind_dispersal_risk_index": F.coalesce(ratio("pm25_daily_avg", "wind_daily_avg"), F.lit(0.0)).cast("float"),
        "weather_influence_pct": (F.coalesce(ratio(stagnant - dispersive, stagnant), F.lit(0.0)) * 100).cast("float"),
        "stagnant_air_probability": F.col("stagnant_hours") / F.col("total_hours")})


def data_health(summary_hourly: DataFrame, as_of) -> DataFrame:
    """Freshness of every source and ward."""
    now = F.lit(as_of).cast("timestamp")
    seen = summary_hourly.groupBy("province", "region_3", "region_8", "ward_code", "source").agg(
        F.max("datetime_hour").alias("last_seen"), F.max("ingest_time").alias("last_ingested_at"),
        F.max("raw_loaded_at").alias("last_loaded_at"))
    lag = times.hours_between("last_seen", now)
    return seen.withColumns({
        "observation_lag_hours": lag, "ingest_lag_hours": times.hours_between("last_loaded_at", now), "lag_hours": lag,
        "health_status": naming.health_class(lag), "is_reliable": lag <= 3})


def health_summary(health: DataFrame, as_of, by: list[str] = ()) -> DataFrame:
    """Freshness roll-up, overall or per key."""
    now = F.lit(as_of).cast("timestamp")
    status, lag, n = F.col("health_status"), F.col("observation_lag_hours"), F.count(F.lit(1))
    reliable = F.count_if(F.col("is_reliable"))
    return health.groupBy(*by).agg(
        n.alias("source_ward_count"), reliable.alias("reliable_count"),
        F.round(ratio(reliable * 100.0, n), 1).alias("reliable_pct"), F.max("last_seen").alias("latest_reading_at"),
        times.hours_between(F.max("last_seen"), now).alias("latest_lag_hours"),
        F.max("last_ingested_at").alias("latest_ingested_at"),
        times.hours_between(F.max("last_ingested_at"), now).alias("latest_ingest_lag_hours"),
        F.round(avg_where(lag, status != "Offline"), 2).alias("active_avg_lag_hours"),
        F.round(F.avg(lag), 2).alias("all_avg_lag_hours"),
        *[F.count_if(status == s).alias(f"{s.lower()}_count") for s in ("Fresh", "Delayed", "Stale", "Offline")],
        F.count_if(status.isin("Stale", "Offline")).alias("attention_count"), F.max(lag).alias("worst_lag_hours"))


def status_distribution(health: DataFrame) -> DataFrame:
    return health.groupBy("source", "health_status").agg(
        F.count(F.lit(1)).alias("source_ward_count"), F.round(F.avg("observation_lag_hours"), 2).alias("avg_lag_hours"))


def risk_ranking(province_daily: DataFrame, population: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Provinces ranked by PM2.5 and by population exposure over the last days."""
    recent = province_daily.filter(F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), days))
    mean = recent.groupBy("province", "region_3", "region_8").agg(
        F.avg("pm25_avg").alias("_pm25"), F.round(F.avg("confidence_score"), 2).alias("confidence_score"),
        mode_of("confidence_level").alias("confidence_level"), mode_of("source_mix").alias("source_mix"))
    people = population.select(F.col("location_name").alias("province"), F.col("total_population").alias("population"))
    joined = mean.join(people, "province", "left").withColumns({
        "time_weighted_pm25": F.round("_pm25", 2),
        "_exposure": F.col("_pm25") * F.col("population") / 1_000_000.0})

    def category(metric, *steps):
        out = None
        for bound, label in zip(steps, ("CRITICAL", "HIGH RISK", "MODERATE")):
            out = F.when(metric > bound, label) if out is None else out.when(metric > bound, label)
        return out.otherwise("LOW")

    ranked = rank_desc(joined, pollution_rank="time_weighted_pm25", exposure_rank="_exposure")
    return ranked.withColumns({
        "total_exposure_index_m": F.col("_exposure").cast("float"),
        "risk_category": category(F.col("time_weighted_pm25"), 50, 25, 15),
        "exposure_risk_category": category(F.col("_exposure"), 200, 100, 25),
        "national_risk_rank": F.col("pollution_rank")}).drop("_pm25", "_exposure")
