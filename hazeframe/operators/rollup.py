"""Hourly pivot and time / area roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions import naming, times
from hazeframe.functions.aggregates import avg_where, count_distinct_where, arg_max, mode_of, newest_lineage
from hazeframe.functions.aqi import main_pollutant

CONC = [f"{p}_avg" for p in fv.POLLUTANTS]
SUB = [f"{p}_aqi" for p in fv.POLLUTANTS]
#: Score and level of each source mix.
CONFIDENCE = {"observed": (1.0, "high"), "modeled": (0.5, "medium")}


def _main() -> Column:
    return main_pollutant({p: f"{p}_aqi" for p in fv.POLLUTANTS})


def _regions() -> dict[str, Column]:
    return {"region_3": naming.region_3("province"), "region_8": naming.region_8("province")}


def _described(df: DataFrame) -> DataFrame:
    """What province and mix determine, added after grouping so that the keys stay narrow."""
    score, level = F.lit(None).cast("double"), F.lit(None).cast("string")
    for mix, (s, name) in CONFIDENCE.items():
        hit = F.col("source_mix") == mix
        score, level = F.when(hit, s).otherwise(score), F.when(hit, name).otherwise(level)
    return df.withColumns({**_regions(), "confidence_score": score, "confidence_level": level})


def _with_lineage(df: DataFrame) -> DataFrame:
    return df.select("*", "_lineage.*").drop("_lineage")


def to_hourly(df: DataFrame) -> DataFrame:
    """Narrow measurements -> one wide row per ward and hour.

    ``avg_aqi_*`` is the highest sub-index seen in the hour (the established
    column name notwithstanding).  Rows that carry their ``date`` may have been
    dealt by it and the ward; they are not shuffled again then.
    """
    aggs = [F.max("aqi_vn").alias("avg_aqi_vn"), F.max("aqi_us").alias("avg_aqi_us")]
    for p in fv.POLLUTANTS:
        aggs.append(avg_where("value", F.col("parameter") == p).alias(f"{p}_avg"))
        aggs.append(avg_where("aqi_vn", F.col("parameter") == p).alias(f"{p}_aqi"))
    if "date" not in df.columns:
        df = df.withColumn("date", F.to_date("timestamp_utc"))
    hourly = (df.filter(F.col("parameter").isin(fv.POLLUTANTS))
              .groupBy("ward_code", "date", times.hour_of("timestamp_utc").alias("datetime_hour"), "province")
              .agg(*aggs, F.count(F.lit(1)).alias("observation_count"),
                   F.max("ingest_time").alias("last_ingested_at"), newest_lineage().alias("_lineage")))
    keys = ["datetime_hour", "ward_code", "province"]
    rest = [c for c in hourly.columns if c not in (*keys, "date", "_lineage")]
    return (hourly.select(*keys, *rest, "_lineage.*", "date")
            .withColumns({**_regions(), "main_pollutant": _main()}))


def pivot_mean(df: DataFrame, keys: list, name: str, value: str, names: list[str]) -> DataFrame:
    """Generic narrow -> wide pivot by conditional mean (one pass, no distinct scan)."""
    return df.groupBy(*keys).agg(
        *[avg_where(value, F.col(name) == n).alias(f"{n}_avg") for n in names],
        F.max(value).alias("max_value"), F.count(F.lit(1)).alias("observation_count"))


def ward_hourly(observed: DataFrame, modelled: DataFrame) -> DataFrame:
    """Station and model hours side by side, tagged with mix and confidence."""
    def tagged(df, mix):
        score, level = CONFIDENCE[mix]
        n, zero = F.col("observation_count"), F.lit(0).cast("bigint")
        return df.withColumns({
            "aqiin_observation_count": n if mix == "observed" else zero,
            "openweather_observation_count": zero if mix == "observed" else n,
            "source_mix": F.lit(mix), "confidence_score": F.lit(score), "confidence_level": F.lit(level),
        }).drop("observation_count")
    return tagged(observed, "observed").unionByName(tagged(modelled, "modeled"))


def _measures(max_us: str, max_vn: str, min_us: str, min_vn: str) -> list[Column]:
    return [
        F.avg("avg_aqi_us").alias("avg_aqi_us"), F.max(max_us).alias("max_aqi_us"), F.min(min_us).alias("min_aqi_us"),
        F.avg("avg_aqi_vn").alias("avg_aqi_vn"), F.max(max_vn).alias("max_aqi_vn"), F.min(min_vn).alias("min_aqi_vn"),
        *[F.avg(c).alias(c) for c in CONC + SUB],
        F.max("last_ingested_at").alias("last_ingested_at"), newest_lineage().alias("_lineage"),
    ]


_COUNTS = ["aqiin_observation_count", "openweather_observation_count"]


def rollup_daily(hourly: DataFrame) -> DataFrame:
    """Ward hours -> ward days."""
    daily = hourly.groupBy("date", "province", "ward_code", "source_mix").agg(
        *_measures("avg_aqi_us", "avg_aqi_vn", "avg_aqi_us", "avg_aqi_vn"),
        *[F.sum(c).alias(c) for c in _COUNTS])
    return _described(_with_lineage(daily)).withColumn("main_pollutant", _main())


def rollup_monthly(daily: DataFrame) -> DataFrame:
    """Ward days -> ward months, with the number of days."""
    monthly = daily.groupBy(times.month_of("date").alias("month"), "province", "ward_code", "source_mix").agg(
        *_measures("max_aqi_us", "max_aqi_vn", "min_aqi_us", "min_aqi_vn"),
        *[F.sum(c).alias(c) for c in _COUNTS], F.count(F.lit(1)).alias("samples_count"))
    return _described(_with_lineage(monthly)).withColumn("main_pollutant", _main())


GRAIN_KEYS = {"hour": ["datetime_hour", "date"], "day": ["date"], "month": ["month"]}


def rollup_province(df: DataFrame, grain: str) -> DataFrame:
    """Ward rows of a grain -> province rows, counts split by source mix.

    A ward occurs once per time key and mix, so counting rows counts wards; the
    exact-distinct expansion is not needed.
    """
    measures = _measures("max_aqi_us", "max_aqi_vn", "min_aqi_us", "min_aqi_vn")
    if grain == "hour":
        measures = [F.avg("avg_aqi_us").alias("avg_aqi_us"), F.avg("avg_aqi_vn").alias("avg_aqi_vn")] + measures[6:]
    out = df.groupBy(*GRAIN_KEYS[grain], "province", "source_mix").agg(
        *measures, F.count("ward_code").alias("total_ward_count"),
        F.sum(F.col(_COUNTS[0]) + F.col(_COUNTS[1])).alias("_obs"))
    zero = F.lit(0).cast("bigint")
    cols = {"main_pollutant": _main()}
    for mix, source in (("observed", "aqiin"), ("modeled", "openweather")):
        hit = F.col("source_mix") == mix
        cols[f"{source}_ward_count"] = F.when(hit, F.col("total_ward_count")).otherwise(zero)
        cols[f"{source}_observation_count"] = F.when(hit, F.col("_obs")).otherwise(zero)
    return _described(_with_lineage(out)).withColumns(cols).drop("_obs")


def national_summary(province_hourly: DataFrame, province_daily: DataFrame) -> DataFrame:
    """Hourly and daily national series in one table."""
    def one(df, grain, ts, max_us, max_vn):
        return df.groupBy(F.lit(grain).alias("time_grain"), ts.alias("timestamp")).agg(
            F.avg("avg_aqi_us").alias("avg_aqi_us"), F.max(max_us).alias("max_aqi_us"),
            F.avg("avg_aqi_vn").alias("avg_aqi_vn"), F.max(max_vn).alias("max_aqi_vn"),
            count_distinct_where("province", F.col("avg_aqi_us").isNotNull()).alias("active_provinces_us"),
            count_distinct_where("province", F.col("avg_aqi_vn").isNotNull()).alias("active_provinces_vn"),
            F.lit(0).alias("active_wards"),
            arg_max("main_pollutant", "avg_aqi_us", "province", "source_mix").alias("dominant_pollutant_us"),
            arg_max("main_pollutant", "avg_aqi_vn", "province", "source_mix").alias("dominant_pollutant_vn"),
            F.avg("confidence_score").alias("confidence_score"),
            mode_of("source_mix").alias("dominant_source_mix"),
            F.max("last_ingested_at").alias("last_ingested_at"))
    return (one(province_hourly, "hourly", F.col("datetime_hour"), "avg_aqi_us", "avg_aqi_vn")
            .unionByName(one(province_daily, "daily", F.col("date").cast("timestamp"), "max_aqi_us", "max_aqi_vn")))


def population(wards: DataFrame) -> DataFrame:
    """Population, area and density per province; density 0 without area."""
    people, area = F.sum("population"), F.sum("area_km2")
    return wards.groupBy(F.col("province").alias("location_name")).agg(
        people.alias("total_population"), area.alias("area_km2"),
        F.when(area > 0, people / area).otherwise(0.0).alias("density_per_km2"))


def source_summary(df: DataFrame, grain: str) -> DataFrame:
    """Wide ward facts -> the per-source summary layout of a grain."""
    lineage = [F.col("last_ingested_at").alias("ingest_time"), "raw_loaded_at", "raw_sync_run_id", "raw_sync_started_at"]
    names = {"day": "daily", "month": "monthly"}
    src = naming.source_of_mix("source_mix").alias("source")
    if grain == "month":
        n = names[grain]
        return df.select(
            "month", "province", "ward_code", "region_3", "region_8", src,
            F.col("avg_aqi_us").alias(f"{n}_avg_aqi_us"), F.col("avg_aqi_vn").alias(f"{n}_avg_aqi_vn"),
            F.col("max_aqi_us").alias(f"{n}_max_aqi_us"), F.col("min_aqi_us").alias(f"{n}_min_aqi_us"),
            *[F.col(f"{p}_avg").alias(f"{p}_{n}_avg") for p in fv.POLLUTANTS],
            F.col("main_pollutant").alias("dominant_pollutant_vn"), *lineage)
    n = names[grain]
    return df.select(
        "date", "province", "ward_code", "region_3", "region_8", src,
        F.col("avg_aqi_us").alias(f"{n}_avg_aqi_us"), F.col("avg_aqi_vn").alias(f"{n}_avg_aqi_vn"),
        F.col("max_aqi_us").alias(f"{n}_max_aqi_us"), F.col("max_aqi_vn").alias(f"{n}_max_aqi_vn"),
        *[F.col(f"{p}_avg").alias(f"{p}_{n}_avg") for p in fv.POLLUTANTS],
        *[F.col(f"{p}_aqi").alias(f"{p}_{n}_aqi") for p in fv.POLLUTANTS],
        F.col("pm25_avg").alias("pm25_daily_max"), F.col("pm10_avg").alias("pm10_daily_max"),
        F.col("main_pollutant").alias("dominant_pollutant_us"), F.col("main_pollutant").alias("dominant_pollutant_vn"),
        F.when(F.col("source_mix") == "observed", F.col("aqiin_observation_count"))
        .otherwise(F.col("openweather_observation_count")).alias("hourly_count"),
        *lineage)


def hourly_summary(sources: dict[str, tuple[DataFrame, float]]) -> DataFrame:
    """Ward hours of several sources stacked with source name and weight."""
    out = None
    for name, (df, weight) in sources.items():
        part = df.select(
            "datetime_hour", "date", "province", "ward_code", "region_3", "region_8",
            F.lit(name).alias("source"), F.lit(weight).alias("source_weight"),
            F.col("avg_aqi_us").alias("final_aqi_us"), F.col("avg_aqi_vn").alias("final_aqi_vn"),
            *[F.col(f"{p}_avg").alias(f"{p}_value") for p in fv.POLLUTANTS], *SUB,
            F.col("main_pollutant").alias("dominant_pollutant_us"),
            F.col("main_pollutant").alias("dominant_pollutant_vn"),
            F.col("last_ingested_at").alias("ingest_time"), "raw_loaded_at", "raw_sync_run_id", "raw_sync_started_at")
        out = part if out is None else out.unionByName(part)
    return out


def rollup(df: DataFrame, keys: list, value: str, extra: list[Column] = ()) -> DataFrame:
    """Generic average / maximum / minimum / count roll-up."""
    return df.groupBy(*keys).agg(
        F.avg(value).alias("avg_value"), F.max(value).alias("max_value"), F.min(value).alias("min_value"),
        F.count(F.lit(1)).alias("samples"), *extra)
