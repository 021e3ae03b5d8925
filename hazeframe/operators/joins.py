"""Enrichment joins.

Dimension sides carry no broadcast hint: Spark broadcasts them by their
measured size (``spark.sql.autoBroadcastJoinThreshold``, and again at run time
under AQE) and shuffles otherwise, so a dimension may grow with the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeframe.functions import naming
from hazeframe.functions.aggregates import arg_max, ratio
from hazeframe.functions.predicates import present
from hazeframe.session import stored

ALL_LOCATIONS = "ALL"
DEFAULT_CALIBRATION = 0.8
#: Level of bands that are open at a side.
ENDLESS = 1_000_000
#: So many rows of one cell do not make a dealt level uneven; so many levels are tried.
DEALT_AT_LEAST, MOST_DEALS = 100_000, 8


def attach_station(measurements: DataFrame, stations: DataFrame, source: str,
                   columns: list[str] = ("ward_code", "province", "latitude", "longitude")) -> DataFrame:
    """Inner join on station name, restricted to one station network."""
    mine = stations.filter(F.col("station_source") == source).select("station_name", *columns)
    return measurements.join(mine, "station_name")


def calibrate(df: DataFrame, table: DataFrame) -> DataFrame:
    """Scale ``value`` by the local factor, else the global one, else the default.

    Keeps the input as ``raw_value`` and adds ``source_weight``.
    """
    factor = F.min("calibration_factor").alias  # one factor per key, fixed choice
    everywhere = (table.filter(F.col("location_scope") == ALL_LOCATIONS)
                  .groupBy("source", "parameter").agg(factor("_global")))
    local = (table.filter(F.col("location_scope") != ALL_LOCATIONS)
             .groupBy("source", "parameter", F.col("location_scope").alias("province")).agg(factor("_local")))
    k = F.coalesce("_local", "_global", F.lit(DEFAULT_CALIBRATION))
    return (df.join(everywhere, ["source", "parameter"], "left")
            .join(local, ["source", "parameter", "province"], "left")
            .withColumn("raw_value", F.col("value")).withColumn("value", F.col("value") * k)
            .withColumn("source_weight", F.when(F.col("source") == "aqiin", 5).otherwise(1))
            .drop("_global", "_local"))


def band_join(df: DataFrame, bands: DataFrame, key: str, value: str, band_key: str, lo: str, hi: str) -> DataFrame:
    """Left join to the band whose key matches and whose bounds hold the value.

    The equality keeps this a hash join; bounds are a residual filter.
    """
    hit = (F.col(key) == F.col(band_key)) & (F.col(value) >= F.col(lo)) & (F.col(value) <= F.col(hi))
    return df.join(bands, hit, "left").drop(band_key, lo, hi)


def band_join_cells(df: DataFrame, bands: DataFrame, key: str, value: str, band_key: str, lo: str, hi: str, coarseness: int = 3) -> DataFrame:
    """``band_join`` for many bands per key: bands and values meet in cells, not in one hot key.

    A band belongs to the level whose cells, a power of two wide, are no
    narrower than itself; it touches three cells there at most.  A value looks
    into its one cell of every level that occurs (levels are rounded up to
    multiples of ``coarseness``; doubles have some 2,100 exponents, so the list
    of levels is short).  Bounds remain as a residual filter.  Bands without
    bounds at a side (infinite or NaN) have a level of a single cell.  Rows carry
    their columns through the meeting, so pairs, which may be many more than both
    sides together, are not shuffled; rows without a band are added at the end.

    Rows are dealt once, by their cell of the coarsest level that deals rows and
    bands evenly, for all levels up to it: they look into finer cells where they
    are.  Coarser levels, and all where a few values are too frequent, are
    shuffled by their own cells, which Spark can split.
    """
    low, high = F.col(lo).cast("double"), F.col(hi).cast("double")
    width, top = high - low, F.greatest(F.abs(low), F.abs(high))
    endless = F.isnan(width) | (F.abs(width) == float("inf"))
    finest = F.when(top > 0, F.ceil(F.log2(top)) - 50).otherwise(-1000)  # cells stay whole numbers
    level = F.greatest(F.when(width > 0, F.ceil(F.log2(width))).otherwise(-1000), finest)
    level = F.when(~endless, (F.ceil(level / coarseness) * coarseness).cast("int"))
    sized = bands.filter((low <= high) & F.col(band_key).isNotNull()).withColumn("_level", level)

    def cell(x: Column, of: Column) -> Column:
        return F.coalesce(F.floor(x / F.pow(F.lit(2.0), of)), F.lit(0)).cast("long")
    first, last = cell(low, F.col("_level")), cell(high, F.col("_level"))
    placed = sized.withColumn("_cell", F.explode(F.sequence(first, last))).withColumn("_level", F.coalesce("_level", F.lit(ENDLESS)))
    levels = [r[0] for r in sized.select("_level").distinct().collect()]  # by exponent, not by row
    rows = stored(df.withColumn("_id", F.monotonically_increasing_id()), "band-join-rows")
    v = F.col(value).cast("double")
    if not levels:
        return rows.drop("_id").join(bands.limit(0).drop(band_key, lo, hi), F.lit(False), "left")
    valid = v.isNotNull() & F.col(key).isNotNull()
    carried = [f for f in bands.schema.fields if f.name not in (band_key, lo, hi)]
    known = rows.filter(valid).select(*df.columns, "_id", F.col(key).alias("_key"), v.alias("_value"))
    finite = sorted((x for x in levels if x is not None), reverse=True)
    tries = finite[:MOST_DEALS] if df.schema[key].dataType == bands.schema[band_key].dataType else []  # keys of other types may be equal and hash apart
    deal = next((x for x in tries if _even(known, ["_key", cell(F.col("_value"), F.lit(float(x)))]) and _even(sized, [band_key, cell(low, F.lit(float(x)))])), None)
    near = [x for x in finite if deal is not None and x <= deal]
    far = [x for x in levels if x not in near]
    within = (F.col("_value") >= F.col(lo)) & (F.col("_value") <= F.col(hi))

    def exploded(probes: DataFrame, at_levels: list, *more: str) -> DataFrame:
        looks = [F.struct(F.lit(ENDLESS if x is None else x).alias("_level"), (F.lit(0).cast("long") if x is None else cell(F.col("_value"), F.lit(float(x)))).alias("_cell")) for x in at_levels]
        return probes.select(*df.columns, "_id", "_key", "_value", *more, F.explode(F.array(*looks)).alias("_at")).select(*df.columns, "_id", "_key", "_value", *more, "_at.*")

    def pairs(probes: DataFrame, of: DataFrame, hit: Column) -> DataFrame:
        return probes.join(of, hit).select(*[probes[c] for c in df.columns], *[of[f.name] for f in carried])
    found, alone = [], known
    if near:
        spark = df.sparkSession
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")  # cells lie within what is dealt
        at = F.lit(float(deal))
        dealt = known.withColumn("_deal", F.xxhash64("_key", cell(F.col("_value"), at))).repartition("_deal")
        here = (sized.filter(F.col("_level") <= deal).withColumn("_band_deal", F.explode(F.sequence(cell(low, at), cell(high, at))))
                .withColumn("_band_deal", F.xxhash64(band_key, "_band_deal")).repartition("_band_deal").withColumn("_band_cell", F.explode(F.sequence(first, last))).withColumnRenamed("_level", "_band_level"))
        same = (F.col("_key") == F.col(band_key)) & (F.col("_deal") == F.col("_band_deal")) & (F.col("_cell") == F.col("_band_cell")) & within
        found.append(pairs(exploded(dealt, near, "_deal"), here, same & (F.col("_level") == F.col("_band_level"))))
        alone = dealt
        for x in near:
            alone = alone.withColumn("_cell", cell(F.col("_value"), F.lit(float(x)))).join(here.filter(F.col("_band_level") == x), same, "left_anti").drop("_cell")
    if far:
        placed = placed.filter(F.col("_level").isin([ENDLESS if x is None else x for x in far])).withColumnsRenamed({"_level": "_band_level", "_cell": "_band_cell"})
        hit = (F.col("_key") == F.col(band_key)) & (F.col("_level") == F.col("_band_level")) & (F.col("_cell") == F.col("_band_cell")) & within
        found.append(pairs(exploded(known, far), placed, hit))
        met = exploded(known, far).select("_id", "_key", "_value", "_level", "_cell").join(placed, hit, "left_semi").select("_id").distinct()
        alone = alone.join(met, "_id", "left_anti")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in carried]
    parts = [*found, alone.select(*df.columns, *nothing), rows.filter(~valid).select(*df.columns, *nothing)]
    together = DataFrame.unionByName if len(set(parts[0].columns)) == len(parts[0].columns) else DataFrame.union
    return reduce(together, parts)


def _even(df: DataFrame, by: list) -> bool:
    """Whether no group has more rows than ``DEALT_AT_LEAST`` or twice the share of a task."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    largest, total = df.groupBy(*by).count().agg(F.max("count"), F.sum("count")).first()
    return largest is None or largest <= max(DEALT_AT_LEAST, 2 * total / tasks)


def overview(fact: DataFrame, dim: DataFrame, grain: str) -> DataFrame:
    """Ward facts with names and geography; wards lacking either are dropped."""
    geography = dim.filter(present("ward_code", "province", "ward_name")).select(
        "ward_code", "ward_name", "province", "region_3", "region_8", "latitude", "longitude", "population")
    fact = fact.filter(present("ward_code")).drop("province", "region_3", "region_8")
    if grain == "hour":
        fact = fact.withColumns({"max_aqi_us": F.col("avg_aqi_us"), "max_aqi_vn": F.col("avg_aqi_vn")})
    if grain == "month":
        fact = fact.withColumn("date", F.col("month"))
    times = {"hour": ["datetime_hour", "date"], "day": ["date"], "month": ["date", "month"]}[grain]
    tail = ["samples_count"] if grain == "month" else []
    return fact.join(geography, "ward_code").select(
        *times, "province", "ward_code", "ward_name", "region_3", "region_8", "latitude", "longitude", "population",
        "avg_aqi_us", "max_aqi_us", "avg_aqi_vn", "max_aqi_vn", "main_pollutant",
        "pm25_avg", "pm10_avg", "co_avg", "no2_avg", "so2_avg", "o3_avg",
        "aqiin_observation_count", "openweather_observation_count", "source_mix", "confidence_score",
        "confidence_level", *tail, "last_ingested_at")


def compare_sources(ward_daily: DataFrame) -> DataFrame:
    """Station versus model per day and province: bias, error, agreement, coverage."""
    def side(mix, p):
        return (ward_daily.filter(F.col("source_mix") == mix).groupBy("date", "province")
                .agg(F.avg("avg_aqi_vn").alias(f"{p}_aqi"), F.avg("pm25_avg").alias(f"{p}_pm25"),
                     F.count("ward_code").alias(f"{p}_wards")))
    a, o = F.col("aqiin_aqi"), F.col("ow_aqi")
    return side("observed", "aqiin").join(side("modeled", "ow"), ["date", "province"], "full").withColumns({
        "aqi_bias": a - o,
        "aqi_mae": F.abs(a - o),
        "aqi_pct_diff": ratio(a - o, o) * 100,
        "category_agreement": F.when((a > 150) & (o > 150), "both_unhealthy")
                               .when((a <= 50) & (o <= 50), "both_good")
                               .when(a.isNull() | o.isNull(), "one_source_only").otherwise("disagree"),
        "has_ground_data": F.col("aqiin_wards") > 0,
        "ground_coverage_pct": ratio(F.col("aqiin_wards") * 100.0, "ow_wards"),
    })


def coverage(dim: DataFrame, observed_hourly: DataFrame, modelled_hourly: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Active wards per source and province over the last days.

    Each side is reduced to one row per province before the join, so wards are
    never multiplied by wards.
    """
    since = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")

    def active(df, p):
        wards = df.filter(F.col("datetime_hour") >= since).groupBy("province", "ward_code").agg(F.max("datetime_hour").alias("h"))
        return wards.groupBy("province").agg(F.count("ward_code").alias(f"{p}_ward_count"), F.max("h").alias(f"{p}_latest_hour"))

    totals = dim.filter(present("province")).groupBy("province").agg(F.count_distinct("ward_code").alias("total_ward_count"))
    out = totals.join(active(observed_hourly, "aqiin"), "province", "left").join(active(modelled_hourly, "ow"), "province", "left")
    zero = F.lit(0).cast("bigint")
    return (out.withColumns({"aqiin_ward_count": F.coalesce("aqiin_ward_count", zero),
                             "ow_ward_count": F.coalesce("ow_ward_count", zero)})
            .withColumn("aqiin_coverage_pct", ratio(F.col("aqiin_ward_count") * 100.0, "total_ward_count")))


def group_gap(df: DataFrame, key: str, first, second, metric: str) -> DataFrame:
    """Maxima of two groups and their difference, as one conditional aggregate.

    Like joining two one-row sets: no row when either group is absent.
    """
    a = F.max(F.when(F.col(key) == first, F.col(metric)))
    b = F.max(F.when(F.col(key) == second, F.col(metric)))
    return (df.filter(F.col(key).isin(first, second))
            .agg(a.alias("max_1"), b.alias("max_2"), F.count_distinct(key).alias("_n")).filter(F.col("_n") == 2)
            .select(F.lit(first).alias("group_1"), "max_1", F.lit(second).alias("group_2"), "max_2",
                    (F.col("max_1") - F.col("max_2")).alias("difference")))


def latest_only(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Rows of the latest date present (semi join on the one-row maximum)."""
    return df.join(df.agg(F.max(date_col).alias(date_col)), date_col, "left_semi")


def side_by_side(a: DataFrame, b: DataFrame, keys: list[str], suffixes=("_ground", "_sat")) -> DataFrame:
    """Inner join of two series; measure columns get suffixes."""
    def renamed(df, suffix):
        return df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in keys})
    return renamed(a, suffixes[0]).join(renamed(b, suffixes[1]), keys)


def unify_env(aqi: DataFrame, dim: DataFrame, weather: DataFrame, traffic: DataFrame, pop: DataFrame, ward: str = "ward_code") -> DataFrame:
    """Ward-hour air quality with weather (ward, else province), traffic and exposure.

    ``ward`` names what weather belongs to: the ward, or the place that ``aqi`` gives for it.
    """
    placed = [c for c in (ward,) if c != "ward_code"]
    names = {"date": "date", "region_3": "region_3", "region_8": "region_8", "avg_aqi_us": "aqi_us", "avg_aqi_vn": "aqi_vn", "pm25_avg": "pm25",
             "pm10_avg": "pm10", "co_avg": "co", "main_pollutant": "main_pollutant", "source_mix": "source_mix",
             "confidence_score": "confidence_score", "confidence_level": "confidence_level"}
    # a ward-hour has one row per mix, two at most: the newer one, filled up from the other, is each column's newest value
    row = F.when(F.col("last_ingested_at").isNotNull(), F.struct(
        F.col("last_ingested_at").alias("_v"), F.col("source_mix").alias("_m"), *[F.col(src).alias(dst) for src, dst in names.items()]))
    base = aqi.groupBy("datetime_hour", "province", "ward_code").agg(
        F.max(row).alias("_new"), F.min(row).alias("_old"),
        F.sum("aqiin_observation_count").alias("aqiin_observation_count"),
        F.sum("openweather_observation_count").alias("openweather_observation_count"),
        F.max(F.struct("raw_loaded_at", "raw_sync_run_id", "raw_sync_started_at")).alias("_a"),
        *[F.max(c).alias(c) for c in placed])
    base = base.withColumns({c: F.coalesce(f"_new.{c}", f"_old.{c}") for c in names.values()}).drop("_new", "_old")
    w = weather.select(
        "province", ward, "datetime_hour",
        *[F.coalesce(c, f"province_{c}").cast("double").alias(c)
          for c in ("temperature", "humidity", "wind_speed", "wind_direction", "pressure")],
        F.struct("raw_loaded_at", "raw_sync_run_id", "raw_sync_started_at").alias("_w"))
    t = traffic.select("ward_code", "datetime_hour", F.col("congestion_index").cast("double").alias("congestion_index"),
                       "traffic_data_type",
                       F.struct("raw_loaded_at", "raw_sync_run_id", "raw_sync_started_at").alias("_t"))
    p = pop.select(F.col("location_name").alias("province"),
                   F.col("total_population").cast("bigint").alias("provincial_population"))
    g = dim.select("ward_code", "latitude", "longitude")
    out = (base.join(w, ["datetime_hour", ward, "province"], "left").drop(*placed)
           .join(t, ["datetime_hour", "ward_code"], "left")
           .join(g, "ward_code", "left").join(p, "province", "left"))
    epoch = F.lit(0).cast("timestamp")
    pm25, congestion = F.col("pm25"), F.col("congestion_index")
    stagnant = F.coalesce(F.col("wind_speed") < 1.0, F.lit(False))
    return out.withColumns({
        "is_high_humidity_suppression": F.when(F.col("humidity") > 80, 1).otherwise(0),
        "is_stagnant_air_risk": stagnant.cast("int"),
        "stagnant_air_probability": stagnant.cast("float"),
        "weather_influence_pct": F.lit(0.0).cast("float"),
        "population_exposure_score": (pm25 * F.col("provincial_population") / 1_000_000.0).cast("float"),
        "traffic_pollution_impact_score": (pm25 * congestion).cast("float"),
        "traffic_contribution_pct": F.lit(0.0).cast("float"),
        "traffic_pollution_ratio": F.when(congestion > 0, pm25 / congestion).otherwise(0.0).cast("float"),
        "raw_loaded_at": F.greatest(*[F.coalesce(f"{s}.raw_loaded_at", epoch) for s in ("_a", "_w", "_t")]),
        "raw_sync_run_id": F.coalesce("_t.raw_sync_run_id", "_w.raw_sync_run_id", "_a.raw_sync_run_id", F.lit("")),
        "raw_sync_started_at": F.greatest(*[F.coalesce(f"{s}.raw_sync_started_at", epoch) for s in ("_a", "_w", "_t")]),
    }).drop("_a", "_w", "_t")


def administrative_dim(wards: DataFrame) -> DataFrame:
    return wards.withColumns({"region_3": naming.region_3("province"), "region_8": naming.region_8("province")})
