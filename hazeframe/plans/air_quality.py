"""The model graph: raw tables -> staged -> processed -> facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions import aqi, geo, naming, times, traffic, units
from hazeframe.functions.aggregates import arg_max, newest_lineage
from hazeframe.operators import dedup, joins, rollup, spatial
from hazeframe.session import stored

STATION_COLUMNS = ["value", "unit", "aqi_reported", "quality_flag", "ingest_time", "raw_sync_run_id", "raw_sync_started_at"]
TIE = ["raw_sync_run_id"]
MODELLED_COLUMNS = ["ward_name", "province_name", "latitude", "longitude", "value", "aqi_reported", "ingest_time",
                    "raw_sync_run_id", "raw_sync_started_at"]
#: What hourly rows are made of.
HOURLY_COLUMNS = ["value", "ingest_time", "raw_sync_run_id", "raw_sync_started_at"]
#: Where hourly rows come from, null in models without lineage.
ORIGIN = {"ingest_time": "timestamp", "raw_loaded_at": "timestamp", "raw_sync_run_id": "string", "raw_sync_started_at": "timestamp"}


def _dated(raw: DataFrame) -> DataFrame:
    return raw.withColumn("date", F.to_date("timestamp_utc"))


def stage_station(raw: DataFrame, source: str, columns: list[str] = STATION_COLUMNS) -> DataFrame:
    """Latest values per station, time, parameter, in ug/m3."""
    latest = dedup.latest_by_key(_dated(raw), ["station_name", "date", "timestamp_utc", "parameter"], "raw_loaded_at",
                                 columns, TIE, sparse=["value"], near=["station_name", "date"]).drop("date")
    return latest.withColumns({
        "value": units.to_ugm3("parameter", "value", "unit"),
        "unit": F.lit(fv.UNIT_UGM3), "source": F.lit(source)})


def stage_modelled(raw: DataFrame, columns: list[str] = MODELLED_COLUMNS) -> DataFrame:
    """Latest modelled values per ward, time, parameter; rows carry their date, by which and the ward they are dealt."""
    latest = dedup.latest_by_key(_dated(raw), ["ward_code", "date", "timestamp_utc", "parameter"], "raw_loaded_at",
                                 columns, TIE, sparse=["value"], near=["ward_code", "date"])
    return (latest.withColumnRenamed("province_name", "province")
            .withColumns({"source": F.lit("openweather"), "quality_flag": F.lit("valid")}))


def observed_for_hours(raw: dict[str, DataFrame], stations: DataFrame, decimals: int = 4, lineage: bool = True) -> DataFrame:
    """``dedup.fuse_observed`` of both networks with the rows and columns that hourly rows are made of, dealt by ward and date.

    Only raw readings are dealt by date and station as they are.  The latest
    ones of a station and time are packed into one row before they meet their
    station, so the fusion by position and the deal by ward and date move a row
    per time instead of one per pollutant, and none moves a raw reading again,
    however many stations there are.  The stations of a network are stored as
    far as they are needed, so that Spark knows their size: where they can be
    broadcast, nothing is shuffled to find them.  Indices, which follow from the
    value, come after the fusion.  Without ``lineage`` its columns are not moved
    and null.
    """
    def rounded(c):
        return F.coalesce((F.round(c, decimals) + F.lit(0.0)).cast("string"), F.lit("none"))
    located = stations.withColumn("position", F.concat(rounded("latitude"), F.lit(" "), rounded("longitude")))
    at = ["date", "station_name", "timestamp_utc"]
    columns = HOURLY_COLUMNS if lineage else ["value"]
    both = None
    for priority, source in enumerate(("aqiin", "waqi"), 1):
        rows = _dated(raw[source]).filter(F.col("parameter").isin(fv.POLLUTANTS))
        latest = dedup.latest_by_key(rows, [*at, "parameter"], "raw_loaded_at", ["unit", *columns], TIE, sparse=["value"], near=at[:2])
        staged = latest.withColumns({"value": units.to_ugm3("parameter", "value", "unit"), "version": dedup.rank_version(F.lit(priority))})
        packed = dedup.pack(staged, at, "parameter", fv.POLLUTANTS, ["version", *columns, *(["raw_loaded_at"] if lineage else [])])
        mine = stored(located.filter(F.col("station_source") == source).select(
            "station_name", "station_source", "ward_code", "province", "position"), f"stations-{source}")
        placed = joins.attach_station(packed, mine, source, ["ward_code", "province", "position"])
        both = placed if both is None else both.unionByName(placed)
    fused = dedup.fuse_packed(both.repartition("position", "date"), ["position", "date", "timestamp_utc"], fv.POLLUTANTS, "version",
                              ["station_name", "ward_code", "province"])
    dealt = fused.drop("position").repartition("ward_code", "date")
    return with_indices(_with_origin(dedup.unpack(dealt, "parameter", fv.POLLUTANTS)))


def observed_by_position(staged: dict[str, DataFrame], stations: DataFrame) -> DataFrame:
    """``dedup.fuse_observed`` of whole processed rows.

    Each network meets its stations in a step of its own, which leaves no shuffle
    files.  What follows from a reading (unit, indices, regions) is added after
    the fusion instead of being moved.
    """
    placed = [stored(joins.attach_station(staged[s].drop("unit"), stations, s), f"placed-{s}") for s in ("aqiin", "waqi")]
    fused = dedup.fuse_observed(*placed, dealt=True)
    return with_indices(fused.withColumn("unit", F.lit(fv.UNIT_UGM3)))


def _with_origin(df: DataFrame) -> DataFrame:
    """``df`` with null for what it does not carry of its origin."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in ORIGIN.items() if c not in df.columns})


def with_indices(df: DataFrame) -> DataFrame:
    """Add US-unit value, both sub-indices and regions."""
    return df.withColumn("value_us_standard", units.to_us_units("parameter", "value")).withColumns({
        "aqi_vn": aqi.vn_aqi("parameter", "value"),
        "aqi_us": aqi.us_aqi("parameter", "value_us_standard"),
        "region_3": naming.region_3("province"), "region_8": naming.region_8("province")})


def process_station(staged: DataFrame, stations: DataFrame, source: str) -> DataFrame:
    return with_indices(joins.attach_station(staged, stations, source))


def process_modelled(staged: DataFrame) -> DataFrame:
    return with_indices(staged)


def measurements_unified(staged: dict[str, DataFrame], stations: DataFrame, wards: DataFrame,
                         calibration: DataFrame) -> DataFrame:
    """All sources stacked, near-station modelled rows dropped, values calibrated."""
    columns = ["source", "ward_code", "province", "latitude", "longitude", "timestamp_utc", "parameter", "value",
               "aqi_reported", "quality_flag", "ingest_time", "raw_loaded_at", "raw_sync_run_id", "raw_sync_started_at"]
    stacked = None
    for source, df in staged.items():
        part = (df if source == "openweather" else joins.attach_station(df, stations, source)).select(*columns)
        stacked = part if stacked is None else stacked.unionByName(part)
    kept = spatial.suppress_near(stacked, spatial.station_flags(stations, wards))
    return joins.calibrate(kept, calibration).withColumns({
        "region_3": naming.region_3("province"), "region_8": naming.region_8("province")})


def aqi_calculations(unified: DataFrame) -> DataFrame:
    """Sub-indices of the unified pollutant rows."""
    null = F.lit(None).cast("double")
    return with_indices(unified.filter(F.col("parameter").isin(fv.POLLUTANTS))).withColumns({
        "max_aqi_us_in_hour": null, "max_aqi_vn_in_hour": null,
        "is_dominant_us": F.lit(False), "is_dominant_vn": F.lit(False)})


def other_measurements(unified: DataFrame) -> DataFrame:
    """Rows of every parameter that has no index."""
    return (unified.filter(~F.col("parameter").isin(fv.POLLUTANTS))
            .withColumn("date", F.to_date("timestamp_utc")).withColumnRenamed("timestamp_utc", "datetime_hour"))


# --- weather --------------------------------------------------------------------

WEATHER = {"temp": "temperature", "humidity": "humidity", "wind_speed": "wind_speed",
           "wind_deg": "wind_direction", "pressure": "pressure"}


def stage_weather(raw: DataFrame, wards: DataFrame) -> DataFrame:
    """Cell weather fanned out to wards, by hour."""
    hourly = (raw.withColumn("timestamp_utc", times.hour_of("timestamp_utc"))
              .withColumnsRenamed({"province_name": "province", "visibility": "visibility_meters"}))
    return spatial.grid_join(hourly, _weather_units(wards)).drop("weather_cluster", "cluster_lat", "cluster_lon")


def _weather_units(wards: DataFrame) -> DataFrame:
    return wards.filter(F.coalesce("ward_code", F.lit("")) != "").select(
        "ward_code", "ward_name", "province", "latitude", "longitude")


def weather_places(wards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``place, weather_cluster, province, n`` and ``ward_code, place``: wards that lie in the same cells share a place.

    A place is named after its first ward; ``n`` counts its wards.  A ward has one
    place, also where its code occurs with several positions or provinces.
    """
    cell = F.struct(F.col("province"), geo.grid_key("latitude", "longitude").alias("weather_cluster"))
    located = F.when(F.col("province").isNotNull() & geo.grid_key("latitude", "longitude").isNotNull(), cell)
    cells = _weather_units(wards).groupBy("ward_code").agg(F.array_sort(F.collect_set(located)).alias("cells")).filter(F.size("cells") > 0)
    places = cells.groupBy("cells").agg(F.min("ward_code").alias("place"), F.count(F.lit(1)).alias("n"))
    return (places.select("place", "n", F.explode("cells").alias("c")).select("place", "c.*", "n"),
            cells.join(places, "cells").select("ward_code", "place"))


def weather_place_hourly(raw: DataFrame, cells: DataFrame) -> DataFrame:
    """One row per place, province and hour with province averages as fallback.

    Readings are dealt by cell and reduced to its newest before they meet the
    places, which needs no other deal; the province mean weighs a place by its wards, so nothing here grows with the
    product of readings and wards.
    """
    newest = {src: F.max(F.when(F.col(src).isNotNull() & F.col("ingest_time").isNotNull(),
                                F.struct("ingest_time", "raw_sync_run_id", F.col(src).cast("double").alias("v")))).alias(dst)
              for src, dst in WEATHER.items()}
    cell = (raw.withColumn("timestamp_utc", times.hour_of("timestamp_utc")).withColumnRenamed("province_name", "province")
            .repartition("weather_cluster", "province").groupBy("weather_cluster", "province", "timestamp_utc").agg(*newest.values(), newest_lineage().alias("_lineage")))
    here = cell.join(cells.drop("n"), ["weather_cluster", "province"])
    place = here.groupBy("place", "province", "timestamp_utc").agg(
        *[F.max(c).alias(c) for c in WEATHER.values()], F.max("_lineage").alias("_lineage"))
    place = place.withColumns({c: F.col(f"{c}.v") for c in WEATHER.values()})
    weighed = place.join(cells.select("place", "province", "n").distinct(), ["place", "province"])
    province = weighed.groupBy("province", "timestamp_utc").agg(
        *[(F.sum(F.col(c) * F.col("n")) / F.sum(F.when(F.col(c).isNotNull(), F.col("n")))).alias(f"province_{c}") for c in WEATHER.values()])
    stagnant = F.coalesce(F.coalesce("wind_speed", "province_wind_speed") < 1.0, F.lit(False))
    return (place.join(province, ["province", "timestamp_utc"])
            .withColumnRenamed("timestamp_utc", "datetime_hour").select("*", "_lineage.*").drop("_lineage")
            .withColumns({
                "date": F.to_date("datetime_hour"),
                "is_high_humidity_suppression": F.when(F.coalesce("humidity", "province_humidity") > 80, 1).otherwise(0),
                "is_stagnant_air_risk": stagnant.cast("int"),
                "stagnant_air_probability": stagnant.cast("float")}))


def weather_ward_hourly(raw: DataFrame, wards: DataFrame) -> DataFrame:
    """One row per ward-hour: the hours of places fanned out to their wards at the end, without a shuffle of ward rows."""
    cells, members = weather_places(wards)
    hours = weather_place_hourly(raw, cells).join(members, "place").drop("place")
    return hours.select("province", "datetime_hour", "ward_code", *[c for c in hours.columns if c not in ("province", "datetime_hour", "ward_code")])


def weather_of(rows: DataFrame, raw: DataFrame, wards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the place of their ward, and the weather of places: what ward rows join instead of the weather of all wards."""
    cells, members = weather_places(wards)
    return rows.join(members, "ward_code", "left"), weather_place_hourly(raw, cells)


def partition_mean(df: DataFrame, keys: list[str], columns: list[str], prefix: str = "province_") -> DataFrame:
    """Averages of the row's group beside every row, combined before the shuffle; null keys form groups.

    The averages are stored, so their size is known and rows are shuffled only where there are too many to broadcast.
    """
    means = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(*[F.avg(c).alias(f"{prefix}{c}") for c in columns])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return df.join(stored(means, "partition-means"), same).drop(*[f"_{k}" for k in keys])


# --- traffic -----------------------------------------------------------------------

def stage_traffic(raw: DataFrame) -> DataFrame:
    """Latest congestion ratio per ward, hour and source."""
    rated = raw.select(
        "source", naming.padded_code("ward_code").alias("ward_code"), "ward_name", "province_name", "latitude",
        "longitude", times.hour_of("timestamp_utc").alias("timestamp_utc"),
        traffic.congestion_ratio("current_travel_time", "free_flow_travel_time", "current_speed",
                                 "free_flow_speed").alias("value"),
        F.lit("congestion_ratio").alias("parameter"), "traffic_source", F.col("confidence").alias("quality_flag"),
        "ingest_time", "raw_loaded_at", "raw_sync_run_id", "raw_sync_started_at")
    return dedup.final(rated, ["ward_code", "timestamp_utc", "source"], "raw_loaded_at", TIE)


def traffic_pattern(staged: DataFrame) -> DataFrame:
    """Enrichment view kept for its consumers."""
    return staged.select("ward_code", F.col("ward_name").alias("station_name"), "province_name", "latitude", "longitude",
                         "timestamp_utc", F.col("value").alias("estimated_congestion_ratio"),
                         F.col("quality_flag").alias("data_quality_flag"))


def traffic_ward_hourly(staged: DataFrame) -> DataFrame:
    """Average congestion per ward and hour over sources."""
    hourly = (staged.filter(F.coalesce("ward_code", F.lit("")) != "")
              .groupBy("ward_code", F.col("province_name").alias("province"), F.col("timestamp_utc").alias("datetime_hour"))
              .agg(F.avg("value").alias("congestion_index"),
                   F.min("quality_flag").cast("string").alias("traffic_data_type"), newest_lineage().alias("_lineage")))
    return hourly.select("*", "_lineage.*").drop("_lineage").withColumn("date", F.to_date("datetime_hour"))


def offpeak_traffic(wards: DataFrame, hours: DataFrame) -> DataFrame:
    """Modelled traffic rows for off-peak local hours (07-20 produce none).

    ``hours``: ward_code, timestamp_utc to fill.
    """
    hour = times.local_hour("timestamp_utc")
    ratio = traffic.road_proxy("nearest_highway_type", "distance_to_road_km") * traffic.offpeak_decay(hour)
    return (hours.filter(~traffic.is_peak_hour(hour)).join(wards, "ward_code").withColumns({
        "traffic_source": F.lit("offpeak_model"), "congestion_ratio": ratio,
        "free_flow_speed": F.lit(fv.OFFPEAK_FREE_FLOW_KMH),
        "current_speed": F.lit(fv.OFFPEAK_FREE_FLOW_KMH) * (1 - ratio), "confidence": F.lit(0.4)}))


# --- whole graph ----------------------------------------------------------------------

class AirQualityModels:
    """Lazily built models over the raw tables.

    ``raw`` maps table roles to DataFrames: aqiin, waqi, openweather, weather,
    traffic, stations, wards, calibration.  Every attribute is a logical plan;
    store the large ones with ``operators.incremental.materialize``.  Without
    ``lineage``, ward hours of both mixes are made of values alone and their
    lineage is null: for marts that do not return it.
    """

    def __init__(self, raw: dict[str, DataFrame], lineage: bool = True):
        self.raw, self.lineage = raw, lineage
        self._built: dict[str, DataFrame] = {}

    def _once(self, name: str, build) -> DataFrame:
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    def use(self, name: str, rows: DataFrame) -> None:
        """Build everything above a model from its stored rows."""
        self._built[name] = rows

    def keep(self, *names: str) -> None:
        """Store models that several others are built from, instead of computing them again for each."""
        for name in names:
            self.use(name, stored(getattr(self, name), name.replace("_", "-")))

    @property
    def values(self) -> AirQualityModels:
        """The models without lineage."""
        return self._once("values", lambda: AirQualityModels(self.raw, lineage=False))

    @property
    def dim(self):
        return self._once("dim", lambda: joins.administrative_dim(self.raw["wards"]))

    def staged(self, source: str):
        if source == "openweather":
            return self._once("staged_openweather", lambda: stage_modelled(self.raw["openweather"]).drop("date"))
        return self._once(f"staged_{source}", lambda: stage_station(self.raw[source], source))

    def processed(self, source: str):
        if source == "openweather":
            return self._once("processed_openweather", lambda: process_modelled(self.staged("openweather")))
        return self._once(f"processed_{source}",
                          lambda: process_station(self.staged(source), self.raw["stations"], source))

    @property
    def observed_processed(self):
        return self._once("observed_processed", lambda: observed_by_position(
            {s: self.staged(s) for s in ("aqiin", "waqi")}, self.raw["stations"]).select(
                *self.processed("aqiin").columns, "latitude_rounded", "longitude_rounded", "version"))

    def source_hourly(self, source: str):
        return self._once(f"hourly_{source}", lambda: rollup.to_hourly(self._for_hours(source)))

    def _for_hours(self, source: str) -> DataFrame:
        """The processed rows of a source with the columns that hourly rows are made of."""
        if source == "observed":
            return observed_for_hours(self.raw, self.raw["stations"], lineage=self.lineage)
        if source == "openweather":
            columns = HOURLY_COLUMNS if self.lineage else ["value"]
            return process_modelled(_with_origin(stage_modelled(self.raw[source], ["province_name", *columns]).drop(
                *([] if self.lineage else ["raw_loaded_at"]))))
        return process_station(stage_station(self.raw[source], source, ["unit", *HOURLY_COLUMNS]), self.raw["stations"], source)

    @property
    def unified(self):
        staged = {s: self.staged(s) for s in ("aqiin", "waqi", "openweather")}
        return self._once("unified", lambda: measurements_unified(
            staged, self.raw["stations"], self.raw["wards"], self.raw["calibration"]))

    @property
    def ward_hourly(self):
        return self._once("ward_hourly", lambda: rollup.ward_hourly(
            self.source_hourly("observed"), self.source_hourly("openweather")))

    @property
    def ward_daily(self):
        return self._once("ward_daily", lambda: rollup.rollup_daily(self.ward_hourly))

    @property
    def ward_monthly(self):
        return self._once("ward_monthly", lambda: rollup.rollup_monthly(self.ward_daily))

    def ward(self, grain: str):
        return getattr(self, {"hour": "ward_hourly", "day": "ward_daily", "month": "ward_monthly"}[grain])

    def province(self, grain: str):
        return self._once(f"province_{grain}", lambda: rollup.rollup_province(self.ward(grain), grain))

    @property
    def hourly_summary(self):
        return self._once("hourly_summary", lambda: rollup.hourly_summary({
            "aqiin": (self.source_hourly("aqiin"), 1.0), "waqi": (self.source_hourly("waqi"), 1.0),
            "openweather": (self.source_hourly("openweather"), 0.5)}))

    def overview(self, grain: str):
        return self._once(f"overview_{grain}", lambda: joins.overview(self.ward(grain), self.dim, grain))

    @property
    def population(self):
        return self._once("population", lambda: rollup.population(self.raw["wards"]))

    @property
    def weather_hourly(self):
        return self._once("weather_hourly", lambda: weather_ward_hourly(self.raw["weather"], self.raw["wards"]))

    @property
    def ward_hourly_placed(self):
        """Ward hours with their weather place, and the weather of places."""
        return self._once("placed", lambda: weather_of(self.ward_hourly, self.raw["weather"], self.raw["wards"]))

    @property
    def traffic_staged(self):
        return self._once("traffic_staged", lambda: stage_traffic(self.raw["traffic"]))

    @property
    def traffic_hourly(self):
        return self._once("traffic_hourly", lambda: traffic_ward_hourly(self.traffic_staged))

    @property
    def unified_env(self):
        return self._once("unified_env", lambda: joins.unify_env(
            self.ward_hourly_placed[0], self.dim, self.ward_hourly_placed[1], self.traffic_hourly, self.population, ward="place"))
