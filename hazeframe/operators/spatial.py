"""Grid, nearest-point and interpolation joins.

Nearest-point search never builds the product of both sides.  Points are
reduced to distinct positions; each position looks up, in one equi-join
against the occupied cells of a cell pyramid, the finest level at which its
3x3 neighbourhood already holds ``k`` reference points.  That bounds the
distance of the k-th neighbour, hence the level whose 3x3 block provably
contains all k, and a second equi-join fetches exactly that block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.functions import geo
from hazeframe.functions.traffic import road_proxy

# Pyramid: number of cells around the full circle, finest first; 1 = everything.
PYRAMID = (65536, 16384, 4096, 1024, 256, 64, 16, 1)
COARSE = 64  # levels of at most this many cells around: together fewer than 3,000 cells


# Cell lists are SQL text: one parse instead of a driver round trip per node.

def _cell(coordinate: str, n: int) -> str:
    return f"CAST(floor(({coordinate} + 180D) * {n / 360.0!r}D) AS INT)"


def _cell_struct(level: int, cy: str, cx: str) -> str:
    return f"named_struct('level', {level}, 'cy', {cy}, 'cx', {cx})"


def _own_cells(lat: str, lon: str) -> Column:
    cells = [_cell_struct(i, _cell(lat, n), f"pmod({_cell(lon, n)}, {n})") for i, n in enumerate(PYRAMID)]
    return F.expr(f"array({', '.join(cells)})")


def _block(lat: str, lon: str, i: int) -> str:
    """Cells of the 3x3 block around a position at pyramid level ``i`` (distinct), as text."""
    n = PYRAMID[i]
    if n == 1:
        return _cell_struct(i, "0", "0")
    return ", ".join(_cell_struct(i, f"{_cell(lat, n)} + ({dy})", f"pmod({_cell(lon, n)} + ({dx}), {n})")
                     for dy in (-1, 0, 1) for dx in (-1, 0, 1))


def _reach(lat: Column, i: int, metric: str) -> Column:
    """Everything closer than this lies inside the 3x3 block of level ``i``."""
    n = PYRAMID[i]
    if n == 1:
        return F.lit(float("inf"))
    step = 360.0 / n
    if metric == "planar":
        return F.lit(step)
    # nearest point of the meridian one cell away; the parallel is never closer
    return F.asin(F.cos(F.radians(lat)) * math.sin(math.radians(step))) * geo.EARTH_RADIUS_M


def _bound(i: int, metric: str) -> float:
    """No point inside the 3x3 block of level ``i`` is farther than this."""
    n = PYRAMID[i]
    if n == 1:
        return float("inf")
    degrees = 2 * math.sqrt(2) * 360.0 / n
    return degrees if metric == "planar" else math.radians(degrees) * geo.EARTH_RADIUS_M


def _distance(metric: str, p_lat, p_lon, r_lat, r_lon) -> Column:
    if metric == "planar":
        return geo.planar_degrees(p_lon, p_lat, r_lon, r_lat)
    return geo.great_circle_m(p_lon, p_lat, r_lon, r_lat)


def knn(points: DataFrame, refs: DataFrame, k: int, metric: str = "sphere",
        lat: str = "latitude", lon: str = "longitude", ref_lat: str = "ref_lat",
        ref_lon: str = "ref_lon", ref_key: str = "ref_key") -> DataFrame:
    """The ``k`` nearest references of every distinct position.

    Returns ``lat, lon, <ref columns>, distance, neighbour`` (1 = nearest; ties
    by ``ref_key``).  Exact for any distribution; planar coordinates must stay
    within one turn (no wrap at +-180).
    """
    refs = refs.filter(F.col(ref_lat).isNotNull() & F.col(ref_lon).isNotNull())
    positions = (points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
                 .select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).distinct())
    occupied = (refs.select(F.explode(_own_cells(ref_lat, ref_lon)).alias("c"))
                .groupBy("c.level", "c.cy", "c.cx").agg(F.count(F.lit(1)).alias("n")))

    # coarse cells hold every position of a region, so they never become a shuffle key; there are few of them
    coarse = [i for i, n in enumerate(PYRAMID) if n <= COARSE]
    fine = [i for i, n in enumerate(PYRAMID) if n > COARSE]

    def hits(levels, cells):
        blocks = F.expr(f"array({', '.join(_block('_lat', '_lon', i) for i in levels)})")
        return (positions.select("_lat", "_lon", F.explode(blocks).alias("c")).select("_lat", "_lon", "c.*")
                .join(cells, ["level", "cy", "cx"]).select("_lat", "_lon", "level", "n"))
    level_hits = (hits(fine, occupied.filter(F.col("level").isin(fine)))
                  .unionByName(hits(coarse, F.broadcast(occupied.filter(F.col("level").isin(coarse)))))
                  .groupBy("_lat", "_lon", "level").agg(F.sum("n").alias("n")))
    levels = range(len(PYRAMID))
    last = len(PYRAMID) - 1
    finest = (level_hits.groupBy("_lat", "_lon")
              .agg(F.coalesce(F.min(F.when(F.col("n") >= k, F.col("level"))), F.lit(last)).alias("_fine")))

    far = F.element_at(F.array(*[F.lit(_bound(i, metric)) for i in range(last + 1)]), F.col("_fine") + 1)
    search = F.lit(last)
    for i in reversed(range(last)):
        search = F.when((F.col("_fine") <= i) & (_reach(F.col("_lat"), i, metric) >= far), i).otherwise(search)
    arms = " ".join(f"WHEN {i} THEN array({_block('_lat', '_lon', i)})" for i in levels)
    block = F.expr(f"CASE _search {arms} END")
    wanted = (finest.withColumn("_search", search)
              .select("_lat", "_lon", F.explode(block).alias("c")).select("_lat", "_lon", "c.*"))

    candidates = (refs.withColumn("c", F.explode(_own_cells(ref_lat, ref_lon)))
                  .select("*", "c.*").drop("c"))
    pairs = wanted.join(candidates, ["level", "cy", "cx"]).drop("level", "cy", "cx").withColumn(
        "distance", _distance(metric, F.col("_lat"), F.col("_lon"), F.col(ref_lat), F.col(ref_lon)))
    if k == 1:
        row = F.struct(*[c for c in pairs.columns if c not in ("_lat", "_lon")])
        best = (pairs.groupBy("_lat", "_lon")
                .agg(F.min_by(row, F.struct("distance", ref_key)).alias("_best"))
                .select("_lat", "_lon", "_best.*").withColumn("neighbour", F.lit(1)))
    else:
        w = Window.partitionBy("_lat", "_lon").orderBy("distance", ref_key)
        best = pairs.withColumn("neighbour", F.row_number().over(w)).filter(F.col("neighbour") <= k)
    return best.withColumnsRenamed({"_lat": lat, "_lon": lon})


def nearest_join(points: DataFrame, refs: DataFrame, metric: str = "sphere", lat: str = "latitude",
                 lon: str = "longitude", ref_lat: str = "ref_lat", ref_lon: str = "ref_lon",
                 ref_key: str = "ref_key") -> DataFrame:
    """Attach to every point its nearest reference row and ``distance``."""
    best = knn(points, refs, 1, metric, lat, lon, ref_lat, ref_lon, ref_key).drop("neighbour")
    return points.join(best, [lat, lon])


def nearest_enrich(df: DataFrame, refs: DataFrame, lat: str = "latitude", lon: str = "longitude",
                   **ref_names) -> tuple[DataFrame, DataFrame]:
    """Nearest reference by planar degrees -> (mapped rows, quarantined rows)."""
    located = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    quarantine = df.filter(~located).withColumn("quarantine_reason", F.lit("missing_lat_lon"))
    mapped = nearest_join(df.filter(located), refs, "planar", lat, lon, **ref_names)
    return mapped.withColumn("distance_km", F.col("distance") * geo.KM_PER_DEGREE).drop("distance"), quarantine


def grid_join(df: DataFrame, wards: DataFrame, size: float = 0.2, cluster: str = "weather_cluster",
              province: str = "province") -> DataFrame:
    """Fan cell-level rows out to every ward of the same cell and province."""
    keyed = wards.withColumn(cluster, geo.grid_key("latitude", "longitude", size))
    return df.join(keyed, [cluster, province])


def grid_clusters(points: DataFrame, key: str, size: float = 0.2, lat: str = "latitude",
                  lon: str = "longitude") -> DataFrame:
    """Cells with their representative (smallest key) and number of members.

    Membership is the ``points`` side of ``cluster_members`` rather than an
    array per cell, which would grow with the data.
    """
    return (cluster_members(points, size, lat, lon).groupBy("cluster_id")
            .agg(F.min_by(F.struct(F.col(key).alias("representative"), F.col(lat).alias("lat"),
                                   F.col(lon).alias("lon")), F.col(key)).alias("rep"),
                 F.count(F.lit(1)).alias("members"))
            .select("cluster_id", "rep.*", "members"))


def cluster_members(points: DataFrame, size: float = 0.2, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return points.withColumn("cluster_id", geo.grid_key(lat, lon, size))


def map_stations(stations: DataFrame, wards: DataFrame) -> DataFrame:
    """Station -> ward by normalised (province, ward) name, else by nearest centroid.

    ``stations``: station_name, latitude, longitude, norm_province, norm_ward;
    ``wards``: ward_code, province, norm_province, norm_ward, ref_lat, ref_lon.
    A station with neither name nor position stays, without a ward.
    """
    names = wards.select("norm_province", "norm_ward", "ward_code", "province")
    base = ["station_name", "latitude", "longitude"]
    named = stations.select(*base, "norm_province", "norm_ward").join(names, ["norm_province", "norm_ward"], "left").select(*base, "ward_code", "province")
    hit = F.coalesce(F.col("ward_code"), F.lit("")) != ""
    refs = wards.select("ward_code", F.col("province").alias("ref_province"), "ref_lat", "ref_lon")
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    near = nearest_join(named.filter(~hit & located).select(*base), refs, ref_key="ward_code")
    lost = named.filter(~hit & ~located).select(*base, *[F.lit(None).cast("string").alias(c) for c in ("ward_code", "province")])
    return (named.filter(hit).withColumn("match", F.lit("name"))
            .unionByName(near.select(
                *base, "ward_code", F.col("ref_province").alias("province")).withColumn("match", F.lit("nearest")))
            .unionByName(lost.withColumn("match", F.lit("missing_lat_lon"))))


def idw_fill(targets: DataFrame, known: DataFrame, k: int = 10, alpha: float = 0.65,
             key: str = "ward_code") -> DataFrame:
    """Inverse-distance congestion for targets without a measurement.

    ``targets``: key, latitude, longitude, nearest_highway_type,
    distance_to_road_km; ``known``: key, latitude, longitude, current_speed,
    free_flow_speed.  Blends ``alpha`` interpolation with the road proxy.
    Targets without coordinates stay, without values.
    """
    refs = known.select(
        F.col(key).alias("ref_key"), F.col("latitude").alias("ref_lat"), F.col("longitude").alias("ref_lon"),
        (1 - F.col("current_speed") / F.greatest(F.col("free_flow_speed"), F.lit(1.0))).alias("ref_ratio"),
        F.col("free_flow_speed").alias("ref_free_flow"))
    missing = targets.join(known.select(key).distinct(), key, "left_anti")
    d = F.greatest(F.col("distance"), F.lit(1e-6))
    near = knn(missing, refs, k, "planar").withColumn("w", 1 / (d * d))
    filled = near.groupBy("latitude", "longitude").agg(
        (F.sum(F.col("w") * F.col("ref_ratio")) / F.sum("w")).alias("interp_ratio"),
        (F.sum(F.col("w") * F.col("ref_free_flow")) / F.sum("w")).alias("free_flow_speed"),
        F.count(F.lit(1)).alias("neighbours"))
    proxy = road_proxy("nearest_highway_type", "distance_to_road_km")
    ratio = F.least(F.lit(1.0), F.greatest(
        F.lit(0.0), F.col("interp_ratio") * alpha + proxy * (1 - alpha)))
    return (missing.join(filled, ["latitude", "longitude"], "left")
            .withColumn("congestion_ratio", F.when(F.col("interp_ratio").isNotNull(), ratio))
            .withColumn("current_speed", F.col("free_flow_speed") * (1 - F.col("congestion_ratio"))))


def station_flags(stations: DataFrame, wards: DataFrame, near_m: float = 2000.0) -> DataFrame:
    """Per ward: distance from its centroid to the closest of its own stations."""
    d = geo.great_circle_m("longitude", "latitude", "ward_lon", "ward_lat")
    centroids = wards.select("ward_code", F.col("latitude").alias("ward_lat"), F.col("longitude").alias("ward_lon"))
    return (stations.join(centroids, "ward_code").groupBy("ward_code")
            .agg(F.min(d).alias("nearest_station_distance_m"))
            .withColumn("has_nearby_station", F.col("nearest_station_distance_m") <= near_m))


def suppress_near(df: DataFrame, flags: DataFrame, source: str = "openweather") -> DataFrame:
    """Drop modelled rows of wards that have a station close to the centroid."""
    flagged = df.join(flags.select("ward_code", "has_nearby_station"), "ward_code", "left")
    drop = (F.col("source") == source) & F.coalesce(F.col("has_nearby_station"), F.lit(False))
    return flagged.filter(~drop).drop("has_nearby_station")


def select_tier(wards: DataFrame, limit: int = 600, max_km: float = 1.0, key: str = "ward_code") -> DataFrame:
    """Most populous wards near a road; of all wards when too few are near one."""
    near = wards.filter(F.col("distance_to_road_km") <= max_km)
    enough = near.limit(limit).count() >= limit
    return (near if enough else wards).orderBy(F.desc("population"), key).limit(limit)
