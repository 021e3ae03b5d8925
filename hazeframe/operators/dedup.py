"""Latest-version and top-per-key operators.

All of them reduce on the map side first (aggregates combine partially, and
``row_number() <= n`` gets a partial group limit before its shuffle), so a key
that holds a large share of the rows does not land whole in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.functions.aggregates import arg_max


def latest_by_key(df: DataFrame, keys: list[str], version: str, columns: list[str] | None = None,
                  tiebreak: list[str] = (), sparse: list[str] | None = None, near: list[str] = ()) -> DataFrame:
    """One row per key; each column holds its latest non-NULL value by version.

    ``sparse`` names the columns that may be NULL in a later row (default: all).
    The others travel together as one aggregate, which is much cheaper.
    ``near`` names keys by which rows are dealt before they are compared: rows
    that share them lie side by side in the shuffle, which compresses them, are
    sorted once, and meet again in later groupings by these columns without
    another shuffle.  Few rows per key gain by it; many rows per key do not,
    since nothing is combined before the shuffle.
    """
    skip = set(keys) | {version}
    columns = [c for c in (columns or df.columns) if c not in skip]
    sparse = columns if sparse is None else sparse
    dense = [c for c in columns if c not in sparse]
    order = [version, *[t for t in tiebreak if t != version]]
    place = {c: f"_o{i}" for i, c in enumerate(order)} | {c: c for c in dense if c not in order}
    row = F.struct(*[F.col(c).alias(name) for c, name in place.items()])
    if near:
        df = df.select(*dict.fromkeys([*keys, *order, *columns])).repartition(*near)
    out = df.groupBy(*keys).agg(
        F.max(row).alias("_row"), *[arg_max(c, version, *tiebreak).alias(c) for c in sparse])
    return out.select(*keys, *[F.col(f"_row.{place[c]}").alias(c) if c in dense else F.col(c) for c in columns],
                      F.col("_row._o0").alias(version))


def final(df: DataFrame, keys: list[str], version, tiebreak: list[str] = ()) -> DataFrame:
    """Whole latest row per key (exact read of a version-replacing table)."""
    version = F.col(version) if isinstance(version, str) else version
    order = F.struct(version, *[F.col(t) for t in tiebreak])
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def final_late(df: DataFrame, keys: list[str], version: str, tiebreak: list[str] = ()) -> DataFrame:
    """``final`` for keys with many versions, which fetches whole rows late.

    The newest version per key is a hash aggregate over keys and version alone
    (a scan reads only these columns).  Whole rows are read once more and kept if
    they have it: before their shuffle where Spark finds the newest versions
    small enough to broadcast or to filter by, after it otherwise.  Only rows
    that tie for the newest version are compared by ``tiebreak``.  ``version``
    must be of a fixed-width type; a null version is older than any other.
    """
    newest = df.groupBy(*keys).agg(F.max(version).alias("_newest")).withColumnsRenamed({k: f"_key_{i}" for i, k in enumerate(keys)})
    same = F.col(version).eqNullSafe(F.col("_newest"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    return final(df.join(newest, same, "left_semi"), keys, version, tiebreak)


def limit_by(df: DataFrame, keys: list[str], order: list, n: int = 1) -> DataFrame:
    """First ``n`` rows of every key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def keep_last(df: DataFrame, keys: list[str], order_col: str, tiebreak: list[str] = ()) -> DataFrame:
    """Keep the row written last for every key."""
    return final(df, keys, order_col, tiebreak)


def fuse_observed(first: DataFrame, second: DataFrame, decimals: int = 4,
                  tiebreak: list[str] = ("station_name",), dealt: bool = False) -> DataFrame:
    """Merge two station networks: one row per rounded position, time, parameter.

    ``second`` outranks ``first``; within a network the later load wins.  Rows
    that are ``dealt`` go by position and date first: those of a station lie side
    by side in the shuffle, which compresses them, and are compared without a
    second copy of what orders them.  It suits readings reduced to one per station.
    """
    both = (first.withColumn("_priority", F.lit(1))
            .unionByName(second.withColumn("_priority", F.lit(2)), allowMissingColumns=True))
    keyed = both.withColumns({
        "latitude_rounded": F.round("latitude", decimals),
        "longitude_rounded": F.round("longitude", decimals)})
    if dealt:
        def text(c):  # zeros of both signs are one position
            return F.coalesce(F.col(c).cast("string"), F.lit("none"))
        zeroed = {c: F.col(c) + F.lit(0.0) for c in ("latitude_rounded", "longitude_rounded")}
        keyed = keyed.withColumns(zeroed).withColumns({
            "_position": F.concat(text("latitude_rounded"), F.lit(" "), text("longitude_rounded")), "_date": F.to_date("timestamp_utc")})
        return fuse_ranked(keyed.repartition("_position", "_date"), ["_position", "_date", "timestamp_utc", "parameter"], tiebreak).drop("_position", "_date")
    return fuse_ranked(keyed, ["latitude_rounded", "longitude_rounded", "timestamp_utc", "parameter"], tiebreak)


def fuse_ranked(both: DataFrame, keys: list[str], tiebreak: list[str] = ("station_name",)) -> DataFrame:
    """The row of the highest ``_priority`` per key, the later load within a network; adds ``version``."""
    return final(both.withColumn("version", rank_version(F.col("_priority"))).drop("_priority"), keys, "version", list(tiebreak))


def rank_version(priority: Column) -> Column:
    """Orders readings by the priority of their network, then by load."""
    return priority.cast("bigint") * 3_000_000_000 + F.unix_timestamp("raw_loaded_at")


def pack(df: DataFrame, keys: list[str], name: str, names: list[str], columns: list[str]) -> DataFrame:
    """One row per key with a struct column ``_<n>`` for every name (null without such a row).

    ``df`` has one row per key and name, as ``latest_by_key`` leaves it; rows of
    other names are dropped.  Later shuffles and sorts handle a row per key then.
    """
    return df.filter(F.col(name).isin(names)).groupBy(*keys).agg(
        *[F.max(F.when(F.col(name) == n, F.struct(*columns))).alias(f"_{n}") for n in names])


def fuse_packed(both: DataFrame, keys: list[str], names: list[str], version: str, origin: list[str]) -> DataFrame:
    """``fuse_ranked`` of packed rows: per key and name the reading of the highest version and, on ties, origin.

    Returns ``keys``, the origin but for its first column, and the packed columns
    without ``version``.  Readings of a key that come from several origins make a
    row for each.
    """
    best = both.groupBy(*keys).agg(*[F.max(F.when(F.col(f"_{n}").isNotNull(), F.struct(
        F.col(f"_{n}.{version}").alias("_version"), *origin, F.col(f"_{n}").dropFields(version).alias("_reading")))).alias(f"_{n}") for n in names])
    where = origin[1:]
    found = [F.when(F.col(f"_{n}").isNotNull(), F.struct(*[F.col(f"_{n}.{c}").alias(c) for c in where])) for n in names]
    places = best.select("*", F.explode(F.array_distinct(F.array_compact(F.array(*found)))).alias("_place"))
    return places.select(*keys, "_place.*", *[F.when(reduce(lambda a, b: a & b, [
        F.col(f"_{n}.{c}").eqNullSafe(F.col(f"_place.{c}")) for c in where]), F.col(f"_{n}._reading")).alias(f"_{n}") for n in names])


def unpack(df: DataFrame, name: str, names: list[str]) -> DataFrame:
    """Packed rows as one row per reading, its name in column ``name``."""
    keys = [c for c in df.columns if c not in [f"_{n}" for n in names]]
    readings = F.filter(F.array(*[F.struct(F.lit(n).alias(name), F.col(f"_{n}").alias("_reading")) for n in names]), lambda r: r["_reading"].isNotNull())
    return df.select(*keys, F.inline(readings)).select(*keys, name, "_reading.*")
