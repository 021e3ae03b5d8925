"""URL rules by a cascade of Bloom filters, exact over the corpus's own keys.

Keys are host suffixes with path prefixes.  Level 0 encodes the listed keys;
the unlisted keys of the corpus that pass it are encoded by level 1, the listed
keys that pass that by level 2, and so on until none passes wrongly.  As every
key of the corpus took part, the answer is exact and needs no join with the list.
The bits grow with the list and the false positives, not with the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeframe.llm.tables import ship, stored


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    action: str

    @property
    def key(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
         Rule("net", "/es/", "block"), Rule("net", "/fr/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def candidate_keys(host: Column, path: Column, lengths: list[int], depths: list[int]) -> Column:
    """All (suffix of as many host labels as a listed host has + path prefix of a listed length) keys, longest host first.

    No other suffix can be listed, so a host of very many labels gives no more keys than there are listed depths and lengths.
    """
    labels = F.split(host, r"\.", -1)
    known = F.filter(F.array(*map(F.lit, sorted(depths, reverse=True))), lambda n: n <= F.size(labels))
    suffixes = F.transform(known, lambda n: F.concat_ws(".", F.slice(labels, F.size(labels) - n + 1, n)))
    prefixes = F.filter(F.array(*[F.when(F.char_length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull())
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))))


def _slots(h1: np.ndarray, h2: np.ndarray, n_bits: int, n_hashes: int, level: int) -> np.ndarray:
    """Bit numbers of each key, one row per hash; levels use different numbers."""
    a, b = h1.view(np.uint64), h2.view(np.uint64) | np.uint64(1)
    with np.errstate(over="ignore"):
        steps = (np.arange(n_hashes, dtype=np.uint64) + np.uint64(1 + 64 * level))[:, None]
        mixed = a[None, :] + steps * b[None, :]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return mixed % np.uint64(n_bits)


@dataclass
class Level:
    bits: np.ndarray
    n_hashes: int
    number: int

    def passes(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = _slots(h1, h2, len(self.bits) * 8, self.n_hashes, self.number)
        return ((self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _hashes(key: str | Column) -> list[Column]:
    key = F.col(key) if isinstance(key, str) else key
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


def _build(keys: DataFrame, n_keys: int, rate: float, number: int) -> Level:
    """One level from ``keys(h1, h2)``: tasks set bits in their own copy, copies are or-ed two steps deep."""
    n_bytes = max(8, int(np.ceil(-n_keys * np.log(rate) / np.log(2) ** 2 / 8)))
    n_hashes = max(1, round(-np.log2(rate)))

    def fill(batches):
        bits, any_key = np.zeros(n_bytes, np.uint8), False
        for b in batches:
            if len(b):
                at = _slots(b["h1"].to_numpy(np.int64), b["h2"].to_numpy(np.int64), n_bytes * 8, n_hashes, number).ravel()
                np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8)))
                any_key = True
        if any_key:
            yield pd.DataFrame({"bits": [bits.tobytes()]})

    def combine(batches):
        bits, any_key = np.zeros(n_bytes, np.uint8), False
        for b in batches:
            for x in b["bits"]:
                bits |= np.frombuffer(x, np.uint8)
                any_key = True
        if any_key:
            yield pd.DataFrame({"bits": [bits.tobytes()]})
    partial = keys.mapInPandas(fill, "bits binary").coalesce(8).mapInPandas(combine, "bits binary")
    bits = np.zeros(n_bytes, np.uint8)
    for row in partial.toLocalIterator():
        bits |= np.frombuffer(row["bits"], np.uint8)
    return Level(bits, n_hashes, number)


def _survivors(keys: DataFrame, levels: list[Level]) -> DataFrame:
    def run(batches):
        for b in batches:
            h1, h2 = b["h1"].to_numpy(np.int64), b["h2"].to_numpy(np.int64)
            ok = np.ones(len(b), bool)
            for level in levels:
                ok &= level.passes(h1, h2)
            yield b[ok]
    return keys.mapInPandas(run, keys.schema)


def build_cascade(listed: DataFrame, universe: DataFrame, first_rate: float = 0.02, most_levels: int = 40) -> list[Level]:
    """Levels that separate ``listed`` from the other keys of ``universe`` (columns ``key``) without error.

    The unlisted part is the universe without the keys that equal a listed one,
    found by the hashes the filters themselves use.
    """
    mine = stored(listed.select(*_hashes("key")).distinct(), "cascade-listed")
    n = mine.count()
    if n == 0:
        return []
    # the list is far smaller than the universe: only universe keys that pass level 0 meet it in a shuffle
    levels = [_build(mine, n, first_rate, 0)]
    passed = _survivors(universe.select(*_hashes("key")).distinct(), levels)
    other = stored(passed.join(mine, ["h1", "h2"], "left_anti"), "cascade-other")
    sides = [other, mine]
    for number in range(1, most_levels + 1):
        wrong = sides[(number + 1) % 2]
        count = wrong.count()
        if count == 0:
            return levels
        levels.append(_build(wrong, count, 0.5, number))
        sides[number % 2] = stored(_survivors(sides[number % 2], levels[-1:]), f"cascade-{number}")
    raise RuntimeError(f"the cascade did not end within {most_levels} levels")


def lookup(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the first level that rejects it decides."""
    inside, settled = np.zeros(len(h1), bool), np.zeros(len(h1), bool)
    for level in levels:
        rejects = ~settled & ~level.passes(h1, h2)
        inside[rejects] = level.number % 2 == 1
        settled |= rejects
    inside[~settled] = len(levels) % 2 == 1
    return inside


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row.

    The longest listed key of a url is its rule; a url without one is not on the
    list, so it gets ``default``.  Null or odd urls have an empty host and no
    rule.  Repeated rows repeat their result; other columns are ignored; an
    empty table gives no rows.  Urls of any length are read whole.
    """
    spark = pages.sparkSession
    ship(spark)
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    lengths = sorted({len(r.path) for r in rules})
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    depths = sorted({r.host.count(".") + 1 for r in rules})
    keyed = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths or [0], depths or [1]))
    listed = spark.createDataFrame([(r.key,) for r in rules], "key string")
    universe = keyed.select(F.explode("keys").alias("key")).distinct()
    cascade = spark.sparkContext.broadcast(build_cascade(listed, universe))

    @F.pandas_udf("array<boolean>")
    def members(h1: pd.Series, h2: pd.Series) -> pd.Series:
        sizes = h1.map(len).to_numpy()
        flat = lambda s: np.concatenate([np.zeros(0, np.int64), *[np.asarray(x, np.int64) for x in s]])
        found = lookup(cascade.value, flat(h1), flat(h2))
        return pd.Series(np.split(found, np.cumsum(sizes)[:-1]) if len(sizes) else [])
    hashed = keyed.withColumn("is_listed", members(F.transform("keys", lambda k: F.xxhash64(k)), F.transform("keys", lambda k: F.xxhash64(F.lit("second"), k))))
    found = F.transform(F.filter(F.arrays_zip("keys", "is_listed"), lambda z: z["is_listed"]),
                        lambda z: F.struct(F.char_length(z["keys"]).alias("n"), z["keys"].alias("key")))
    best = hashed.select("page_id", "host", "path", F.array_max(found)["key"].alias("rule"))
    blocks = [r.key for r in rules if r.action == "block"]
    verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(F.col("rule").isin(blocks), F.lit("block")).otherwise(F.lit("allow"))
    return best.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
