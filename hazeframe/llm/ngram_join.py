"""Size-aware Jaccard self-join of word-shingle sets.

Equal sets are merged first.  The others fall into two kinds.

* Light sets (small): every pair of sizes asks for a fixed overlap c; each set
  lists all its subsets of c shingles per partner size, so two sets that share a
  listed subset are linked for certain and nothing needs to be compared.
* Heavy sets: listing subsets explodes, so inverted lists are scanned.  A list
  belongs to a piece of a set: the shingles are dealt by hash to more pieces than
  the largest symmetric difference that a linked pair may have, so linked sets
  agree on some whole pieces and meet in their lists.  Lists of single shingles
  would hold every document that quotes a passage, and sets that share nothing
  else; lists of pieces do not.  There are spare pieces: as many as a set may
  leave unlisted because they are empty or hold common shingles only.  What is
  common is told by a table of fixed size that counts every shingle of the
  corpus; it changes lengths of lists, never results.  Most pieces occur in one
  set only.  The keys of all pieces are gathered first, as a few bytes each, in a
  table of bits of bounded size; lists hold only the keys whose bit says that they
  may occur more than once.

The boundary between the kinds is the size at which listing costs more than
scanning, from the sizes at hand.  Sets that meet in lists form clusters; a
cluster is cut into blocks of bounded content, and tiles of two blocks count
overlaps with matrix products.  Blocks first meet themselves and a few common
pivots; what that has joined already is not compared again.  Texts travel to their
tiles, since they are smaller than their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hazeframe.llm.graph import connected_components, local_forest
from hazeframe.llm.tables import freeing_shuffles, nested, scratch, ship, stored, text_or_empty

_RANDOM = np.random.default_rng(20240101).integers(0, 2**63, 257, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 2**64))
    with np.errstate(over="ignore"):
        up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE))])
        down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, inverse))])
    return up, down


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of each word, A-Z lower-cased, cut at the six white-space bytes."""
    raw = np.frombuffer(text.encode(), np.uint8)
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    gap = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(1 << max(16, int(len(raw)).bit_length()))
    with np.errstate(over="ignore"):
        run = np.concatenate([[np.uint64(0)], np.cumsum(_RANDOM[low] * up[:len(raw)], dtype=np.uint64)])
        return scramble((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_set(text: str, words: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; shorter texts are one shingle, empty ones none."""
    h = word_hashes(text)
    with np.errstate(over="ignore"):
        if not len(h):
            return h
        k = min(words, len(h))
        mixed = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            mixed = mixed * _BASE + h[i:len(h) - k + 1 + i]
        return np.unique(scramble(mixed + np.uint64(k)))


class Measure:
    """Integer arithmetic of ``100 * intersection >= percent * union``."""

    def __init__(self, percent: int):
        self.percent = percent

    def overlap(self, n: int, m: int) -> int:
        """Least intersection of linked sets of sizes n and m."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def largest(self, n: int) -> int:
        """Largest size that a set of size n can be linked with."""
        return n * 100 // self.percent

    def smallest(self, n: int) -> int:
        return -(-n * self.percent // 100)

    def size_class(self, n: int) -> int:
        return int(np.searchsorted(self.bounds(n), n, side="right")) - 1

    @lru_cache(maxsize=64)
    def _bounds(self, top: int) -> np.ndarray:
        out = [1]
        while out[-1] <= top:
            out.append(self.largest(out[-1]) + 1)
        return np.array(out)

    def bounds(self, n: int) -> np.ndarray:
        """First size of each class; a set is linked with its own and the next class only."""
        return self._bounds(1 << max(10, int(n).bit_length()))

    @lru_cache(maxsize=4096)
    def difference(self, size_class: int) -> int:
        """Largest symmetric difference of a linked pair whose smaller set is in the class.

        It rises with the sum of the sizes but for rounding, which repeats within ``100 + percent``.
        """
        n = int(self.bounds(1 << 40)[size_class + 1]) - 1
        top = n + self.largest(n)
        return max(total - 2 * self.overlap(total, 0) for total in range(max(2, top - 2 * (100 + self.percent)), top + 1))

    def pieces(self, size_class: int) -> tuple[int, int]:
        """(pieces, spare ones): linked sets agree on at least one piece more than there are spare ones."""
        needed = self.difference(size_class) + 1
        spare = needed * 3 // 20 + 4
        return needed + spare, spare

    @lru_cache(maxsize=4096)
    def partners(self, n: int, boundary: int) -> tuple[tuple[int, int], ...]:
        """(partner size, overlap asked for) of a set of size n, where the smaller side is within the boundary."""
        mates = [m for m in range(self.smallest(n), self.largest(n) + 1) if min(n, m) <= boundary]
        return tuple((m, self.overlap(n, m)) for m in mates if self.overlap(n, m) <= min(n, m))

    def listed(self, n: int, boundary: int) -> int:
        return sum(comb(n, c) for _, c in self.partners(n, boundary))


def choose_boundary(measure: Measure, sizes: dict[int, int], scan_cost: float = 6.0, most_listed: int = 5000) -> int:
    """Size up to which listing subsets is cheaper than scanning piece lists.

    ``sizes`` counts sets by (small) size.  Scanning costs ``scan_cost`` rows
    per piece: its row, and its share of blocks and tiles.
    """
    best, best_cost = 0, None
    for x in range(0, max(sizes, default=0) + 1):
        reach = measure.largest(x)
        if any(measure.listed(n, x) > most_listed for n in range(max(1, x - 1), reach + 1)):
            break
        light = sum(c * measure.listed(n, x) for n, c in sizes.items() if n <= reach)
        heavy = sum(c * scan_cost * 2 * measure.pieces(measure.size_class(n))[0] for n, c in sizes.items() if n > x)
        if best_cost is None or light + heavy < best_cost:
            best, best_cost = x, light + heavy
    return best


def subset_keys(s: np.ndarray, measure: Measure, boundary: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all listed subsets and the role of the set in each list: 1 for the larger side of unequal sizes, else 0.

    A list belongs to a subset and a pair of sizes.  Sets of the smaller size
    that share it overlap enough among themselves, sets of the larger size
    overlap enough with each of the smaller ones.
    """
    n, keys, roles = len(s), [], []
    with np.errstate(over="ignore"):
        mixed = scramble(s)
        total = mixed.sum(dtype=np.uint64)
        for m, c in measure.partners(n, boundary):
            left_out = np.array(list(combinations(range(n), n - c)), np.int64) if n > c else None
            sums = np.array([total]) if n == c else total - mixed[left_out].sum(axis=1, dtype=np.uint64)
            keys.append(scramble(sums + scramble(np.uint64(min(n, m) * 65536 + max(n, m)) * _BASE)))
            roles.append(np.full(len(sums), int(n > m), np.int8))
    return (np.concatenate(keys), np.concatenate(roles)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int8))


def piece_keys(s: np.ndarray, measure: Measure, boundary: int, common: np.ndarray) -> np.ndarray:
    """Keys of the pieces of a set, in the scheme of its own size class and of the class below.

    A piece without any shingle that is rare enough (``common`` marks the slots of
    the others), such as an empty one, says little and would tie unrelated sets.
    A set with no more such pieces than there are spare ones lists only its other
    pieces: it agrees on one of these with every linked set.  The few sets with
    more list all, so two of them still meet.
    """
    n, keys = len(s), []
    own = measure.size_class(n)
    rare = ~common[slot_of(s)]
    for k in (own, own - 1):
        if k < 0 or measure.bounds(n)[k + 1] - 1 <= boundary or (k < own and measure.smallest(n) >= measure.bounds(n)[own]):
            continue
        pieces, spare = measure.pieces(k)
        with np.errstate(over="ignore"):
            where = (scramble(s + np.uint64(k + 1) * _BASE) % np.uint64(pieces)).astype(np.int64)
            sums = np.zeros(pieces, np.uint64)
            np.add.at(sums, where, scramble(s ^ _RANDOM[0]))
            names = scramble(sums + scramble(np.arange(pieces, dtype=np.uint64) + np.uint64(k + 1) * _RANDOM[1]))
        telling = np.zeros(pieces, bool)
        telling[where[rare]] = True
        keys.append(names[telling] if pieces - int(telling.sum()) <= spare else names)
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def mark_of(s: np.ndarray) -> int:
    """64-bit name that equal sets share."""
    with np.errstate(over="ignore"):
        return int(scramble(scramble(s ^ _RANDOM[2]).sum(dtype=np.uint64) + np.uint64(len(s))).view(np.int64))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))


#: Slots of the corpus table of shingle counts (4 MiB of counts), and of one block of it.
SLOT_BITS, BLOCK_BITS = 20, 14


def slot_of(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def common_slots(counts: np.ndarray) -> np.ndarray:
    """Slots that occur far more often than chance deals shingles to slots: they hold a passage that many documents quote."""
    mean = counts.mean()
    return counts > mean + 10 * np.sqrt(mean) + 20


#: Bits of a key that tell whether it occurs again, and how many of them name its shard.
KEY_BITS, SHARD_BITS = 40, 12
#: Most bits of the table of repeated keys (32 MiB), and so many keys are packed at once.
MOST_REPEAT_BITS, PACKED_AT_ONCE = 28, 2_000_000
_MARKS = "doc_id long, n_shingles long, mark long, block int, counts binary, shard int, keys binary"


def _marks_frame(**columns) -> pd.DataFrame:
    rows = len(next(iter(columns.values())))
    empty = {"doc_id": pd.Series(None, range(rows), "Int64"), "n_shingles": 0, "mark": 0, "block": pd.Series(None, range(rows), "Int32"), "counts": None,
             "shard": pd.Series(None, range(rows), "Int32"), "keys": None}
    return pd.DataFrame(empty | columns)


def pack_keys(keys: np.ndarray) -> pd.DataFrame:
    """``shard, keys``: per shard the sorted keys as differences, cut to the bytes they need; equal keys stay equal."""
    h = np.sort(keys >> np.uint64(64 - KEY_BITS))
    low = np.uint64(KEY_BITS - SHARD_BITS)
    edges = np.searchsorted(h, np.arange((1 << SHARD_BITS) + 1, dtype=np.uint64) << low)
    shards = np.flatnonzero(np.diff(edges))
    steps = np.diff(h, prepend=np.uint64(0))
    steps[edges[shards]] = h[edges[shards]] & np.uint64((1 << int(low)) - 1)
    raw = steps.astype("<u4").view(np.uint8).reshape(-1, 4)
    packed = []
    for k in shards:
        rows = raw[edges[k]:edges[k + 1]]
        width = 4 if rows[:, 3].any() else 3
        packed.append(bytes([width]) + rows[:, :width].T.tobytes())
    return pd.DataFrame({"shard": shards.astype(np.int32), "keys": packed})


def unpack_keys(raw: bytes) -> np.ndarray:
    """The keys of a shard, without the bits that name the shard, sorted."""
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    return np.cumsum(sum(p.astype(np.uint64) << np.uint64(8 * i) for i, p in enumerate(planes)), dtype=np.uint64)


def _marks_and_counts(words: int, measure: Measure | None):
    """A row per document, and at the end of a task its counts by blocks of slots; equal sets it has just seen count once.

    With ``measure``, also the keys of all pieces that the sets may list, packed by shard.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        nothing = np.zeros(1 << SLOT_BITS, bool)
        seen: set[int] = set()
        pieces: list[np.ndarray] = []
        held = 0
        for b in batches:
            sets = [shingle_set(t, words) for t in b["text"]]
            marks = [mark_of(s) for s in sets]
            new = [s for m, s in dict(zip(marks, sets)).items() if m not in seen]
            if len(seen) > 200_000:
                seen.clear()
            seen.update(marks)
            if new:
                counts += np.bincount(slot_of(np.concatenate(new)), minlength=len(counts))
            for s in new if measure else []:
                if len(s):
                    pieces.append(piece_keys(s, measure, 0, nothing))
                    held += len(pieces[-1])
                if held > PACKED_AT_ONCE:
                    yield _marks_frame(**pack_keys(np.concatenate(pieces)))
                    pieces, held = [], 0
            yield _marks_frame(doc_id=b["doc_id"].reset_index(drop=True), n_shingles=[len(s) for s in sets], mark=marks)
        if held:
            yield _marks_frame(**pack_keys(np.concatenate(pieces)))
        blocks = counts.reshape(-1, 1 << BLOCK_BITS)
        used = np.flatnonzero(blocks.any(axis=1))
        yield _marks_frame(block=pd.Series(used, dtype="Int32"), counts=[x.astype("<u4").tobytes() for x in blocks[used]])
    return run


def _repeated(bits: int):
    """For every shard the bits of the keys that occur more than once; rows arrive sorted by shard and are kept by shard only."""
    def bits_of(held: list[np.ndarray]) -> bytes | None:
        h = np.sort(np.concatenate(held))
        again = h[1:][h[1:] == h[:-1]]
        if not len(again):
            return None
        table = np.zeros(1 << bits, bool)
        table[(again >> np.uint64(KEY_BITS - SHARD_BITS - bits)).astype(np.int64)] = True
        return np.packbits(table).tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, held = None, []
        for b in batches:
            for at, raw in zip(b["shard"], b["keys"]):
                if at != shard:
                    if held and (found := bits_of(held)):
                        yield pd.DataFrame({"shard": [shard], "bits": [found]})
                    shard, held = at, []
                held.append(unpack_keys(raw))
        if held and (found := bits_of(held)):
            yield pd.DataFrame({"shard": [shard], "bits": [found]})
    return run


def may_repeat(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether the keys may occur more than once in the corpus; those that do always may."""
    at = (keys >> np.uint64(64 - int(8 * len(table)).bit_length() + 1)).astype(np.int64)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of each block added up; rows arrive sorted by block and are not kept."""
    block, total = None, None
    for b in batches:
        for at, raw in zip(b["block"], b["counts"]):
            if at != block:
                if block is not None:
                    yield pd.DataFrame({"block": [block], "counts": [total.tobytes()]})
                block, total = at, np.zeros(1 << BLOCK_BITS, np.int64)
            total += np.frombuffer(raw, "<u4")
    if block is not None:
        yield pd.DataFrame({"block": [block], "counts": [total.tobytes()]})


def shingle_marks(docs: DataFrame, id_col: str, text_col: str, words: int) -> tuple[DataFrame, np.ndarray]:
    """``doc_id, n_shingles, mark`` of every row, and for each slot how often its shingles occur in the corpus.

    The counts reach the driver as one table of fixed size, however large the corpus.
    """
    both = stored(_texts(docs, id_col, text_col).mapInPandas(_marks_and_counts(words, None), _MARKS), "shingle-marks")
    return _marks_of(both), _counts_of(both)


def _marks_of(both: DataFrame) -> DataFrame:
    return both.filter("block is null and shard is null").select("doc_id", "n_shingles", "mark")


def _counts_of(both: DataFrame) -> np.ndarray:
    counts = np.zeros((1 << (SLOT_BITS - BLOCK_BITS), 1 << BLOCK_BITS), np.int64)
    with freeing_shuffles(both.sparkSession):
        parts = both.filter("block is not null").select("block", "counts").repartition("block").sortWithinPartitions("block")
        for row in parts.mapInPandas(_summed, "block int, counts binary").collect():
            counts[row.block] = np.frombuffer(row.counts, np.int64)
    return np.minimum(counts.ravel(), 2**32 - 1).astype(np.uint32)


def _repeats_of(both: DataFrame, shingles: int) -> np.ndarray:
    """``may_repeat``'s table, of a size that follows the corpus up to a bound; a table that is too small lets more keys pass."""
    bits = min(MOST_REPEAT_BITS, max(SHARD_BITS + 3, int(shingles).bit_length())) - SHARD_BITS
    table = np.zeros((1 << SHARD_BITS, 1 << bits >> 3), np.uint8)
    with freeing_shuffles(both.sparkSession):
        parts = both.filter("shard is not null").select("shard", "keys").repartition("shard").sortWithinPartitions("shard")
        for row in parts.mapInPandas(_repeated(bits), "shard int, bits binary").collect():
            table[row.shard] = np.frombuffer(row.bits, np.uint8)
    return table.ravel()


PIECE = 2  # role of rows in piece lists; rows of subset lists have 0 or 1


def _list_keys(measure: Measure, boundary: int, words: int, common: np.ndarray, repeats: np.ndarray):
    """Rows ``key, role, mark`` of every set, without pieces that no other set has.  A task gives equal sets it has just seen once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for b in batches:
            marks, keys, roles, held = [], [], [], 0
            for text in b["text"]:
                s = shingle_set(text, words)
                mark = mark_of(s)
                if not len(s) or mark in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(mark)
                kinds = [subset_keys(s, measure, boundary)] if len(s) <= measure.largest(boundary) else []
                if len(s) > boundary:
                    k = piece_keys(s, measure, boundary, common)
                    k = k[may_repeat(k, repeats)]
                    kinds.append((k, np.full(len(k), PIECE, np.int8)))
                for k, role in kinds:
                    marks.append(np.full(len(k), mark, np.int64)), keys.append(k), roles.append(role)
                    held += len(k)
                if held > 500_000:
                    yield _list_frame(marks, keys, roles)
                    marks, keys, roles, held = [], [], [], 0
            if held:
                yield _list_frame(marks, keys, roles)
    return run


def _list_frame(marks, keys, roles) -> pd.DataFrame:
    return pd.DataFrame({"key": np.concatenate(keys).view(np.int64), "role": np.concatenate(roles), "mark": np.concatenate(marks)})


def _first_of_list(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows arrive sorted by list, role and mark; each member is tied to the first one of its list, whatever the list's length.

    Ties of subset lists are links (``sure``) if the first one has the smaller side's role.
    """
    key = first = first_role = None
    for b in batches:
        k, role, mark = b["key"].to_numpy(), b["role"].to_numpy(), b["mark"].to_numpy()
        if not len(k):
            continue
        new = np.concatenate([[key is None or k[0] != key], k[1:] != k[:-1]])
        owner = np.concatenate([[mark[0] if first is None else first], mark[new]])[np.cumsum(new)]
        owner_role = np.concatenate([[role[0] if first is None else first_role], role[new]])[np.cumsum(new)]
        tied = (owner != mark) & (owner_role != 1)
        if tied.any():
            yield pd.DataFrame({"sure": role[tied] != PIECE, "a": owner[tied], "b": mark[tied]}).drop_duplicates()
        key, first, first_role = k[-1], owner[-1], owner_role[-1]


def _tile_links(measure: Measure, words: int):
    """Links within a tile as a spanning forest; counts come from products of 0/1 matrices over shared shingles."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["side", "n_shingles", "mark"]).drop_duplicates("mark")
        ids, n, side = (group[c].to_numpy(np.int64) for c in ("mark", "n_shingles", "side"))
        flat = np.concatenate([shingle_set(t, words) for t in group["text"]])
        owner = np.repeat(np.arange(len(ids)), n)
        _, token, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count[token] > 1
        owner, token = owner[shared], np.unique(token[shared], return_inverse=True)[1]
        starts = np.searchsorted(owner, np.arange(len(ids) + 1))
        found, width = [], int(token.max()) + 1 if len(token) else 0
        step, strip = 256, 8192
        for s in range(0, len(ids), step):
            for t in range(s, len(ids), step):
                a, b = slice(s, min(s + step, len(ids))), slice(t, min(t + step, len(ids)))
                if side[a][0] == 1 and side[b][0] == 1:
                    continue  # both wholly in the second block: its own tile does it
                total = np.zeros((a.stop - a.start, b.stop - b.start), np.float32)
                for lo in range(0, width, strip):
                    sides = []
                    for part in (a, b):
                        rows = slice(starts[part.start], starts[part.stop])
                        tok, own = token[rows], owner[rows] - part.start
                        here = (tok >= lo) & (tok < lo + strip)
                        m = np.zeros((part.stop - part.start, min(strip, width - lo)), np.float32)
                        m[own[here], tok[here] - lo] = 1
                        sides.append(m)
                    total += sides[0] @ sides[1].T
                x, y = n[a][:, None], n[b][None, :]
                i, j = np.nonzero(100 * total.astype(np.int64) >= measure.percent * (x + y - total.astype(np.int64)))
                i, j = i + s, j + t
                ahead = i < j
                if ahead.any():
                    found.append(local_forest(ids[i[ahead]], ids[j[ahead]]))
        if not found:
            return pd.DataFrame({"a": [], "b": []})
        b, a = local_forest(*map(np.concatenate, zip(*found)))
        return pd.DataFrame({"a": a, "b": b})
    return run


def jaccard_components(docs: DataFrame, percent: int = 90, words: int = 3, id_col: str = "doc_id", text_col: str = "text",
                       block_shingles: int = 400_000, pivots: int = 16) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id`` of every row.

    Rows with null or empty text have no shingles and link with nothing, nor do
    rows without an id.  Repeated rows and equal sets share a class, named by its
    smallest id; no link between different sets is left out.  Shingles and whole
    sets are told apart by 64-bit hashes.  Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    measure = Measure(percent)
    named = _texts(docs, id_col, text_col)
    with scratch(spark) as keep:
        both = stored(named.mapInPandas(_marks_and_counts(words, measure), _MARKS), "marks-and-keys")
        marks, counts = keep(_marks_of(both), "shingle-marks"), _counts_of(both)
        common, repeats = common_slots(counts), _repeats_of(both, int(counts.sum(dtype=np.int64)))
    with scratch(spark) as keep:
        classes = keep(marks.filter("n_shingles > 0 and doc_id is not null").groupBy("mark", "n_shingles").agg(F.min("doc_id").alias("class_id")), "shingle-classes")
        small = {r["n_shingles"]: r["count"] for r in classes.filter("n_shingles <= 64").groupBy("n_shingles").count().collect()}  # 64 rows at most
        boundary = choose_boundary(measure, small)

        named = named.filter("doc_id is not null")
        lists = named.select("text").mapInPandas(_list_keys(measure, boundary, words, common, repeats), "key long, role byte, mark long")
        ties = stored(lists.repartition("key").sortWithinPartitions("key", "role", "mark").mapInPandas(_first_of_list, "sure boolean, a long, b long").distinct(), "list-ties")
        clusters = connected_components(ties.filter("not sure").select("a", "b"), "list-clusters").select(F.col("node").alias("mark"), F.col("component").alias("cluster"))
        members = stored(classes.join(clusters, "mark").select("mark", "n_shingles", "cluster", F.col("class_id").alias("member_id")), "cluster-members")
        links = _cluster_links(members, named, measure, words, block_shingles, pivots).unionByName(ties.filter("sure").select("a", "b"))
        # components go by marks; their name is the smallest id of their classes
        parts = keep(connected_components(links, "shingle-components").withColumnRenamed("node", "mark"), "mark-components")
    joined = classes.join(parts, "mark", "left").withColumn("component", F.coalesce("component", "mark"))
    names = joined.groupBy("component").agg(F.min("class_id").alias("component_id"))
    of_class = joined.join(names, "component").select(F.col("mark").alias("c_mark"), F.col("n_shingles").alias("c_n"), "class_id", "component_id")
    own = (F.col("mark") == F.col("c_mark")) & (F.col("n_shingles") == F.col("c_n")) & F.col("doc_id").isNotNull()
    return marks.join(of_class, own, "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"))


def _texts_at(seats: DataFrame, members: DataFrame, named: DataFrame, words: int) -> DataFrame:
    """``mark, n_shingles, tile, side, text`` of seats ``mark, tile, side``: a text goes by its id once, then to its tiles.

    A tile's side is the last bit of the number that travels.  An id may come with several texts, of
    which the one with the mark is taken, and with repeated rows, of which a task gives those it has just seen once.
    """
    number = F.col("tile").bitwiseAND(F.lit(-2).cast("long")).bitwiseOR(F.col("side").cast("long"))
    wanted = members.join(seats.groupBy("mark").agg(F.collect_set(number).alias("at")), "mark").select("member_id", "mark", "n_shingles", "at")

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for b in batches:
            good = np.zeros(len(b), bool)
            for i, (mark, text) in enumerate(zip(b["mark"], b["text"])):
                if mark not in seen and mark_of(shingle_set(text, words)) == mark:
                    good[i] = True
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(mark)
            yield b[good]
    found = named.join(wanted, F.col("doc_id") == F.col("member_id")).select("mark", "n_shingles", "at", "text").mapInPandas(
        fetch, "mark long, n_shingles long, at array<long>, text string")
    return found.select("mark", "n_shingles", F.explode("at").alias("tile"), "text").select(
        "mark", "n_shingles", F.col("tile").bitwiseAND(F.lit(-2).cast("long")).alias("tile"), F.col("tile").bitwiseAND(F.lit(1).cast("long")).alias("side"), "text")


def _cluster_links(members: DataFrame, named: DataFrame, measure: Measure, words: int, block_shingles: int, pivots: int) -> DataFrame:
    tile = _tile_links(measure, words)
    slim = members.select("mark", "n_shingles", "cluster")
    content = slim.groupBy("cluster").agg(F.sum("n_shingles").alias("content"))
    blocks = F.ceil(F.col("content") / block_shingles).cast("long")
    dealt = slim.join(content, "cluster").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("mark"), F.col("blocks")))
    # round 1: every block with itself and, where a cluster has several, with common pivots
    ranked = dealt.filter("blocks > 1").withColumn("place", F.row_number().over(W.partitionBy("cluster").orderBy(F.xxhash64("mark", F.lit(1)), "mark"))).filter(F.col("place") <= pivots)
    shared = ranked.select("mark", "cluster", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    seats = dealt.select("mark", "cluster", "block").unionByName(shared).select("mark", F.xxhash64("cluster", "block").alias("tile"), F.lit(0).alias("side"))
    first = stored(_texts_at(seats, members, named, words).groupBy("tile").applyInPandas(tile, "a long, b long"), "tiles-own")
    large = stored(dealt.filter("blocks > 1").select("mark", "n_shingles", "cluster"), "large-clusters")
    if large.isEmpty():
        return first
    # round 2: blocks of what is still apart; a component of more than a block's content keeps to its own blocks
    parts = connected_components(first, "tile-components").select(F.col("node").alias("mark"), "component")
    known = large.join(parts, "mark", "left").withColumn("component", F.coalesce("component", "mark"))
    weight = known.groupBy("cluster", "component").agg(F.sum("n_shingles").alias("weight")).withColumn("own", F.when(F.col("weight") > block_shingles, F.col("component")).otherwise(F.lit(-1)))
    known = known.join(weight.select("cluster", "component", "own"), ["cluster", "component"])
    sums = known.groupBy("cluster", "own").agg(F.ceil(F.sum("n_shingles") / block_shingles).cast("long").alias("blocks"))
    known = stored(known.join(sums, ["cluster", "own"]).select("mark", "cluster", "own", F.pmod(F.xxhash64("mark", F.lit(2)), F.col("blocks")).alias("block"), "n_shingles"), "second-blocks")
    seats = known.groupBy("cluster", "own", "block").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"))
    one, two = (seats.select("cluster", *[F.col(c).alias(f"{c}{k}") for c in ("own", "block", "low", "high")]) for k in (1, 2))
    order = F.struct("own1", "block1") <= F.struct("own2", "block2")
    apart = (F.col("own1") != F.col("own2")) | (F.col("own1") == -1)
    near = (100 * F.col("high1") >= measure.percent * F.col("low2")) & (100 * F.col("high2") >= measure.percent * F.col("low1"))
    pairs = one.join(two, "cluster").filter(order & apart & near).withColumn("tile", F.xxhash64("cluster", "own1", "block1", "own2", "block2"))
    sides = pairs.select("tile", "cluster", F.col("own1").alias("own"), F.col("block1").alias("block"), F.lit(0).alias("side")).unionByName(
        pairs.filter("own1 <> own2 or block1 <> block2").select("tile", "cluster", F.col("own2").alias("own"), F.col("block2").alias("block"), F.lit(1).alias("side")))
    seats = sides.join(known.drop("n_shingles"), ["cluster", "own", "block"]).select("mark", "tile", "side")
    second = _texts_at(seats, members, named, words).groupBy("tile").applyInPandas(tile, "a long, b long")
    return first.unionByName(stored(second, "tiles-across"))


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id names their component, with their own columns."""
    kept = jaccard_components(docs, id_col=id_col, text_col=text_col, **how).filter("doc_id <=> component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = nested(docs, doc_id=F.col(f"`{id_col}`").cast("long"))
    return rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").select("row.*")
