"""Near-duplicate embeddings by PCA-ordered tiles.

Equal vectors are merged first.  The rest is rotated onto the eigenvectors of
its second moments, strongest first, which keeps every cosine and puts most of
it into the leading dimensions.  A k-d split of those dimensions deals the
vectors to leaves; two leaves meet only if their boxes come close enough.  A
tile adds up leading dimensions, bounds what is left by the product of the
suffix norms, and drops pairs that cannot reach the threshold; what survives all
dimensions is decided in double precision on the original components.
A task reports counts and a spanning forest of its links, never all its pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.llm.graph import connected_components, local_forest
from hazeframe.llm.tables import ship, stored

TILE = 512


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; first scaled by a power of two (exactly), so that squares of extreme components neither overflow nor vanish."""
    if not x.size:
        return x
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def slack(d: int) -> float:
    """Bound of the error that single precision brings into a bound on the cosine of rows of length ``d``.

    Rotating a unit row is off by at most ``(d + 2) sqrt(d)`` roundings in
    length, on both sides; sums and suffix norms add less than as much again.
    Decisions are in double precision.
    """
    return 3 * (d + 4) * np.sqrt(d) * 2.0 ** -24


@dataclass
class Splits:
    """A k-d tree over leading dimensions: node i splits ``dim[i]`` at ``cut[i]``; children 2i+1 and 2i+2."""
    dim: np.ndarray
    cut: np.ndarray
    depth: int

    def leaf(self, y: np.ndarray) -> np.ndarray:
        node = np.zeros(len(y), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (y[np.arange(len(y)), self.dim[node]] > self.cut[node])
        return node - (2 ** self.depth - 1)


def fit_splits(sample: np.ndarray, depth: int, dims: int) -> Splits:
    dim, cut, parts = np.zeros(max(1, 2 ** depth - 1), np.int64), np.zeros(max(1, 2 ** depth - 1)), {0: sample}
    for node in range(2 ** depth - 1):
        part = parts.pop(node)
        spread = part[:, :dims].std(axis=0) if len(part) else np.zeros(dims)
        dim[node] = int(spread.argmax())
        cut[node] = float(np.median(part[:, dim[node]])) if len(part) else 0.0
        low = part[:, dim[node]] <= cut[node] if len(part) else np.zeros(0, bool)
        parts[2 * node + 1], parts[2 * node + 2] = part[low], part[~low]
    return Splits(dim, cut, depth)


def close_pairs(x: np.ndarray, y: np.ndarray, turned_x: np.ndarray, turned_y: np.ndarray, threshold: float, step: int = 16):
    """Index pairs with cosine >= threshold, given unit rows and their rotated copies (single precision)."""
    d = turned_x.shape[1]
    least = threshold - slack(d)
    ends = list(range(step, d, step)) + [d]
    left_x, left_y = suffix_norms(turned_x, ends), suffix_norms(turned_y, ends)
    done = ends[0]
    sums = turned_x[:, :done] @ turned_y[:, :done].T
    i, j = np.nonzero(sums + np.outer(left_x[0], left_y[0]) >= least)
    sums = sums[i, j]
    for k, end in enumerate(ends[1:], 1):
        if not len(i):
            break
        sums = sums + np.einsum("nd,nd->n", turned_x[i, done:end], turned_y[j, done:end])
        keep = sums + left_x[k][i] * left_y[k][j] >= least
        i, j, sums, done = i[keep], j[keep], sums[keep], end
    if len(i):
        exact = np.einsum("nd,nd->n", x[i], y[j]) >= threshold
        i, j = i[exact], j[exact]
    return i, j


def suffix_norms(y: np.ndarray, ends: list[int]) -> list[np.ndarray]:
    return [np.sqrt((y[:, e:].astype(np.float64) ** 2).sum(axis=1)).astype(np.float32) for e in ends]


def _unpack(column: pd.Series, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(-1, d)


def usable_vectors(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, key, usable`` per row; the key is the vector itself."""
    rows = embeddings.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("key"))
    fine = (F.size("key") > 0) & F.forall("key", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists("key", lambda c: c != 0)
    return rows.withColumn("usable", F.coalesce(F.col("vec_id").isNotNull() & F.col("key").isNotNull() & fine, F.lit(False)))


def embedding_duplicates(embeddings: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding",
                         leaf_rows: int = 6144, most_leaves: int = 1024, sample_rows: int = 50_000, lead: int = 8) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Null, zero and non-finite vectors and rows without an id link with nothing;
    vectors are compared with those of their own length, components of any
    finite size count.  Repeated rows are vectors of their own and link with
    each other.  An empty table gives no rows; other columns are ignored.  The k-d tree is
    fitted on ``sample_rows`` vectors at most and has ``most_leaves`` leaves at
    most; fuller leaves are dealt to several parts, so nothing is left out.
    """
    ship(embeddings.sparkSession)
    rows = usable_vectors(embeddings, id_col, vector_col)
    vectors = stored(rows.filter("usable").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
                     .withColumn("d", F.size("key")), "vectors")
    found = [_links_of_length(vectors.filter(F.col("d") == r["d"]), r["d"], r["n"], threshold, leaf_rows, most_leaves, sample_rows, lead)
             for r in vectors.groupBy("d").agg(F.count("*").alias("n")).filter("n > 1").orderBy("d").collect()]  # one row per vector length
    if found:
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        out = stored(out, "vector-links")
        degrees = out.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
        parts = connected_components(out.filter("b is not null").select("a", "b"), "vector-components").withColumnRenamed("node", "rep")
        vectors = vectors.join(degrees, "rep", "left").join(parts, "rep", "left")
    else:
        vectors = vectors.withColumns({"links": F.lit(0).cast("long"), "component": F.lit(None).cast("long")})
    classes = vectors.select("key", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("links"), F.coalesce("component", "rep").alias("component"))
    linked = rows.filter("usable").join(classes, "key").select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links_of_length(vectors: DataFrame, d: int, n: int, threshold: float, leaf_rows: int, most_leaves: int, sample_rows: int, lead: int) -> DataFrame:
    spark = vectors.sparkSession

    def moments(batches):
        total = np.zeros((d, d))
        for b in batches:
            x = unit_rows(np.stack(b["key"].to_numpy())) if len(b) else np.zeros((0, d))
            total += x.T @ x
        yield pd.DataFrame({"m": [total.tobytes()]})
    total = np.zeros((d, d))
    for row in vectors.select("key").mapInPandas(moments, "m binary").toLocalIterator():
        total += np.frombuffer(row["m"], np.float64).reshape(d, d)
    axes = np.linalg.eigh(total)[1][:, ::-1]
    depth = int(np.clip(np.ceil(np.log2(max(1, n / leaf_rows))), 0, np.log2(most_leaves)))
    lead = min(lead, d)
    sample = vectors.select("key").orderBy(F.xxhash64("rep")).limit(min(sample_rows, 64 * 2 ** depth))
    some = np.array([r["key"] for r in sample.collect()])
    tree = fit_splits(unit_rows(some) @ axes, depth, lead)
    given = spark.sparkContext.broadcast((axes, tree))

    def place(batches):
        axes, tree = given.value
        for b in batches:
            if len(b):
                x = unit_rows(np.stack(b["key"].to_numpy()))
                y = x @ axes
                yield pd.DataFrame({"rep": b["rep"], "copies": b["copies"], "x": [r.tobytes() for r in x], "leaf": tree.leaf(y), "lead": list(y[:, :lead])})
    placed = stored(vectors.select("rep", "copies", "key").mapInPandas(place, "rep long, copies long, x binary, leaf int, lead array<double>"), "placed")
    boxes = placed.groupBy("leaf").agg(F.count("*").alias("n"), *[f(F.col("lead")[k]).alias(f"{name}{k}") for k in range(lead) for name, f in (("low", F.min), ("high", F.max))])
    found = boxes.orderBy("leaf").collect()  # at most ``most_leaves`` rows
    low, high = (np.array([[r[f"{name}{k}"] for k in range(lead)] for r in found]) for name in ("low", "high"))
    parts = [-(-r["n"] // (2 * leaf_rows)) for r in found]
    reach = 2 - 2 * threshold + 1e-9  # squared distance of unit vectors at the threshold
    meetings = []
    for i, a in enumerate(found):
        gap = np.maximum(0, np.maximum(low[i] - high[i:], low[i:] - high[i]))
        for j in np.flatnonzero((gap * gap).sum(axis=1) <= reach) + i:
            for p in range(parts[i]):
                for q in range(p if j == i else 0, parts[j]):
                    one = (a["leaf"], p), (found[j]["leaf"], q)
                    task = f"{one[0][0]}.{p}-{one[1][0]}.{q}"
                    meetings += [(task, *side, k) for k, side in enumerate(one[:1] if one[0] == one[1] else one)]
    of_leaf = spark.createDataFrame([(r["leaf"], n) for r, n in zip(found, parts)], "leaf int, parts int")
    tasks = spark.createDataFrame(meetings, "task string, leaf int, part long, side int")
    dealt = (placed.drop("lead").join(of_leaf, "leaf").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts"))).join(tasks, ["leaf", "part"])
             .select("task", "side", "rep", "copies", "x"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        axes = given.value[0].astype(np.float32)
        group = group.sort_values(["side", "rep"])
        ids, copies, side = (group[c].to_numpy(np.int64) for c in ("rep", "copies", "side"))
        x = _unpack(group["x"], d)
        turned = x.astype(np.float32) @ axes
        same = side[-1] == 0
        first = np.flatnonzero(side == 0)
        second = first if same else np.flatnonzero(side == 1)
        count, roots = np.zeros(len(ids), np.int64), []
        for s in range(0, len(first), TILE):
            a = first[s:s + TILE]
            for t in range(s if same else 0, len(second), TILE):
                b = second[t:t + TILE]
                i, j = close_pairs(x[a], x[b], turned[a], turned[b], threshold)
                i, j = a[i], b[j]
                if same:
                    ahead = i < j
                    i, j = i[ahead], j[ahead]
                if len(i):
                    np.add.at(count, i, copies[j])
                    np.add.at(count, j, copies[i])
                    roots.append(local_forest(ids[i], ids[j]))
        linked = np.flatnonzero(count)
        node, root = local_forest(*map(np.concatenate, zip(*roots))) if roots else (np.zeros(0, np.int64),) * 2
        return pd.concat([pd.DataFrame({"a": ids[linked], "n": count[linked]}), pd.DataFrame({"a": node, "b": root})]).astype({"b": "Int64", "n": "Int64"}) \
            if roots else pd.DataFrame({"a": [], "b": [], "n": []})
    return dealt.groupBy("task").applyInPandas(compare, "a long, b long, n long")
