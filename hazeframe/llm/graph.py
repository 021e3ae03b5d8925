"""Connected components of link tables, by rounds of joins over stored edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.llm.tables import ship, stored


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable) for the non-smallest nodes of these links."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    member = root != np.arange(len(nodes))
    return nodes[member], nodes[root[member]]


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of one task, contracted in runs of bounded size."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append((batch["node"].to_numpy(np.int64), batch["root"].to_numpy(np.int64)))
        rows += len(batch)
        if rows > 2_000_000:
            node, root = local_forest(*map(np.concatenate, zip(*held)))
            yield pd.DataFrame({"node": node, "root": root})
            held, rows = [], 0
    if held:
        node, root = local_forest(*map(np.concatenate, zip(*held)))
        yield pd.DataFrame({"node": node, "root": root})


def connected_components(links: DataFrame, purpose: str, most_rounds: int = 60) -> DataFrame:
    """``node, component`` (its smallest node) for every node of ``links(a, b)``; nodes without links do not appear.

    Each round gathers the links of a node by the node itself (never by its
    root, which may be shared by a third of all nodes), contracts them within
    the tasks, and lets every root jump to its own root.
    """
    ship(links.sparkSession)
    schema = "node long, root long"
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).mapInPandas(_contract, schema)
    for number in range(most_rounds):
        edges = stored(edges.repartition("node").mapInPandas(_contract, schema), f"{purpose}-{number}")
        up = edges.groupBy(F.col("node").alias("up_node")).agg(F.min("root").alias("up_root"), F.max("root").alias("other"))
        open_ends = up.filter("up_root <> other").select(F.lit(1).alias("x")).unionAll(
            up.select("up_root").distinct().join(up.select("up_node"), F.col("up_root") == F.col("up_node"), "left_semi").select(F.lit(1).alias("x")))
        if open_ends.isEmpty():
            return edges.select("node", F.col("root").alias("component")).unionByName(
                edges.select(F.col("root").alias("node"), F.col("root").alias("component")).distinct())
        edges = edges.join(up.select("up_node", "up_root"), F.col("root") == F.col("up_node"), "left").select(
            "node", F.coalesce("up_root", "root").alias("root")).unionByName(
            up.filter("up_root <> other").select(F.col("other").alias("node"), F.col("up_root").alias("root")))
    raise RuntimeError(f"components did not settle within {most_rounds} rounds")
