"""Prefix trie of conversations by fixed-length block hashing.

Every turn adds a hash of its digest and depth to a running sum, so the sum up
to a depth names the whole sequence so far.  Conversations are cut into blocks
of a fixed number of turns and grouped by the names at the block ends only:
that is the wide step, and it moves one row per block instead of one per turn.
Where the conversations that share a prefix go on with one and the same block,
the turns inside need no comparison.  Only blocks with siblings are opened, once
per distinct block and not per conversation, and grouped again turn by turn.

Subtree sums climb block by block in doubling steps: the sum below a block end
first covers one block, then two, four and so on.  Inside a block every node
adds itself to its at most ``block`` ancestors.

Names are two sums of 60 bits over SHA-256 digests (120 bits together).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeframe.llm.running import look_up, running_sums
from hazeframe.llm.tables import WORD, ship, stored, text_or_empty

#: Names are sums modulo this; eight of them fit into a long.
MODULUS = 1 << 60
#: Ends of a node are joined to texts by ranges of so many ids (a power of two).
ID_BITS = 8
NODE = ["depth", "a", "b"]


def turn_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, place, ta, tb, words``: every turn at its place (from 1), as the digest of role and text.

    Turns go by turn number, null first, equal numbers by digest.  Null role and
    text are empty.  Rows without a conversation id belong to none and are left out.
    """
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    digest = F.sha2(F.concat_ws(":", F.length(role), role, text), 256)
    rows = conversations.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), digest.alias("digest"),
                                F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.lit(1).cast("long").alias("one")).filter("conv_id is not null")
    rows = running_sums(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest")], ["one"], "trie-turns")

    def lane(at: int) -> Column:
        return F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    return rows.select("conv_id", (F.col("before_one") + 1).alias("place"), lane(1).alias("ta"), lane(16).alias("tb"), "words")


def rebuilt_turns(rows: DataFrame, family: int = 20, most_heads: int = 4) -> DataFrame:
    """``conv_id, part, place, ...``: each conversation c begins with the first h turns of ``c - c % family``.

    h is the CRC-32 of the decimal id modulo ``most_heads``; the own turns follow
    after the first h.  Part 0 are the borrowed turns, part 1 the own ones.
    """
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_heads
    own = rows.filter(F.col("place") > heads).withColumn("part", F.lit(1))
    convs = rows.select("conv_id").distinct().withColumn("h", heads).withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    first = rows.filter((F.col("place") < most_heads) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "base")
    borrowed = convs.join(first, "base").filter("place <= h").withColumn("part", F.lit(0))
    return own.unionByName(borrowed.drop("base", "h"))


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """``conv_id, k, len, qa, qb, pa, pb, fa1.., fb1.., w1..``: blocks with the names before (q) and behind (p) them."""
    ordered = turns.withColumnRenamed("part", "side").withColumn("one", F.lit(1).cast("long"))
    ordered = running_sums(ordered, "conv_id", [F.col("side"), F.col("place")], ["one"], "trie-rebuilt")
    depth = F.col("before_one") + 1
    rows = ordered.select("conv_id", F.expr(f"before_one div {block}").alias("k"), (F.col("before_one") % block + 1).alias("slot"), "words", *[
        F.pmod(F.xxhash64(F.lit(n), "ta", "tb", depth), F.lit(MODULUS)).alias(f) for n, f in ((1, "fa"), (2, "fb"))])
    slots = [F.max(F.when(F.col("slot") == i, F.col(c))).alias(f"{c}{i}") for c in ("fa", "fb", "words") for i in range(1, block + 1)]
    # exact sums: a block adds less than 2^63, and decimals hold any number of blocks
    sums = [F.sum(f).cast("decimal(20,0)").alias(f"{f}_sum") for f in ("fa", "fb")]
    blocks = rows.groupBy("conv_id", "k").agg(F.count("*").alias("len"), *sums, *slots)
    blocks = running_sums(blocks, "conv_id", [F.col("k")], ["fa_sum", "fb_sum"], "trie-blocks")
    names = {name: (before % MODULUS).cast("long") for name, before in (
        ("qa", F.col("before_fa_sum")), ("qb", F.col("before_fb_sum")), ("pa", F.col("before_fa_sum") + F.col("fa_sum")), ("pb", F.col("before_fb_sum") + F.col("fb_sum")))}
    return blocks.withColumns(names).drop("before_fa_sum", "before_fb_sum", "fa_sum", "fb_sum")


def _opened(blocks: DataFrame, block: int) -> DataFrame:
    """One row per turn of distinct blocks: a node with its parent (u), block start (q) and ancestors within the block (x)."""
    def name(lane: str, i: int) -> Column:
        parts = [F.col(f"q{lane}")] + [F.col(f"f{lane}{s}") for s in range(1, i + 1)]
        return reduce(lambda x, y: x + y, parts) % MODULUS
    turns = []
    for i in range(1, block + 1):
        path = [(name(lane, s) if s <= i else F.lit(None).cast("long")).alias(f"x{lane}{s}") for s in range(1, block + 1) for lane in "ab"]
        turns.append(F.struct((F.col("k") * block + i).alias("depth"), name("a", i).alias("a"), name("b", i).alias("b"), name("a", i - 1).alias("ua"),
                              name("b", i - 1).alias("ub"), F.col(f"words{i}").alias("words"), *path))
    return blocks.select("k", "qa", "qb", "n_convs", "conv_id", F.explode(F.slice(F.array(*turns), 1, F.col("len").cast("int"))).alias("t")).select(
        "k", "qa", "qb", "n_convs", "conv_id", "t.*")


def _nodes(blocks: DataFrame, block: int) -> DataFrame:
    """All nodes but the root."""
    slots = [c for c in blocks.columns if c not in ("conv_id", "k", "qa", "qb", "pa", "pb")]
    distinct = stored(blocks.groupBy("k", "qa", "qb", "pa", "pb").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *[F.max(c).alias(c) for c in slots]), "trie-distinct-blocks")
    rest = [c for c in distinct.columns if c not in ("k", "qa", "qb")]
    alone = distinct.groupBy("k", "qa", "qb").agg(F.count("*").alias("siblings"), *[F.min(c).alias(c) for c in rest]).filter("siblings = 1").drop("siblings")
    diverging = distinct.join(alone.select("k", "pa", "pb"), ["k", "pa", "pb"], "left_anti")
    opened = _opened(diverging, block)
    others = [c for c in opened.columns if c not in (*NODE, "n_convs", "conv_id")]
    merged = opened.groupBy(*NODE).agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), *[F.max(c).alias(c) for c in others])
    return _opened(alone, block).unionByName(merged)


def _below(nodes: DataFrame, block: int) -> DataFrame:
    """``depth, a, b, saved, leaves`` strictly below the root and every node at a block end."""
    region = nodes.groupBy((F.col("k") * block).alias("depth"), F.col("qa").alias("a"), F.col("qb").alias("b")).agg(F.sum("own").alias("saved"), F.sum("leaf").alias("leaves"))
    at_end = nodes.filter(F.col("depth") % block == 0).select(*NODE, F.col("qa").alias("ya"), F.col("qb").alias("yb"))
    root = nodes.sparkSession.range(1).select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"),
                                              F.lit(None).cast("long").alias("ya"), F.lit(None).cast("long").alias("yb"))
    zero = F.lit(0).cast("long")
    sums = stored(at_end.unionByName(root).join(region, NODE, "left").withColumns({c: F.coalesce(c, zero) for c in ("saved", "leaves")}), "trie-below-1")
    deepest, total = sums.agg(F.max("depth"), F.count("*")).first()
    step = block
    while step <= deepest:
        up = sums.filter("ya is not null").select((F.col("depth") - step).alias("depth"), F.col("ya").alias("a"), F.col("yb").alias("b"), "saved", "leaves")
        more = up.groupBy(*NODE).agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"), F.count("*").alias("n"))
        higher = sums.select(F.col("depth").alias("ydepth"), F.col("a").alias("ya"), F.col("b").alias("yb"), F.col("ya").alias("za"), F.col("yb").alias("zb"))
        grown = sums.join(more, NODE, "left").select(
            *NODE, "ya", "yb", (F.col("depth") - step).alias("ydepth"), (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"), (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("leaves"))
        counts = more.select(F.col("depth").alias("ydepth"), F.col("a").alias("ya"), F.col("b").alias("yb"), "n")
        sums = stored(look_up(grown, higher, ["ydepth", "ya", "yb"], counts, total, "trie-hot-ends").select(
            *NODE, F.col("za").alias("ya"), F.col("zb").alias("yb"), "saved", "leaves"), f"trie-below-{2 * step // block}")
        step *= 2
    return sums.select(*NODE, "saved", "leaves")


def _chained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digest of the comma-joined pieces of every node; pieces arrive in order and are not kept."""
    node, state = None, None
    for b in batches:
        done = []
        for key, text in zip(b[NODE].itertuples(index=False, name=None), b["ids"]):
            if key != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pd.DataFrame(done, columns=[*NODE, "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(*node, state.hexdigest())], columns=[*NODE, "ends_sha256"])


def _ends_digests(ends: DataFrame) -> DataFrame:
    """``depth, a, b, ends_sha256`` of nodes where conversations end.

    Ids come as texts of at most ``2 ** ID_BITS`` neighbouring ids.  A digest takes
    its bytes in order, so the texts of one node pass through one task, as a stream.
    """
    pieces = stored(ends.groupBy(*NODE, F.shiftright("conv_id", ID_BITS).alias("range")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids")), "trie-ends")
    ship(ends.sparkSession)
    nodes = pieces.groupBy(*NODE).agg(F.count("*").alias("n"), F.min("range").alias("range"))
    single = pieces.join(nodes.filter("n = 1").drop("n"), [*NODE, "range"]).select(*NODE, F.sha2("ids", 256).alias("ends_sha256"))
    many = pieces.join(nodes.filter("n > 1").select(*NODE), NODE, "left_semi")
    chained = many.repartition(*NODE).sortWithinPartitions(*NODE, "range").mapInPandas(_chained, "depth long, a long, b long, ends_sha256 string")
    return single.unionByName(chained)


def trie_of(turns: DataFrame, convs: DataFrame, block: int = 4) -> DataFrame:
    """The nodes over ``turns`` (``conv_id, part, place, ta, tb, words``) of the conversations ``convs`` (``conv_id``)."""
    if not 2 <= block <= 7:
        raise ValueError("a block has 2 to 7 turns: eight names must fit into a long")
    blocks = stored(_blocks(turns, block), "trie-named-blocks")
    nodes = stored(_nodes(blocks, block), "trie-nodes")
    zero, end_depth = F.lit(0).cast("long"), (F.col("k") * block + F.col("len")).alias("depth")
    last = blocks.groupBy("conv_id").agg(F.max("k").alias("k"))
    ends = blocks.join(last, ["conv_id", "k"]).select("conv_id", end_depth, F.col("pa").alias("a"), F.col("pb").alias("b"))
    ends = ends.unionByName(convs.join(last, "conv_id", "left_anti").select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b")))

    up = nodes.withColumn("udepth", F.col("depth") - 1)
    children = stored(up.groupBy("udepth", "ua", "ub").agg(F.count("*").alias("n")), "trie-children")
    of_node = children.select(F.col("udepth").alias("depth"), F.col("ua").alias("a"), F.col("ub").alias("b"), F.col("n").alias("n_children"))
    nodes = stored(nodes.join(of_node, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)).withColumns({
        "own": (F.col("n_convs") - 1) * F.col("words"), "leaf": (F.col("n_children") == 0).cast("long")}), "trie-counted-nodes")
    below = _below(nodes, block)

    # every node, with all that lies below it if it ends a block, adds itself to its ancestors in the block
    whole = nodes.join(below, NODE, "left").withColumns({"own": F.col("own") + F.coalesce("saved", zero), "leaf": F.col("leaf") + F.coalesce("leaves", zero)})
    steps = F.array(*[F.struct((F.col("k") * block + i).alias("depth"), F.col(f"xa{i}").alias("a"), F.col(f"xb{i}").alias("b")) for i in range(1, block + 1)])
    above = whole.select("own", "leaf", F.explode(F.slice(steps, 1, (F.col("depth") - F.col("k") * block).cast("int"))).alias("x"))
    sums = above.groupBy("x.depth", "x.a", "x.b").agg(F.sum("own").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    rows = nodes.select(*NODE, "conv_id", "n_convs", "n_children", (F.col("depth") - 1).alias("udepth"), "ua", "ub").join(sums, NODE)

    is_root = (F.col("depth") == 0) & (F.col("a") == 0) & (F.col("b") == 0)
    root = (convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").withColumns({c: zero for c in NODE})
            .join(of_node.filter("depth = 0"), NODE, "left").join(below.filter(is_root).withColumnsRenamed({"saved": "saved_tokens", "leaves": "n_leaves"}), NODE, "left")
            .withColumns({"n_children": F.coalesce("n_children", zero), "n_leaves": F.greatest("n_leaves", F.lit(1)), "parent_conv_id": F.lit(None).cast("long")}))
    parents = rows.select(F.col("depth").alias("udepth"), F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("conv_id").alias("parent_conv_id")).unionByName(
        root.select(F.col("depth").alias("udepth"), F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("conv_id").alias("parent_conv_id")))
    rows = look_up(rows, parents, ["udepth", "ua", "ub"], children, nodes.count(), "trie-hot-parents").drop("udepth", "ua", "ub")
    nothing = F.sha2(F.lit(""), 256)
    return (rows.unionByName(root.select(*rows.columns)).join(_ends_digests(ends), NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, block: int = 4, family: int = 20, most_heads: int = 4) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (``rebuilt_turns``), the textless root included.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``.  Repeated rows are turns of their own.  Texts of any length
    count whole.  A conversation left without turns ends at the root.  An empty
    table, or one without ids, has no nodes.  Other columns are ignored.
    """
    rows = stored(turn_rows(conversations), "trie-places")
    return trie_of(rebuilt_turns(rows, family, most_heads), rows.select("conv_id").distinct(), block)
