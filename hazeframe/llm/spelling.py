"""Spelling variants: words of a corpus grouped under their commonest near word.

Two words are near if one code point is replaced, inserted or deleted.  Search
schemes split a word of length m into an exact part and a middle ``[i, j)`` that
takes the error: first either half is exact and the other one the middle.
The vocabulary is dealt by exact part (a *key*: m, i, j and the letters outside
the middle), so a word and all near words that share it meet in one shard.  A
shard holds a full-text index of its delimited words in both directions: suffix
ranks of the text for searches that match the right part and go on to the left,
ranks of the reversed text for the others.  All searches of a shard advance
together as arrays of rank intervals.

Every pair has one place: the error lies at the first position where the words
differ, and a pair of unequal lengths is found from its longer word.  A key with
too many letters for one shard is cut again, its middle into two halves, until
it fits, so no common half makes a large group.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeframe.llm.tables import ship, stored, text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = r"[A-Za-zÀ-ÿ]"


def word_counts(docs: DataFrame, least_length: int = 7, least_count: int = 2, every: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` over all runs of letters of the whole texts.

    Only A-Z are lower-cased.  Where ``every`` divides the CRC-32 of
    ``<id>:<run>``, the run loses its code point at CRC modulo length.  Null texts
    have no words, a null id counts as empty text.
    """
    doc_id = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    runs = docs.select(doc_id.alias("doc_id"), F.explode(F.regexp_extract_all(text_or_empty(text_col), F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    runs = runs.withColumn("crc", F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary")))
    at = (F.col("crc") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("crc") % every == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


class RankIndex:
    """Suffix ranks of a delimited text; a backward step turns the interval of x into that of cx.

    ``codes`` starts and ends with the delimiter 0.  Rotations are sorted, so no end mark is needed.
    """

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        bits = max(1, int(codes.max()).bit_length())
        rank, width = codes.astype(np.int64), 1
        for _ in range(60 // bits - 1):  # as many letters as a long holds are compared in the first round
            rank = (rank << bits) | np.roll(codes, -width)
            width += 1
        while True:
            order = np.argsort(rank, kind="stable")
            new = np.concatenate([[0], np.cumsum(rank[order][1:] != rank[order][:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                break
            rank = rank * n + np.roll(rank, -width)
            width *= 2
        self.n, self.places = n, order
        self.before = codes[order - 1]  # the letter before each sorted rotation
        by_letter = np.argsort(self.before, kind="stable")
        self.keys = self.before[by_letter].astype(np.int64) * n + by_letter

    def step(self, letters: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smaller letters, and equal ones at earlier ranks, come first: both counts in one search."""
        at = letters.astype(np.int64) * self.n
        return np.searchsorted(self.keys, at + low), np.searchsorted(self.keys, at + high)

    def letters_in(self, low: np.ndarray, high: np.ndarray, alphabet: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of the interval, letter) for all letters before the rotations of the intervals; wide ones name the whole alphabet."""
        wide = high - low > alphabet
        few = np.flatnonzero(~wide)
        size = (high - low)[few]
        of = np.repeat(few, size)
        at = np.repeat(low[few] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        named = np.unique(of * 4096 + self.before[at])
        every = np.flatnonzero(wide)
        return np.concatenate([named // 4096, np.repeat(every, alphabet)]), np.concatenate([named % 4096, np.tile(np.arange(alphabet), len(every))])


def near_words(index: RankIndex, alphabet: int, rows: np.ndarray, size: np.ndarray, start: np.ndarray, stop: np.ndarray, mirrored: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, place of the near word in the text) of all near words of the given ones that are no longer than these.

    ``rows`` holds the letters in reading order of the search, ``start`` letters
    are exact, the error lies in ``[start, stop)``, the rest is exact again.  In
    a run of equal letters the last one in the text's order is deleted:
    ``mirrored`` says that the search reads the text backwards.
    """
    count, width = rows.shape
    padded = np.concatenate([rows, np.zeros((count, 1), rows.dtype)], axis=1)  # the closing delimiter
    who = np.arange(count)
    low, high = index.step(np.zeros(count, np.int64), np.zeros(count, np.int64), np.full(count, index.n, np.int64))
    found: list[tuple[np.ndarray, ...]] = []
    for p in range(int(stop.max(initial=0))):
        here = p >= start[who]
        if here.any():
            w, lo, hi = who[here], low[here], high[here]
            of, letter = index.letters_in(lo, hi, alphabet)
            other = (letter != padded[w[of], p]) & (letter != 0)
            of, letter = of[other], letter[other]
            found.append((w[of], np.full(len(of), p + 1), *index.step(letter, lo[of], hi[of])))
            beside = padded[w, p - 1] if mirrored and p else padded[w, p + 1] if not mirrored else np.zeros(len(w), padded.dtype)
            last = padded[w, p] != beside
            found.append((w[last], np.full(int(last.sum()), p + 1), lo[last], hi[last]))
        low, high = index.step(padded[who, p], low, high)
        on = (p + 1 < stop[who]) & (low < high)
        who, low, high = who[on], low[on], high[on]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    who, at, low, high = (np.concatenate(x) for x in zip(*found))
    hits = []
    while len(who):
        alive = low < high
        who, at, low, high = who[alive], at[alive], low[alive], high[alive]
        done = at > size[who]
        if done.any():
            hits.append((who[done], index.places[low[done]]))  # a whole word between delimiters: it comes once
            who, at, low, high = who[~done], at[~done], low[~done], high[~done]
        low, high = index.step(padded[who, at], low, high)
        at = at + 1
    return tuple(np.concatenate(x) for x in zip(*hits)) if hits else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of ``\\0w1\\0w2...\\0`` and where each word starts."""
    text = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), np.uint32)
    return text, np.flatnonzero(text == 0)[:-1] + 1


def _search_shard(batch_letters: int = 2_000_000):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        words, at = np.unique(shard["word"].to_numpy(object).astype(str), return_inverse=True)
        n = np.zeros(len(words), np.int64)
        n[at] = shard["n"].to_numpy()
        size = np.char.str_len(words)
        pairs = []
        i, j, m = (shard[c].to_numpy(np.int64) for c in "ijm")
        left = i < m - j  # the right part is the longer exact one: it is matched first, then on to the left
        asks = shard["asks"].to_numpy(bool)
        for mirrored in (False, True):
            side = left == mirrored
            if not (side & asks).any():
                continue
            listed = np.unique(at[side])
            text, starts = _codes(list(words[listed]))
            letters, codes = np.unique(text, return_inverse=True)
            # a search to the right steps through the ranks of the reversed text
            index = RankIndex(codes if mirrored else codes[::-1].copy())
            slot = np.zeros(len(words), np.int64)
            slot[listed] = np.arange(len(listed))
            mine = np.flatnonzero(side & asks)
            mine = mine[np.argsort(size[at[mine]], kind="stable")]
            done = 0
            while done < len(mine):
                longest = int(size[at[mine[min(len(mine), done + 1) - 1]]])
                part = mine[done:done + max(1, batch_letters // (8 * longest))]
                longest = int(size[at[part[-1]]])
                while len(part) > 1 and len(part) * longest > batch_letters:
                    part = part[:len(part) // 2]
                    longest = int(size[at[part[-1]]])
                done += len(part)
                own = at[part]
                column = np.arange(longest)
                from_text = starts[slot[own]][:, None] + (size[own][:, None] - 1 - column if mirrored else column)
                rows = np.where(column < size[own][:, None], codes[np.clip(from_text, 0, len(codes) - 1)], 0)
                begin, end = (m[part] - j[part], m[part] - i[part]) if mirrored else (i[part], j[part])
                who, place = near_words(index, len(letters), rows, size[own], begin, end, mirrored)
                # the interval names a rotation that starts at the delimiter before the word (in search order: behind it)
                where = place + 1 if mirrored else len(codes) - 1 - place - 1
                hit = np.searchsorted(starts, where, side="right") - 1
                pairs.append((own[who], listed[hit]))
        if not pairs:
            return pd.DataFrame({"word": [], "n_near": [], "form": [], "form_n": []})
        a, b = (np.concatenate(x) for x in zip(*pairs))
        # equal lengths are found from both sides, unequal ones from the longer word
        unequal = size[a] != size[b]
        a, b = np.concatenate([a, b[unequal]]), np.concatenate([b, a[unequal]])
        order = np.lexsort((b, -n[b], a))  # words are sorted by code point
        a, b = a[order], b[order]
        first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
        return pd.DataFrame({"word": words[a[first]], "n_near": np.diff(np.append(first, len(a))), "form": words[b[first]], "form_n": n[b[first]]})
    return run


def _left(i: str, j: str, m: str) -> Column:
    return F.col(i) < F.col(m) - F.col(j)


def _sharded(words: DataFrame, shard_letters: int) -> DataFrame:
    """``shard, word, n, m, i, j, asks``: each word under the keys it asks and the keys it may answer."""
    spark, size = words.sparkSession, F.length("word")
    letters = words.agg(F.coalesce(F.sum(size + 1), F.lit(0))).first()[0]
    # few keys can be hot: each has more than 1 / 100,000 of all letters
    cap = max(shard_letters // 2, 4 * letters // 100_000)
    lengths = words.select("word", "n", F.explode(F.array(F.struct(size.alias("m"), F.lit(True).alias("asks")), F.struct((size + 1).alias("m"), F.lit(False).alias("asks")))).alias("x")).select("word", "n", "x.*")

    def halves(rows: DataFrame, i: Column, j: Column) -> DataFrame:
        half = F.floor((i + j) / 2).cast("int")
        return rows.withColumn("x", F.explode(F.array(F.struct(half.alias("i"), j.alias("j")), F.struct(i.alias("i"), half.alias("j"))))).select("word", "n", "m", "asks", "x.i", "x.j")
    rows = halves(lengths, F.lit(0), F.col("m"))
    settled, level = [], 0
    tail = F.col("m") - F.col("j")
    key = F.xxhash64("m", "i", "j", F.substring("word", F.lit(1), F.col("i")), F.substring("word", size - tail + 1, tail))
    while True:
        rows = rows.withColumn("key", key)
        hot = stored(rows.filter("j - i > 1").groupBy("key").agg(F.sum(size + 1).alias("letters")).filter(F.col("letters") > cap).select("key"), f"spelling-hot-{level}")
        if hot.isEmpty():
            settled.append(rows)
            break
        settled.append(rows.join(F.broadcast(hot), "key", "left_anti"))
        rows = halves(rows.join(F.broadcast(hot), "key", "left_semi"), F.col("i"), F.col("j"))
        level += 1
    shards = max(1, -(-4 * letters // shard_letters))
    out = reduce(DataFrame.unionByName, settled)
    return out.withColumn("shard", F.pmod("key", F.lit(shards)))


def near_summary(words: DataFrame, shard_letters: int = 400_000) -> DataFrame:
    """``word, n_near, form, form_n`` for words (distinct, with counts ``n``) that have a near word; ``form`` is the commonest, ties by code point."""
    ship(words.sparkSession)
    parts = _sharded(words, shard_letters).groupBy("shard").applyInPandas(_search_shard(), "word string, n_near long, form string, form_n long")
    parts = stored(parts, "spelling-near")
    best = F.min(F.struct(-F.col("form_n"), F.col("form").alias("form"))).alias("best")
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best.form", (-F.col("best.col1")).alias("form_n"))


def form_roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word reached from ``word, form`` by following forms, in doubling steps."""
    known, level = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots-0"), 0
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        grown = stored(known.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"spelling-roots-{level + 1}")
        if grown.filter("moved").isEmpty():
            return grown.drop("moved")
        known, level = grown.drop("moved"), level + 1


def spelling_variants(docs: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10, every: int = 31, shard_letters: int = 400_000) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``word_counts``.

    ``form`` is the near word with the largest count (ties: smallest by code
    point) if that is at least ``ratio`` times the word's, else null with its
    ``form_n``.  Counts rise along forms, so following them ends.  Null and empty
    texts and empty tables give no words; a run of any length is one word;
    repeated rows count as often as they come; other columns are ignored.
    """
    if least_length < 2 or ratio < 2:
        raise ValueError("words need two code points, and counts must rise along forms")
    words = stored(word_counts(docs, least_length, least_count, every), "spelling-words")
    near = near_summary(words, shard_letters)
    clear = F.col("form_n") >= ratio * F.col("n")
    out = stored(words.join(near, "word", "left").select(
        "word", F.when(clear, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(clear, F.col("form_n")).alias("form_n")), "spelling-forms")
    roots = form_roots(out.filter("form is not null"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
