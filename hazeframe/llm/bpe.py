"""Byte-level BPE: propose tokens by greedy longest match, verify adjacent pairs, merge only what fails.

A token sequence is the result of the merges exactly if every token is what its
own text encodes to and no merge would ever join two neighbours.  Over the
boundary of two tokens lie, while merging runs, a suffix of the left one (a node
on its right spine) and a prefix of the right one (a node on its left spine).
The neighbours are incompatible if some pair of those nodes has a merge that
comes before either node is merged away inside its own token.  Spines are padded
numpy tables, so all pairs of a batch are tested at once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.llm.tables import ship, text_or_empty

NEVER = np.int32(2**31 - 1)
CACHED_WORDS = 300_000
#: The pattern that byte-level BPE vocabularies of this family cut texts with.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class Vocabulary:
    """Tokens, merges and spine tables of one tokenizer file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        byte_of = {c: b for b, c in byte_letters().items()}
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for letters, i in ids.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in letters)
        for letters, i in self.special.items():
            self.bytes_of[i] = letters.encode()
        self.id_of = {bytes(byte_of[c] for c in letters): i for letters, i in ids.items()}
        self.longest = max(map(len, self.id_of))
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        born = np.full(size, -1, np.int32)
        halves: dict[int, tuple[int, int]] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            left, right, joined = ids[a], ids[b], ids[a + b]
            self.rank[(left, right)] = (r, joined)
            if joined not in halves:
                halves[joined], born[joined] = (left, right), r
        self.halves = halves
        keys = np.array([a * size + b for a, b in self.rank], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.array([r for r, _ in self.rank.values()], np.int32)[order]
        self.size, self.born = size, born
        self.right, self.right_until = self._spines(1)
        self.left, self.left_until = self._spines(0)
        # tokens that their own text does not merge to can't be proposed safely
        self.sound = np.array([i in self.special.values() or tuple(self.merge(t)) == (i,) for i, t in enumerate(self.bytes_of)])
        words = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.special_pattern = regex.compile(f"({words})") if words else None
        self.pattern = regex.compile(SPLIT)

    def _spines(self, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes on one edge of every token, outermost last, and the rank that merges each away."""
        chains = []
        for t in range(self.size):
            chain, node, until = [], t, int(NEVER)
            while True:
                chain.append((node, until))
                if node not in self.halves:
                    break
                until, node = int(self.born[node]), self.halves[node][side]
            chains.append(chain)
        deep = max(map(len, chains))
        nodes, ends = np.full((self.size, deep), -1, np.int32), np.zeros((self.size, deep), np.int32)
        for t, chain in enumerate(chains):
            for k, (node, until) in enumerate(chain):
                nodes[t, k], ends[t, k] = node, until
        return nodes, ends

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of neighbours, whether no merge joins them."""
        pairs, back = np.unique(a.astype(np.int64) * self.size + b, return_inverse=True)
        a, b = pairs // self.size, pairs % self.size
        good = self.sound[a] & self.sound[b]
        for i in range(self.right.shape[1]):
            x, x_until = self.right[a, i], self.right_until[a, i]
            live = np.flatnonzero(good & (x >= 0))
            if not len(live):
                break
            for j in range(self.left.shape[1]):
                y = self.left[b[live], j]
                live, y = live[y >= 0], y[y >= 0]
                if not len(live):
                    break
                want = x[live].astype(np.int64) * self.size + y
                at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
                rank = np.where(self.keys[at] == want, self.ranks[at], NEVER)
                # equal ranks: the leftmost pair goes first
                meets = (rank < x_until[live]) & (rank <= self.left_until[b[live], j]) & (rank < NEVER)
                good[live[meets]] = False
                live = live[~meets]
        return good[back]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match from the left."""
        out, at, n = [], 0, len(word)
        while at < n:
            for end in range(min(n, at + self.longest), at, -1):
                token = self.id_of.get(word[at:end])
                if token is not None:
                    out.append(token)
                    at = end
                    break
            else:
                raise ValueError(f"no token for byte {word[at]}")
        return out

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the lowest-ranked neighbouring pair first, the leftmost of equals."""
        token = [self.id_of[word[i:i + 1]] for i in range(len(word))]
        after, before = list(range(1, len(token) + 1)), list(range(-1, len(token) - 1))
        heap = [(self.rank[p][0], i, p) for i in range(len(token) - 1) if (p := (token[i], token[i + 1])) in self.rank]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if token[i] >= 0 else len(token)
            if j >= len(token) or (token[i], token[j]) != pair:
                continue
            token[i], token[j] = self.rank[pair][1], -1
            after[i] = after[j]
            if after[i] < len(token):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < len(token) and (p := (token[k], token[after[k]])) in self.rank:
                    heapq.heappush(heap, (self.rank[p][0], k, p))
        return [t for t in token if t >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[list[list[int]], int]:
        """Ids of each word, and how many words needed exact merging."""
        proposed = [self.propose(w) for w in words]
        lengths = np.array([len(p) for p in proposed], np.int64)
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        bad = np.zeros(len(words), bool)
        bad[owner[~self.sound[flat]]] = True
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        if len(inside):
            bad[owner[inside[~self.compatible(flat[inside], flat[inside + 1])]]] = True
        for i in np.flatnonzero(bad):
            proposed[i] = self.merge(words[i])
        return proposed, int(bad.sum())


class Encoder:
    """Encodes texts with a bounded memory of words already seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.seen, self.merged, self.words = vocabulary, {}, 0, 0

    def encode(self, texts: list[str]) -> list[list[int]]:
        v, cut = self.v, []
        for text in texts:
            pieces = []
            for part in (v.special_pattern.split(text) if v.special_pattern else [text]):
                if part in v.special:
                    pieces.append(part)
                elif part:
                    pieces.extend(v.pattern.findall(part))
            cut.append(pieces)
        new = list({w for pieces in cut for w in pieces} - self.seen.keys() - v.special.keys())
        if len(self.seen) + len(new) > CACHED_WORDS:
            self.seen = {}
            new = list({w for pieces in cut for w in pieces} - v.special.keys())
        for at in range(0, len(new), 50_000):
            some = new[at:at + 50_000]
            ids, failed = v.encode_words([w.encode() for w in some])
            self.merged, self.words = self.merged + failed, self.words + len(some)
            self.seen.update(zip(some, ids))
        self.seen.update({s: [i] for s, i in v.special.items()})
        seen = self.seen
        return [[t for w in pieces for t in seen[w]] for pieces in cut]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.v.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _vocabulary(content: str) -> Vocabulary:
    return Vocabulary(content)


def _chunks(texts, most: int = 2_000_000):
    """Runs of texts of about ``most`` characters; a longer text is a run of its own."""
    run, held = [], 0
    for t in texts:
        if run and held + len(t) > most:
            yield run
            run, held = [], 0
        run.append(t)
        held += len(t)
    if run:
        yield run


def encode_documents(docs: DataFrame, vocabulary_file: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``) of every whole text.

    Null counts as empty (no tokens); repeated rows give repeated results; the
    columns ``keep`` come along unchanged, others are ignored.  An empty table
    gives no rows; a very long text is a run of its own in its task.  Texts of special tokens become those tokens.  The
    vocabulary travels as one broadcast of fixed size (a few MB).
    """
    ship(docs.sparkSession)
    with open(vocabulary_file, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema += "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(_vocabulary(content.value))
        names = list(map(str, range(encoder.v.size)))
        for batch in batches:
            at = 0
            for texts in _chunks(batch["text"]):
                done = []
                for ids in encoder.encode(texts):
                    decoded = encoder.decode(ids)
                    row = (len(ids), hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest(),
                           hashlib.sha256(decoded.encode()).hexdigest())
                    done.append(row + (np.array(ids, np.int32),) if with_ids else row)
                out = pd.DataFrame(done, columns=["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids])
                out.insert(0, "doc_id", batch["doc_id"].to_numpy()[at:at + len(texts)])
                for k, name in enumerate(keep):
                    out[name] = batch[f"kept{k}"].to_numpy()[at:at + len(texts)]
                at += len(texts)
                yield out
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"),
                       *[F.col(f"`{c}`").alias(f"kept{k}") for k, c in enumerate(keep)])
    return rows.mapInPandas(run, schema)
