"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks.  Each block is a vector: its tag
path hashed, its words hashed, and a few counts.  A bidirectional LSTM in numpy
reads the sequence both ways and labels every block with the whole page as its
context.  It is trained in the job on a bounded sample of pages, whose blocks
take their teacher label from landmarks in their path; half of the training
pages are rearranged copies with other wrappers, so that no single landmark
carries the decision.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.llm.tables import ship, text_or_empty

PATH_SLOTS, WORD_SLOTS, COUNTS = 64, 48, 6
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template svg iframe textarea".split())
NESTING_RAW = {t: re.compile(rf"<(/?){t}\b((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>", re.I) for t in ("template", "svg")}
#: Tags that end an open one of the same group.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = BLOCK_TAGS - {"button", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "option", "summary", "html", "head", "body", "title"}
CONTENT = re.compile(r"^(article|main)$|[.#](article|content|post|entry|story|main)\b")
CLUTTER = re.compile(r"^(nav|header|footer|aside|form|menu|head|title|button|select|dialog|fieldset)$|"
                     r"[.#][\w-]*(?:\b|_|-)(nav|menu|header|footer|sidebar|side|ad|ads|advert|banner|promo|sponsor|cookie|notice|consent|popup|modal|newsletter|subscribe|"
                     r"signup|login|share|social|comment|comments|reply|replies|respond|discussion|related|breadcrumb|breadcrumbs|widget)s?(?:\b|_|-)")
SPACE = re.compile(r"\s+")
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>", re.S)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


class Path:
    """An open block element and those around it, as a chain that all blocks inside share.

    Hashed slots and the landmark verdict (1 content, 0 none, -1 clutter) add up
    from the root, so a deeply nested page costs no more for each of its blocks.
    """
    __slots__ = ("label", "parent", "depth", "slots", "verdict")

    def __init__(self, label: str = "", parent: "Path | None" = None):
        self.label, self.parent = label, parent
        self.depth, self.slots, self.verdict = 0, np.zeros(PATH_SLOTS, np.float32), 0
        if parent is not None:
            at, verdict = _label_traits(label)
            self.depth, self.slots = parent.depth + 1, parent.slots.copy()
            np.add.at(self.slots, at, 1)
            self.verdict = -1 if parent.verdict < 0 else verdict or parent.verdict

    @classmethod
    def of(cls, labels: tuple[str, ...]) -> "Path":
        path = cls()
        for label in labels:
            path = cls(label, path)
        return path

    def __getitem__(self, k: int) -> str:
        return self.labels()[k]

    def labels(self) -> tuple[str, ...]:
        out, node = [], self
        while node.parent is not None:
            out.append(node.label)
            node = node.parent
        return tuple(reversed(out))


@dataclass
class Block:
    path: Path
    text: str
    linked: int


_TRAITS: dict[str, tuple[list[int], int]] = {}


def _label_traits(label: str) -> tuple[list[int], int]:
    """Slots of a label's parts, and what the landmarks make of it."""
    found = _TRAITS.get(label)
    if found is None:
        if len(_TRAITS) > 50_000:
            _TRAITS.clear()
        parts = sorted({label, *re.split(r"(?=[.#])", label)})
        found = _TRAITS[label] = ([crc32(p.encode()) % PATH_SLOTS for p in parts], -1 if CLUTTER.search(label) else 1 if CONTENT.search(label) else 0)
    return found


def _behind_raw(page: str, name: str, at: int, rest: str) -> int:
    """Where the page goes on after the raw element opened just before ``at``.

    ``svg`` may be self-closed and, like ``template``, holds others of its kind;
    an ``svg`` that is never closed hides nothing.
    """
    if name not in NESTING_RAW:
        end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
        return end.end() if end else len(page)
    if name == "svg" and rest.endswith("/"):
        return at
    depth = 1
    for m in NESTING_RAW[name].finditer(page, at):
        if m[1]:
            depth -= 1
        elif name == "template" or not m[2].endswith("/"):
            depth += 1
        if not depth:
            return m.end()
    return at if name == "svg" else len(page)


def leaf_blocks(page: str) -> list[Block]:
    """Runs of text between block tags, in page order, with their open block elements."""
    out: list[Block] = []
    stack: list[tuple[str, Path]] = []
    root, is_open = Path(), Counter()
    parts: list[str] = []
    state = [0, 0]  # open links, linked characters

    def flush():
        text = SPACE.sub(" ", "".join(parts)).strip()
        if text:
            out.append(Block(stack[-1][1] if stack else root, text, min(state[1], len(text))))
        parts.clear()
        state[1] = 0

    def close_last():
        is_open[stack.pop()[0]] -= 1

    def say(raw: str):
        if raw:
            text = entities.unescape(raw)
            parts.append(text)
            if state[0]:
                state[1] += len(text)
    at = 0
    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name == "a":
                state[0] = 0
            elif name in BLOCK_TAGS:
                flush()
                if is_open[name]:
                    while stack[-1][0] != name:
                        close_last()
                    close_last()
            continue
        if name in RAW_TAGS:
            at = _behind_raw(page, name, at, m[3])
            continue
        if name == "a":
            state[0] = 1
        elif name == "br":
            parts.append(" ")
        elif name in BLOCK_TAGS:
            flush()
            if name in CLOSES_P and stack and stack[-1][0] == "p":
                close_last()
            if name in ENDS and stack and stack[-1][0] in ENDS[name]:
                close_last()
            if name not in VOID_TAGS and not m[3].endswith("/"):
                label = name
                for n, *v in NAMES.findall(m[3]):
                    label += "".join(("#" if n.lower() == "id" else ".") + w.lower() for w in "".join(v).split())
                stack.append((name, Path(label, stack[-1][1] if stack else root)))
                is_open[name] += 1
    flush()
    return out


def teacher(path: Path) -> int:
    """1 inside content landmarks, unless clutter lies deeper or anywhere outside them."""
    return int(path.verdict > 0)


_SLOT: dict[str, int] = {}


def _word_slot(word: str) -> int:
    slot = _SLOT.get(word)
    if slot is None:
        if len(_SLOT) > 200_000:
            _SLOT.clear()
        slot = _SLOT[word] = crc32(word.lower().encode()) % WORD_SLOTS
    return slot


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row per block: hashed path, hashed words of the whole block, counts."""
    x = np.zeros((len(blocks), PATH_SLOTS + WORD_SLOTS + COUNTS), np.float32)
    for i, b in enumerate(blocks):
        x[i, :PATH_SLOTS] = b.path.slots
        words = b.text.split()
        counts = np.bincount([_word_slot(w) for w in words], minlength=WORD_SLOTS)
        x[i, PATH_SLOTS:PATH_SLOTS + WORD_SLOTS] = counts / max(1.0, np.sqrt((counts * counts).sum()))
        x[i, -COUNTS:] = (np.log1p(len(b.text)) / 8, np.log1p(len(words)) / 6, b.linked / max(1, len(b.text)),
                          sum(map(b.text.count, ".,!?")) / max(1, len(words)), i / max(1, len(blocks) - 1), b.path.depth / 8)
    return x


class BlockLabeller:
    """Bidirectional LSTM with a logistic output, trained by Adam on whole sequences."""

    def __init__(self, inputs: int, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p = {}
        for way in "fb":
            self.p[f"w{way}"] = (rng.standard_normal((inputs + hidden, 4 * hidden)) / np.sqrt(inputs + hidden)).astype(np.float32)
            self.p[f"c{way}"] = np.zeros(4 * hidden, np.float32)
            self.p[f"c{way}"][hidden:2 * hidden] = 1
        self.p["out"] = (rng.standard_normal((2 * hidden + inputs, 1)) / np.sqrt(2 * hidden + inputs)).astype(np.float32)
        self.p["bias"] = np.zeros(1, np.float32)

    @staticmethod
    def _gate(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def _read(self, x: np.ndarray, mask: np.ndarray, way: str, training: bool):
        """States of one direction; padded steps carry the state over.  What only ``_back`` needs is kept in training alone."""
        steps, n, h = x.shape[0], x.shape[1], self.h
        w, c = self.p[f"w{way}"], self.p[f"c{way}"]
        inner = x @ w[:x.shape[2]] + c
        state, cell, past = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32), []
        states = np.zeros((steps, n, h), np.float32)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = inner[t] + state @ w[x.shape[2]:]
            gates = self._gate(z[:, :3 * h])
            i, f, o = gates[:, :h], gates[:, h:2 * h], gates[:, 2 * h:]
            g = np.tanh(z[:, 3 * h:])
            m = mask[t][:, None]
            new_cell = f * cell + i * g
            tanh_cell = np.tanh(new_cell)
            if training:
                past.append((t, state, cell, i, f, o, g, tanh_cell))
            cell = m * new_cell + (1 - m) * cell
            state = m * (o * tanh_cell) + (1 - m) * state
            states[t] = state
        return states, past

    def forward(self, x: np.ndarray, mask: np.ndarray, training: bool = True):
        ahead, kept_f = self._read(x, mask, "f", training)
        back, kept_b = self._read(x, mask, "b", training)
        joined = np.concatenate([ahead, back, x], axis=2)
        return self._gate(joined @ self.p["out"] + self.p["bias"])[:, :, 0], joined, kept_f, kept_b

    def _back(self, x, mask, way, past, upstream, grad):
        h, d = self.h, x.shape[2]
        w = self.p[f"w{way}"]
        gw, gc = np.zeros_like(w), np.zeros_like(self.p[f"c{way}"])
        d_state, d_cell = np.zeros_like(upstream[0]), np.zeros_like(upstream[0])
        for t, state, cell, i, f, o, g, tanh_cell in reversed(past):
            m = mask[t][:, None]
            whole = d_state + upstream[t]
            out, rest = whole * m, whole * (1 - m)
            inner_cell = d_cell * m + out * o * (1 - tanh_cell ** 2)
            dz = np.concatenate([inner_cell * g * i * (1 - i), inner_cell * cell * f * (1 - f), out * tanh_cell * o * (1 - o), inner_cell * i * (1 - g ** 2)], axis=1)
            gw[:d] += x[t].T @ dz
            gw[d:] += state.T @ dz
            gc += dz.sum(axis=0)
            d_state = dz @ w[d:].T + rest
            d_cell = inner_cell * f + d_cell * (1 - m)
        grad[f"w{way}"], grad[f"c{way}"] = gw, gc

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 8, batch: int = 32, rate: float = 0.01, seed: int = 11) -> "BlockLabeller":
        rng = np.random.default_rng(seed)
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        count = 0
        order = sorted(range(len(pages)), key=lambda k: len(pages[k][1]))
        groups = [order[i:i + batch] for i in range(0, len(order), batch)]
        for _ in range(epochs):
            for g in rng.permutation(len(groups)):
                x, mask = padded([pages[k][0] for k in groups[g]])
                y = np.zeros(mask.shape, np.float32)
                for c, k in enumerate(groups[g]):
                    y[:len(pages[k][1]), c] = pages[k][1]
                p, joined, kept_f, kept_b = self.forward(x, mask)
                slope = ((p - y) * mask / max(1.0, mask.sum()))[:, :, None]
                grad = {"out": np.einsum("tnd,tne->de", joined, slope), "bias": slope.sum(axis=(0, 1))}
                up = slope @ self.p["out"].T
                self._back(x, mask, "f", kept_f, up[:, :, :self.h], grad)
                self._back(x, mask, "b", kept_b, up[:, :, self.h:2 * self.h], grad)
                size = np.sqrt(sum(float((v * v).sum()) for v in grad.values()))
                count += 1
                for k, v in grad.items():
                    v = v / max(1.0, size)
                    a, b = moment[k]
                    a += 0.1 * (v - a)
                    b += 0.001 * (v * v - b)
                    self.p[k] -= rate * (a / (1 - 0.9 ** count)) / (np.sqrt(b / (1 - 0.999 ** count)) + 1e-8)
        return self

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        out: list = [None] * len(pages)
        order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):  # padded size bounded, but for one long page
            end = at + 1
            while end < len(order) and (end - at + 1) * len(pages[order[end]]) <= 8000:
                end += 1
            x, mask = padded([pages[k] for k in order[at:end]])
            p = self.forward(x, mask, training=False)[0]
            for c, k in enumerate(order[at:end]):
                out[k] = p[:len(pages[k]), c] >= 0.5
            at = end
        return out


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max([1, *map(len, rows)])
    width = PATH_SLOTS + WORD_SLOTS + COUNTS
    x, mask = np.zeros((steps, len(rows), width), np.float32), np.zeros((steps, len(rows)), np.float32)
    for c, r in enumerate(rows):
        x[:len(r), c], mask[:len(r), c] = r, 1
    return x, mask


CONTENT_WRAPS = (("article",), ("main",), ("div.content",), ("div#main", "article.post"), ("section.article",), ("main", "div.entry"))
CLUTTER_WRAPS = (("nav", "ul", "li"), ("header",), ("footer",), ("aside",), ("div.ad",), ("div.sidebar",), ("div.cookie-notice",), ("form",),
                 ("section.comments", "p"), ("div#comments", "div.comment"), ("div.menu", "ul", "li"), ("div.newsletter", "form"), ("ul.breadcrumbs", "li"), ("div.related", "ul", "li"))
INNER_WRAPS = (("aside",), ("form",), ("div.ad",), ("div.comments",), ("nav",), ("footer",), ("header",), ("div.notice",))


def rearranged(blocks: list[Block], labels: list[int], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """The page's own blocks under other wrappers, clutter also placed inside and after the content."""
    good = [b for b, y in zip(blocks, labels) if y]
    other = [b for b, y in zip(blocks, labels) if not y and "head" not in b.path.labels()] or good[:1]
    wrap = CONTENT_WRAPS[rng.integers(len(CONTENT_WRAPS))]
    start = ("html", "body")
    out, ys = [Block(Path.of(("html", "head", "title")), good[0].text if good else "", 0)] if good else [], [0] if good else []

    def clutter(most: int, inside: tuple[str, ...] = (), wraps=CLUTTER_WRAPS):
        for _ in range(rng.integers(0, most + 1)):
            path = wraps[rng.integers(len(wraps))]
            for _ in range(rng.integers(1, 4)):
                pool = good if good and rng.random() < 0.4 else other
                b = pool[rng.integers(len(pool))]
                links = len(b.text) if path[-1] == "li" else 0
                out.append(Block(Path.of(start + inside + path), b.text, links))
                ys.append(0)
    clutter(3)
    for b in good:
        if rng.random() < 0.12:
            clutter(1, wrap, INNER_WRAPS)
        tail = b.path.label if b.path.label.split(".")[0] in ("p", "h1", "h2", "h3", "li", "pre", "blockquote", "td") else "p"
        out.append(Block(Path.of(start + wrap + (tail,)), b.text, b.linked))
        ys.append(1)
    clutter(3)
    return out, ys


def _one_page_per_hash(pages: DataFrame, sample_pages: int) -> DataFrame:
    """``sample_pages`` different pages, those of the smallest hashes; copies are dropped within tasks before a page is moved."""
    hashed = pages.withColumn("h", F.xxhash64("html"))
    chosen = hashed.select("h").distinct().orderBy("h").limit(sample_pages)

    def first_seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # at most ``sample_pages``
        for b in batches:
            b = b[~b["h"].isin(seen)].drop_duplicates("h")
            seen.update(b["h"])
            yield b
    one = hashed.join(F.broadcast(chosen), "h").select("h", "html").mapInPandas(first_seen, "h long, html string")
    return one.groupBy("h").agg(F.first("html").alias("html")).orderBy("h").select("html")


def train_labeller(pages: DataFrame, html_col: str = "html", sample_pages: int = 192, most_blocks: int = 600, seed: int = 5) -> BlockLabeller | None:
    """Fit on ``sample_pages`` different pages, chosen by a hash of their text.

    A page of more than ``most_blocks`` blocks is learned from a run of so many at
    a random place; pages of any size may be chosen.  None without any block.
    """
    html = F.col(f"`{html_col}`").cast("string")
    sample = _one_page_per_hash(pages.select(html.alias("html")).filter("html is not null and html != ''"), sample_pages)
    rng = np.random.default_rng(seed)
    examples = []
    for row in sample.toLocalIterator():
        blocks = leaf_blocks(row["html"])
        first = int(rng.integers(len(blocks) - most_blocks + 1)) if len(blocks) > most_blocks else 0
        blocks = blocks[first:first + most_blocks]
        labels = [teacher(b.path) for b in blocks]
        if blocks:
            examples.append((vectors(blocks), np.array(labels, np.float32)))
            for _ in range(2):
                moved, ys = rearranged(blocks, labels, rng)
                if moved:
                    examples.append((vectors(moved), np.array(ys, np.float32)))
    return BlockLabeller(PATH_SLOTS + WORD_SLOTS + COUNTS).fit(examples) if examples else None


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **training) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row, from the whole html.

    Null or empty html gives the empty text.  Character references are decoded,
    white space within a block becomes one space, blocks are joined by line
    feeds in page order.  Repeated rows repeat their result; other columns are
    ignored; an empty table gives no rows.  Very long and deeply nested pages are
    read whole.  If no page of the sample has a block, the landmarks decide alone.
    """
    ship(pages.sparkSession)
    model = pages.sparkSession.sparkContext.broadcast(train_labeller(pages, html_col, **training))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 128):
                part = batch.iloc[at:at + 128]
                blocks = [leaf_blocks(h) for h in part["html"]]
                if model.value is None:
                    kept = [[teacher(b.path) for b in bs] for bs in blocks]
                else:
                    kept = model.value.label([vectors(b) for b in blocks])
                texts = ["\n".join(b.text for b, good in zip(bs, ks) if good) for bs, ks in zip(blocks, kept)]
                yield pd.DataFrame({"page_id": part["page_id"], "url": part["url"], "text": texts, "n_chars": list(map(len, texts))})
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), text_or_empty(html_col).alias("html"))
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")
