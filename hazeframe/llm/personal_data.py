"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, a span classifier decides.

Base rules find e-mail addresses, network addresses, card and phone numbers.
Wider patterns propose further spans (spelled-out addresses, other separators,
numbers without a country code) beside those that a base rule rejected.  Five
labelers vote on every candidate: the base rule itself, a checksum or form check,
a gazetteer, words around it, and the characters it touches.  Spark counts the
vote patterns of all documents; expectation-maximisation estimates from these
counts how reliable each labeler is for each kind, without any label.  A logistic
classifier is trained on the resulting probabilities with votes and shape as
features, and adds the spans it is sure of.  Base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.llm.tables import ship, stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("rule", "check", "gazetteer", "context", "edges")

# Published top-level domains, calling codes, issuer prefixes, reserved networks, and cue words.
DOMAINS = frozenset("com org net edu gov mil int info biz name eu uk de fr es it nl be ch at se no dk fi pl pt ie cz gr ru ua tr us ca mx br ar cl co jp cn kr in au nz za io app dev".split())
CALLING_CODES = tuple("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 212 213 216 234 254 351 352 353 354 358 359 370 371 372 375 380 381 385 386 420 421 852 855 880 886 961 962 965 966 971 972 974 977 994 995 998".split())
ISSUERS = re.compile(r"4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[4-8]|6(?:011|5|4[4-9]|2)")
RESERVED = re.compile(r"(?:0|10|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\.|192\.168\.|169\.254\.|172\.(?:1[6-9]|2[0-9]|3[01])\.")
CUES = {"email": r"e-?mail|mail|contact|write to|reach|correo|courriel", "ip": r"\bip\b|address|host|server|login|adresse",
        "card": r"card|visa|master ?card|amex|credit|debit|carte|karte|tarjeta", "phone": r"call|phone|tel\b|tel\.|telef|mobile|cell|fax|whatsapp|handy|m[oó]vil"}
AGAINST = r"version|isbn|issn|invoice|order|token|sha|hash|serial|part no|figure|page|section|rfc|\bid\b"

# Base rules, as the operator's contract states them; possessive and guarded forms of the same languages, linear on any text.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Wider proposals.
SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[({]at[\])}]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[({]dot[\])}]\x20?)[A-Za-z0-9-]++)++", re.I)
HEXTETS = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
FOURS = re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[\x20   ./‐-–-]{1,2}[0-9]{4}){2}[\x20   ./‐-–-]{1,2}[0-9]{1,7}(?![0-9A-Za-z])")
NATIONAL = re.compile(r"(?<![\w.+-])(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[\x20(). ‐-–/-]{1,3}[0-9]{2,5}){2,5}(?![\w-])")
ANY = re.compile(r"[0-9@]|[\[({][aA][tT][\])}]")


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        twice = int(c) * (1 + place % 2)
        total += twice - 9 * (twice > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def rule_matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, passed) of all matches of the base patterns, leftmost and without overlap per kind."""
    behind = 0
    for m in HOST.finditer(text):
        start = m.start()
        while start > behind and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if start < m.start():
            yield "email", start, m.end(), True
            behind = m.end()
    for m in QUAD.finditer(text):
        yield "ip", m.start(), m.end(), all(int(x.lstrip("0")[:4] or "0") <= 255 for x in m[0].split("."))
    for m in DIGITS.finditer(text):
        d = _digits(m[0])
        yield "card", m.start(), m.end(), 12 <= len(d) <= 19 and luhn(d)
    for m in PLUS.finditer(text):
        yield "phone", m.start(), m.end(), 9 <= len(_digits(m[0])) <= 15


def candidates(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, rule vote): base spans +1, rejected but long enough matches -1, wider proposals outside all base spans 0."""
    if not ANY.search(text):
        return []
    out, taken = [], set()
    held = []
    for kind, start, end, passed in rule_matches(text):
        if passed:
            held.append((start, end))
        if passed or kind == "ip" or (kind == "card" and len(_digits(text[start:end])) >= 12) or (kind == "phone" and len(_digits(text[start:end])) >= 7):
            out.append((kind, start, end, 1 if passed else -1))
            taken.add((kind, start, end))
    apart: list[tuple[int, int]] = []  # base spans of all kinds, overlapping ones merged
    for start, end in sorted(held):
        if apart and start < apart[-1][1]:
            apart[-1] = (apart[-1][0], max(end, apart[-1][1]))
        else:
            apart.append((start, end))
    for kind, pattern in (("email", SPELLED), ("ip", HEXTETS), ("card", FOURS), ("phone", NATIONAL)):
        for m in pattern.finditer(text):
            before = bisect_left(apart, (m.end(),)) - 1
            if (kind, *m.span()) not in taken and (before < 0 or apart[before][1] <= m.start()):
                out.append((kind, *m.span(), 0))
    return out


def votes(text: str, kind: str, start: int, end: int, rule: int) -> tuple[int, ...]:
    """+1 personal, -1 not, 0 no opinion, in the order of ``LABELERS``."""
    span, digits = text[start:end], _digits(text[start:end])
    if kind == "email":
        last = re.split(r"[.\])}\x20]+", span)[-1].lower()
        check, known = (1 if last.isalpha() and len(last) >= 2 else -1), (1 if last in DOMAINS else 0)
    elif kind == "ip":
        check = 1 if ":" in span or all(int(x.lstrip("0")[:4] or "0") <= 255 for x in span.split(".")) else -1
        known = -1 if RESERVED.match(span) else 1
    elif kind == "card":
        check, known = (1 if 12 <= len(digits) <= 19 and luhn(digits) else -1), (1 if ISSUERS.match(digits) else -1)
    else:
        check = 1 if 9 <= len(digits) <= 15 and len(set(digits)) > 2 else -1
        known = 0 if span[0] != "+" else 1 if digits.startswith(CALLING_CODES) else -1
    around = text[max(0, start - 40):start].lower() + " \n " + text[end:end + 20].lower()
    context = -1 if re.search(AGAINST, around) else 1 if re.search(CUES[kind], around) else 0
    touches = (start > 0 and (text[start - 1].isalnum() or text[start - 1] == "_")) or (end < len(text) and (text[end].isalnum() or text[end] == "_"))
    return rule, check, known, context, -1 if touches else 1


def shape(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """Binned form of a span: digits, separators, letters, leading plus, neighbours."""
    span = text[start:end]
    digits = len(_digits(span))
    separators = sum(not c.isalnum() for c in span)

    def beside(c: str) -> int:
        return 0 if not c.strip() else 1 if c in "\"'()[]<>,.;:!?" else 2
    return (sum(digits > x for x in (0, 6, 9, 11, 15, 19)), sum(separators > x for x in (0, 2, 4)), int(any(c.isalpha() for c in span)),
            int(span[0] == "+"), beside(text[start - 1:start]), beside(text[end:end + 1]))


BINS = (7, 4, 2, 2, 3, 3)
CELL = [*LABELERS, "digits", "separators", "letters", "plus", "left", "right"]


def vote_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``kind, <labelers>, <shape bins>, n`` over all candidates of all documents; fewer rows than there are patterns."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, *votes(t, k, s, e, r), *shape(t, k, s, e)) for t in b["text"] for k, s, e, r in candidates(t)]
            yield pd.DataFrame(rows, columns=["kind", *CELL])
    texts = docs.select(text_or_empty(text_col).alias("text"))
    return texts.mapInPandas(run, "kind string, " + ", ".join(f"{c} int" for c in CELL)).groupBy("kind", *CELL).agg(F.count("*").alias("n"))


def _class_one(patterns: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    """P(class 1) of vote patterns, labelers voting independently within a class."""
    at = np.arange(patterns.shape[1])
    log = np.stack([np.log(table[c][at, patterns + 1]).sum(1) for c in (0, 1)]) + np.log([[1 - prior], [prior]])
    return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def estimate_reliability(patterns: np.ndarray, n: np.ndarray, rounds: int = 200, strength: float = 4.0) -> tuple[float, np.ndarray]:
    """(prior, P(vote | class, labeler)) by expectation-maximisation.

    ``patterns`` holds votes in {-1, 0, 1}, ``n`` their counts.  ``strength``
    pseudo-votes per labeler and class say that labelers are better than chance,
    which names the two classes and keeps rare votes from certainty.
    """
    hope = np.array([[4.0, 2.0, 1.0], [1.0, 2.0, 4.0]])[:, None, :] * strength / 7.0
    one_hot = (patterns[:, :, None] == np.array([-1, 0, 1])).astype(float)
    table, prior = np.repeat(hope / hope.sum(2, keepdims=True), patterns.shape[1], axis=1), 0.5
    member = np.full(len(n), 0.5)
    for _ in range(rounds):
        now = _class_one(patterns, prior, table)
        weight = np.stack([n * (1 - now), n * now])
        table = np.einsum("cp,plv->clv", weight, one_hot) + hope
        table /= table.sum(2, keepdims=True)
        prior = (weight[1].sum() + 1) / (n.sum() + 2)
        settled, member = np.abs(now - member).max(initial=0) < 1e-9, now
        if settled:
            break
    return prior, table


def features(cells: np.ndarray) -> np.ndarray:
    """Intercept and one-hot votes and bins of ``cells`` (columns ``CELL``)."""
    n = len(LABELERS)
    parts = [np.ones((len(cells), 1))] + [(cells[:, [k]] == np.array([-1, 0, 1])) for k in range(n)]
    parts += [cells[:, [n + k]] == np.arange(size) for k, size in enumerate(BINS)]
    return np.concatenate(parts, axis=1).astype(float)


def fit_logistic(x: np.ndarray, share: np.ndarray, n: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Weights of a ridge logistic model of soft labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - share)) + ridge * w
        step = np.linalg.solve((x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


class SpanModel:
    """Weights per kind, and what was estimated of the labelers.

    Beside the observed patterns, the classifier learns every possible vote
    pattern with a small weight, so that votes which a corpus never shows keep
    the reliability estimated for their labeler.
    """

    def __init__(self, counts: pd.DataFrame, unseen_weight: float = 0.2):
        self.weights, self.reliability, self.prior = {}, {}, {}
        every = np.array(list(product((-1, 0, 1), repeat=len(LABELERS))))
        bare = np.concatenate([every, np.full((len(every), len(BINS)), -1)], axis=1)  # no shape bin is set
        for kind in KINDS:
            mine = counts[counts["kind"] == kind].sort_values(CELL)
            cells, n = mine[CELL].to_numpy(np.int64).reshape(-1, len(CELL)), mine["n"].to_numpy(float)
            patterns, of = np.unique(cells[:, :len(LABELERS)], axis=0, return_inverse=True)
            prior, table = estimate_reliability(patterns, np.bincount(of.ravel(), n, len(patterns)))
            share = np.concatenate([_class_one(patterns, prior, table)[of.ravel()], _class_one(every, prior, table)])
            self.weights[kind] = fit_logistic(features(np.concatenate([cells, bare])), share, np.concatenate([n, np.full(len(every), unseen_weight)]))
            self.prior[kind], self.reliability[kind] = prior, table

    def score(self, kind: str, cells: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(cells) @ self.weights[kind], -30, 30)))


def train_spans(docs: DataFrame, text_col: str = "text") -> SpanModel:
    """The model of a corpus.  What reaches the driver is one row per vote and shape pattern, however large the corpus."""
    ship(docs.sparkSession)
    return SpanModel(stored(vote_counts(docs, text_col), "span-votes").toPandas())


def added_spans(text: str, model: SpanModel, least: float = 0.95) -> list[tuple[str, int, int, float]]:
    """Spans beyond the base ones, apart from these and each other: the classifier is sure, the check is
    not against them, and a cue beside them, or check and gazetteer together, speak for them."""
    found = candidates(text)
    base = [(s, e) for _, s, e, r in found if r == 1]
    wider = [(k, s, e, votes(text, k, s, e, r)) for k, s, e, r in found if r != 1]
    sure = []
    for kind, start, end, v in wider:
        if v[1] >= 0 and v[3] >= 0 and (v[3] == 1 or v[1] == v[2] == 1):
            p = float(model.score(kind, np.array([[*v, *shape(text, kind, start, end)]]))[0])
            if p >= least:
                sure.append((-p, start, end, kind))
    out: list[tuple[str, int, int, float]] = []
    for p, start, end, kind in sorted(sure):
        if all(end <= s or e <= start for s, e in base) and all(end <= s or e <= start for _, s, e, _ in out):
            out.append((kind, start, end, -p))
    return out


def written(spans: list[tuple[str, int, int]]) -> str:
    """``kind:start:end`` by start, then kind in the order of ``KINDS``, joined by commas."""
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def find_personal_data(docs: DataFrame, model: SpanModel | None = None, least: float = 0.95, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` of every row.

    The counts and the digest are those of the base spans; ``spans`` holds all,
    in code points.  Null and empty texts have none; texts of any length are read
    whole, in linear time; repeated rows and null ids are rows of their own; an
    empty table gives no rows.  Other columns are ignored.
    """
    ship(docs.sparkSession)
    trained = train_spans(docs, text_col) if model is None else model

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text in b["text"]:
                base = [(k, s, e) for k, s, e, passed in rule_matches(text) if passed] if ANY.search(text) else []
                added = [x[:3] for x in added_spans(text, trained, least)]
                rows.append((*[sum(k == kind for k, _, _ in base) for kind in KINDS], hashlib.sha256(written(base).encode()).hexdigest(), written(base + added), len(added)))
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return texts.mapInPandas(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
