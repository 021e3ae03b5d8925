"""Toxicity by a weighted finite-state grammar over clauses.

Four small transducers read the symbols of a clause: insults, threats that meet
a target, negation with a short reach, and reported speech up to the clause's
end.  Their composition is one table of states; an insult or threat comes out
as a match of the kind that the composed state says (plain, targeted, negated,
reported, threat).  The lexicon that turns words into insult symbols, whole
words and word stems with weights, is learned from labelled documents, as are
the weights of the match kinds (logistic regression).
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.llm.tables import ship, stored, text_or_empty

WORD = re.compile(r"[^\W\d_]+")
CLAUSE_END = re.compile(r"[.!?;:\n]+")
STEM_LENGTHS = range(3, 9)
#: Function words of the grammar.
TARGETS = frozenset("you your yours yourself u they them their these those he she him her du dich dir dein deine ihr euch euer sie ihn toi vous votre vos ton tes ils elles tu te usted ustedes ellos ellas".split())
NEGATIONS = frozenset("not no never nobody neither nor cannot isn aren wasn weren don doesn didn nicht kein keine keinen nie niemals ne pas jamais aucun nunca jamás ningún ninguna tampoco".split())
REPORTS = frozenset("said says say saying told tells quoted quote wrote writes called claimed reported reportedly allegedly sagte sagt schrieb meinte behauptete dit disait écrit selon dijo dice escribió según".split())
THREATS = frozenset("kill hurt destroy beat burn shoot stab strangle murder töten schlagen vernichten umbringen tuer frapper brûler détruire matar golpear quemar destruir".split())

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)
KINDS = ("plain", "targeted", "negated", "reported", "threat")


@dataclass(frozen=True)
class Transducer:
    """A component: ``step(state, symbol) -> state`` over ``states`` states, starting in 0."""
    states: int
    step: object


def _decay(symbol: int, reach: int):
    return lambda state, s: reach if s == symbol else max(0, state - 1)


def _hold(symbol: int):
    return lambda state, s: 1 if s == symbol else state


COMPONENTS = {
    "target": Transducer(2, _hold(TARGET)),
    "threat": Transducer(5, _decay(THREAT, 4)),
    "negation": Transducer(4, _decay(NEGATION, 3)),
    "report": Transducer(2, _hold(REPORT)),
}


def compose() -> tuple[np.ndarray, np.ndarray]:
    """(next state, kind emitted or -1) for each composed state and symbol."""
    parts = list(COMPONENTS.values())
    states = list(product(*[range(p.states) for p in parts]))
    number = {s: i for i, s in enumerate(states)}
    following, emitted = np.zeros((len(states), 6), np.int32), np.full((len(states), 6), -1, np.int32)
    for s in states:
        for symbol in range(6):
            target, threat, negation, report = s
            following[number[s], symbol] = number[tuple(p.step(x, symbol) for p, x in zip(parts, s))]
            if symbol == INSULT:
                kind = "reported" if report else "negated" if negation else "targeted" if target else "plain"
                emitted[number[s], symbol] = KINDS.index(kind)
            elif symbol == TARGET and threat and not negation and not report:
                emitted[number[s], symbol] = KINDS.index("threat")
    return following, emitted


FOLLOWING, EMITTED = compose()


@dataclass
class Lexicon:
    """Insults: weights of whole words and of word stems."""
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        self.lengths = sorted({len(s) for s in self.stems})
        hits = [re.escape(w) + r"(?![^\W\d_])" for w in sorted(self.words)] + [re.escape(s) for s in sorted(self.stems)]
        hits += [re.escape(w) + r"(?![^\W\d_])" for w in sorted(THREATS)]
        self.any = re.compile(r"(?<![^\W\d_])(?:" + "|".join(hits) + ")")

    def symbol(self, word: str) -> tuple[int, float]:
        weight = self.words.get(word)
        if weight is None:
            weight = max((self.stems[word[:n]] for n in self.lengths if word[:n] in self.stems), default=None)
        if weight is not None:
            return INSULT, weight
        return (TARGET if word in TARGETS else NEGATION if word in NEGATIONS else REPORT if word in REPORTS else THREAT if word in THREATS else OTHER), 0.0


def clause_matches(text: str, lexicon: Lexicon) -> np.ndarray:
    """Summed weight of the matches of each kind, over all clauses of the whole text."""
    low = text.lower()
    found = np.zeros(len(KINDS))
    at = 0
    while (hit := lexicon.any.search(low, at)) is not None:
        # only a clause with an insult or a threat can match
        begin = max((m.end() for m in _ends_before(low, at, hit.start())), default=at)
        end = CLAUSE_END.search(low, hit.end())
        stop = end.start() if end else len(low)
        state = 0
        for m in WORD.finditer(low, begin, stop):
            symbol, weight = lexicon.symbol(m[0])
            kind = EMITTED[state, symbol]
            if kind >= 0:
                found[kind] += weight if symbol == INSULT else 1.0
            state = FOLLOWING[state, symbol]
        at = max(stop, hit.end())
    return found


def _ends_before(text: str, low: int, high: int) -> list:
    """The last clause end in text[low:high], looked for from the right in growing steps."""
    step = 200
    while True:
        start = max(low, high - step)
        marks = list(CLAUSE_END.finditer(text, start, high))
        if marks or start == low:
            return marks[-1:]
        step *= 4


def document_features(matches: np.ndarray) -> np.ndarray:
    return np.concatenate([np.log1p(matches), [np.log1p(matches.sum())]])


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        z = float(document_features(clause_matches(text, self.lexicon)) @ self.weights) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Newton steps; classes weigh alike, weights of matches are never negative."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    ridge = penalty * np.eye(a.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (share * (p - y)) + ridge @ w
        curve = (a * (share * p * (1 - p))[:, None]).T @ a + ridge
        step = np.linalg.solve(curve, slope)
        w -= step
        w[:-1] = np.maximum(w[:-1], 0)
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def training_rows(labels: DataFrame, most_rows: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``most_rows`` labelled ids outside the held-out third, chosen by hash."""
    doc_id = F.col(f"`{id_col}`").cast("long")
    rows = labels.select(doc_id.alias("l_id"), F.col("toxic").cast("int").alias("toxic")).filter("l_id is not null and toxic in (0, 1)")
    rows = rows.filter(F.pmod(F.crc32(F.col("l_id").cast("string")), F.lit(3)) != 1)
    return rows.groupBy("l_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("l_id"), "l_id").limit(most_rows)


def learn_lexicon(sample: DataFrame, least_odds: float = 2.5, prior: float = 3.0, least_contexts: int = 3, most_entries: int = 3000) -> Lexicon:
    """Words and stems that mark toxic documents of ``sample(text, toxic)``.

    A word counts once per document, a stem once per word.  Support is measured
    in distinct preceding words (a 64-bit sketch), since copies of one toxic
    document repeat all its words but in one context only.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict = defaultdict(lambda: [0, 0, 0])
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = WORD.findall(text.lower())
                for w in set(words):
                    seen[w][toxic] += 1
                for before, w in zip(["", *words], words) if toxic else ():
                    seen[w][2] |= 1 << (crc32(before.encode()) % 63)
            yield pd.DataFrame([(w, c, t, x) for w, (c, t, x) in seen.items()], columns=["part", "clean", "toxic", "contexts"])
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_clean, n_toxic = totals.get(0, 0), totals.get(1, 0)
    added = [F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.bit_or("contexts").alias("contexts")]
    words = stored(sample.select("text", "toxic").mapInPandas(count, "part string, clean long, toxic long, contexts long").groupBy("part").agg(*added), "lexicon-words")
    stems = words.select("clean", "toxic", "contexts", F.explode(F.transform(F.filter(F.array(*map(F.lit, STEM_LENGTHS)), lambda n: n <= F.char_length("part")),
                                                                            lambda n: F.substr("part", F.lit(1), n))).alias("part")).groupBy("part").agg(*added)
    filled = F.bit_count("contexts")
    support = F.when(filled < 55, F.least(F.col("toxic").cast("double"), -63 * F.log(1 - filled / 63.0))).otherwise(F.col("toxic").cast("double"))
    odds = F.log((F.col("support") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + prior) / (n_clean + 1.0))
    both = words.select(F.lit("w").alias("kind"), *words.columns).unionByName(stems.select(F.lit("s").alias("kind"), *stems.columns))
    rows = (both.filter(filled >= least_contexts).withColumn("support", support).withColumn("odds", odds).filter(F.col("odds") >= least_odds)
            .orderBy(F.desc("odds"), "kind", "part").limit(most_entries).select("kind", "part", "support", "odds").collect())
    return pick_entries([tuple(r) for r in rows])


def pick_entries(rows: list[tuple[str, str, float, float]]) -> Lexicon:
    """From ``(kind, part, support, odds)``: stems that several words share, and words no stem covers."""
    stems = {p: (s, o) for k, p, s, o in rows if k == "s"}
    words = {p: (s, o) for k, p, s, o in rows if k == "w"}
    chosen: dict[str, float] = {}
    for stem in sorted(stems, key=lambda x: (len(x), x)):
        if any(stem[:n] in stems for n in range(STEM_LENGTHS[0], len(stem))):
            continue
        best = stem  # lengthen while one extension keeps the support
        while longer := [s for s in stems if len(s) == len(best) + 1 and s.startswith(best) and stems[s][0] >= 0.98 * stems[best][0]]:
            best = longer[0]
        under = [w for w in words if w.startswith(best)]
        if len(under) == 1 and words[under[0]][0] >= 0.9 * stems[best][0]:
            continue  # one word, not a stem
        chosen[best] = stems[best][1]
    covered = lambda w: any(w[:n] in chosen for n in range(STEM_LENGTHS[0], len(w) + 1))
    return Lexicon({w: v[1] for w, v in words.items() if not covered(w)}, chosen)


def train_toxicity(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Fit on at most ``most_rows`` labelled documents outside the held-out third; counts and features are made by Spark."""
    ship(docs.sparkSession)
    picked = F.broadcast(training_rows(labels, most_rows))  # bounded by ``most_rows``
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("l_id"), text_or_empty(text_col).alias("text"))
    sample = texts.join(picked, "l_id")
    lexicon = docs.sparkSession.sparkContext.broadcast(learn_lexicon(sample))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"l_id": batch["l_id"], "toxic": batch["toxic"], "x": [document_features(clause_matches(t, lexicon.value)) for t in batch["text"]]})
    rows = sample.mapInPandas(features, "l_id long, toxic int, x array<double>").orderBy("l_id", "toxic", "x").collect()  # bounded likewise
    if not rows:
        return ToxicityModel(lexicon.value, np.zeros(len(KINDS) + 1), -2.0)
    weights, bias = _fit_logistic(np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], float))
    return ToxicityModel(lexicon.value, weights, bias)


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Null and empty texts score as a text without matches.  Rows without an id
    are not held out.  Repeated rows repeat their result; other columns are
    ignored.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([held.value.score(t) for t in texts], dtype="float64")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), score(text_or_empty(text_col)).alias("score"))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    return rows.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_harmless(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` below the threshold, with their own columns."""
    model = docs.sparkSession.sparkContext.broadcast(train_toxicity(docs, labels, id_col=id_col, text_col=text_col))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.value.score(t) for t in texts], dtype="float64")
    return docs.filter(score(text_or_empty(text_col)) < threshold)
