"""Prefix trie, spelling variants and personal data against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from hazeframe.llm import personal_data, prefix_trie, spelling
from hazeframe.llm.tables import WORD

TURNS = "conv_id long, turn long, role string, text string, part int, depth long, a string, k int"


def brute_trie(rows, family=20, most=4):
    turns = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append(((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}:{x}".encode()).hexdigest()), (r, x)))
    turns = {c: [v for _, v in sorted(found)] for c, found in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % most
        path = tuple(turns.get(c - (c % family if c >= 0 else -(-c % family)), [])[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(re.findall(WORD, p[-1][1])) if p else 0
            leaves[p[:d]] += children[p] == 0
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=repr)


@pytest.mark.parametrize("block", [2, 4])
def test_trie_against_brute_force(spark, block):
    rng, rows = random.Random(block), []
    for c in range(-30, 330):
        for t in range(1 if c > 300 else rng.choice([1, 2, 3, 4, 5, 8, 9, 13, 30])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["u", "u", "u", None]), "w " * rng.randrange(0, 3) if t < 20 else "same same"))
    rows += [(None, 1, "u", "x"), (1000, 1, None, None), (1001, 0, "u", "long " * 50_000), (1001, 0, "u", "long " * 50_000)]
    rows += [(2000 + 40 * c, t, "u", "one common conversation") for c in range(300) for t in range(6)]  # chains of id ranges
    df = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], TURNS).repartition(5)
    got = sorted(map(tuple, prefix_trie.conversation_trie(df, block=block).collect()), key=repr)
    assert got == brute_trie(rows)


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.conversation_trie(empty).count() == 0
    turnless = spark.createDataFrame([(41, 1, "u", "x", 1, 2, "x", 3)], TURNS)  # 41: h is 3, conversation 40 is absent
    assert [tuple(r) for r in prefix_trie.conversation_trie(turnless).collect()] == brute_trie([(41, 1, "u", "x")])


def brute_words(docs, ratio=10):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(x.lower() if x.isascii() else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n > 1}

    def near(a, b):
        p = 0
        while p < min(len(a), len(b)) and a[p] == b[p]:
            p += 1
        return a != b and (a[p + 1:] == b[p + 1:] or a[p + 1:] == b[p:] or a[p:] == b[p + 1:])
    forms, found = {}, {}
    for w in counts:
        found[w] = [x for x in counts if abs(len(x) - len(w)) < 2 and near(w, x)]
        best = min(found[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, counts[w], len(found[w]), counts.get(forms[w])))
    return sorted(out)


def test_spelling_against_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abéz") for _ in range(rng.randrange(6, 10))) for _ in range(40)] + ["aaaaaaaa", "aaaaaaab"]

    def changed(w):
        k = rng.randrange(len(w))
        return rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abÉz×") + w[k:], w[:k] + rng.choice("abéÿ") + w[k + 1:]])
    docs = []
    for i in range(150):
        words = []
        for _ in range(60):
            w = rng.choice(base)
            while rng.random() < 0.4:
                w = changed(w)
            words.append(w.capitalize() if rng.random() < 0.1 else w)
        docs.append((i, " ".join(words)))
    long = "ab" * 3000
    docs += [(900, None), (901, ""), (902, f"{long} {long} {long}b {long}b"), (902, f"{long} {long}"), (None, "abababab abababab")]
    df = spark.createDataFrame([(*d, 1, "w") for d in docs], "doc_id long, text string, n int, word string").repartition(4)
    want = brute_words(docs)
    assert sum(r[1] is not None for r in want) > 50 and max(r[4] for r in want) > 10
    for letters in (400_000, 5_000):  # one shard; keys that must be cut again
        assert sorted(map(tuple, spelling.spelling_variants(df, shard_letters=letters).collect())) == want
    assert spelling.spelling_variants(df.limit(0)).count() == 0


RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_base(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))) or (kind == "phone" and 9 <= len(digits) <= 15):
                out.append((kind, *m.span()))
            if kind == "card" and 12 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0:
                out.append((kind, *m.span()))
    return out


def test_base_rules_equal_the_plain_patterns():
    rng = random.Random(1)
    for alphabet in ("a.@-b", "1.2 5-", "+12 ().-", "a@1.+ -(é"):
        for _ in range(8000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert [x[:3] for x in personal_data.rule_matches(text) if x[3]] == brute_base(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000 + "@" + "b-" * 100_000, "1" * 300_000, "0" * 5000 + ".1.1.1", "1." * 150_000, "+1" + "(" * 300_000, "(12)" * 80_000, "a@b." * 80_000):
        personal_data.candidates(text)


def with_luhn(rng):
    head = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(head + d for d in "0123456789" if personal_data.luhn(head + d))


def test_spans_of_a_corpus(spark):
    rng, docs, hidden = random.Random(7), [], {}
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(n))
    for i in range(600):
        wrong = with_luhn(rng)
        wrong = wrong[:-1] + str((int(wrong[-1]) + 3) % 10)
        bits = [f"jo.{i}@mail{i % 9}.example.com", f"{rng.randrange(11, 200)}.{i % 256}.7.{i % 99}", with_luhn(rng), f"+1 ({i:03d}) 555-{1000 + i}", wrong, f"x{i}y44", f"300.1.{i}.9"]
        docs.append((i, f"é {words(9)} {rng.choice(bits)} {words(5)} {rng.choice(bits)}. {words(3)}"))
    spelled = ("mail anna.b [at] post [dot] com now", "anna.b [at] post [dot] com")
    fours = with_luhn(rng)
    spaced = f"{fours[:4]}.{fours[4:8]}.{fours[8:12]}.{fours[12:]}"
    for i, (text, span) in enumerate([spelled, (f"card {spaced} x", spaced), ("from 2001:db8:0:0:1:0:0:7 at", "2001:db8:0:0:1:0:0:7")]):
        hidden[1000 + i] = span
        docs.append((1000 + i, f"{words(4)} {text} {words(4)}"))
    docs += [(2000, None), (2001, ""), (None, "a@b.cc"), (None, "a@b.cc"), (2002, "12 " * 100_000), (2003, "born 2024-01-02, order 1234-5678-9012, version 1.2.3.400")]
    df = spark.createDataFrame([(*d, 0, "s") for d in docs], "doc_id long, text string, n_ip int, spans string").repartition(3)
    got = personal_data.find_personal_data(df).collect()
    assert len(got) == len(docs)
    texts = defaultdict(str, {i: t or "" for i, t in docs})
    for r in got:
        base = sorted(brute_base(texts[r.doc_id]), key=lambda x: (x[1], list(RULES).index(x[0])))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in base) for kind in RULES)
        plain = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(plain.encode()).hexdigest()
        if r.doc_id in hidden:
            start = texts[r.doc_id].index(hidden[r.doc_id])
            assert r.n_added == 1 and r.spans.split(":", 1)[1] == f"{start}:{start + len(hidden[r.doc_id])}"
        else:
            assert r.n_added == 0 and r.spans == plain
    assert personal_data.find_personal_data(df.limit(0)).count() == 0


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(0)
    true = rng.random(40_000) < 0.3
    right = [0.95, 0.9, 0.8, 0.7, 0.6]
    votes = np.stack([np.where(rng.random(len(true)) < q, true, ~true) * 2 - 1 for q in right], axis=1)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    prior, table = personal_data.estimate_reliability(patterns, n.astype(float))
    assert abs(prior - 0.3) < 0.02 and np.allclose(table[1, :, 2], right, atol=0.03) and np.allclose(table[0, :, 0], right, atol=0.03)
