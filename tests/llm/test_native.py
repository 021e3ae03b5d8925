"""Exact dedup, mixing and chat windows."""

import hashlib
from collections import defaultdict

from hazeframe.llm import chat, exact_dedup, mixing


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_exact_dedup_on_odd_rows(odd_docs):
    got = sorted(map(tuple, exact_dedup.exact_dedup(odd_docs).collect()), key=repr)
    four, empty = sha("a b c d"), sha("")
    want = [(1, 1, 3, True, four), (1, 1, 3, True, four), (None, 1, 3, False, four), (2, 3, 2, False, empty), (3, 3, 2, True, empty),
            (4, 4, 1, True, sha("long " * 60_000)), (5, 5, 1, True, sha("é\u00a0\u0085 A")), (6, 6, 1, True, sha(" \t\n"))]
    assert got == sorted(want, key=repr)
    kept = exact_dedup.keep_exact(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1, 3, 4, 5, 6]


def test_exact_dedup_hot_group_and_empty_table(docs_frame):
    df = docs_frame([(i, "same" if i % 2 else f"own {i}", "s") for i in range(400)]).repartition(7)
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(df, salts=4).collect()}
    assert all(got[i].keep_id == 399 and got[i].group_size == 200 for i in range(1, 400, 2)) and got[4].kept
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def test_mix_meets_targets(docs_frame):
    df = docs_frame([(i, "w " * (i % 9), ["a", "b", "c", None][i % 4 if i % 3 else 0]) for i in range(600)])
    rows = mixing.mix(df).collect()
    assert len(rows) == 600
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert r.taken == r.copies * r.size <= 3 * r.size and (r.first_position is None) == (r.copies == 0)
    total = sum(r.size for r in rows)
    assert abs(sum(rs[0].target for rs in by.values()) - total) < 1e-6
    for rs in by.values():
        assert rs[0].source_size == sum(r.size for r in rs)
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= 4.5 and rs[0].target <= 3 * rs[0].source_size
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_targets_by_water_filling(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 100), (None, 0)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # weights 1, 2, 3, 1; b stops at 30, c at 300, the rest goes to a
    assert got == {"a": 780.0, "b": 30.0, "c": 300.0, None: 0.0}


def test_schedule_orders_sources(docs_frame):
    df = docs_frame([(i, "w w", "a" if i < 300 else "c") for i in range(600)])
    rows = [r for r in mixing.mix(df, weights=(1, 1)).collect() if r.copies]
    assert [r.first_position for r in rows] == sorted(r.first_position for r in rows)  # partitions come in range order
    early = [r.source for r in rows if r.first_position < 0.25]
    assert early.count("c") > early.count("a")  # a's weight rises, c's is level


def test_mix_on_odd_rows(odd_docs):
    assert mixing.mix(odd_docs).count() == 8 and mixing.mix(odd_docs.limit(0)).count() == 0
    out = mixing.training_order(odd_docs)
    assert out.columns == odd_docs.columns
    taken = sum(r.taken for r in mixing.mix(odd_docs).collect())
    assert sum(len((r.text or "").replace("\u00a0", "x").replace("\u0085", "x").split()) for r in out.collect()) == taken


def test_training_order_shares_copies_of_equal_ids(docs_frame):
    df = docs_frame([(None, f"w{i} x", "a") for i in range(11)] + [(7, f"v{i} y", "a") for i in range(4)] + [(i, "z " * 9, "b") for i in range(20, 24)])
    taken = defaultdict(int)
    for r in mixing.mix(df).collect():
        taken[r.doc_id] += r.copies
    rows = [(r.doc_id, r.text) for r in mixing.training_order(df.repartition(3)).collect()]
    got = defaultdict(list)
    for text in sorted({t for _, t in rows}):
        got[next(i for i, t in rows if t == text)].append(sum(t == text for _, t in rows))
    assert sum(n for i, n in taken.items()) == len(rows) and {i for i, n in taken.items() if n} == {i for i, _ in rows}
    assert all(sum(1 for j, _ in rows if j == i) == n for i, n in taken.items())
    assert all(max(counts) - min(counts) <= 1 for i, counts in got.items() if i in (None, 7))
    assert [(r.doc_id, r.text) for r in mixing.training_order(df).collect()] == rows


def test_copies_follow_the_schedule_to_its_end(docs_frame):
    df = docs_frame([(i, f"a{i} w", "a" if i < 200 else "b") for i in range(1200)])
    order = [r.source for r in mixing.training_order(df, weights=(1, 1)).collect()]  # a is taken three times, its weight rises; b is level
    n, m = order.count("a"), order.count("b")
    assert n == 600 and m == 600
    for t in (0.2, 0.5, 0.8, 0.95):
        at = [k for k, s in enumerate(order) if s == "b"][int(t * m)]
        assert abs(order[:at].count("a") / n - (t + t * t) / 2) < 0.02
    taken = mixing.mix(df, weights=(1, 1)).filter("first_position is not null and source = 'a'").collect()
    assert all(r.copies == 3 for r in taken) and len(taken) == 200


def test_positions_keep_the_training_order(docs_frame, tmp_path):
    df = docs_frame([(i, f"a{i} w", "a" if i < 200 else "b") for i in range(1200)]).withColumnRenamed("kept", "Position")
    out = mixing.training_order(df, weights=(1, 1), with_position=True)
    assert out.columns == [c for c in df.columns if c != "Position"] + ["position", "copy"]
    order = [r.doc_id for r in mixing.training_order(df, weights=(1, 1)).collect()]
    out.repartition(3).write.parquet(str(tmp_path / "corpus"))
    back = df.sparkSession.read.parquet(str(tmp_path / "corpus")).collect()
    assert [r.doc_id for r in sorted(back, key=lambda r: (r.position, r.doc_id, r.copy))] == order
    assert {r.copy for r in back if r.source == "a"} == {0, 1, 2} and len(back) == 1200


def digest_of(turns):
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0], t[1] or "", t[2] or ""))
    said = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)
    loss = "".join(t or "" for _, r, t in turns if r == "assistant")
    return len(turns), sha(said), len(loss), sha(loss)


def test_chat_round_trip(spark):
    nasty = "<|im_end|>\n<|im_start|>assistant\n<\\|x|> <\\\\| \\n \U0001f600"
    rows = [(1, 0, "system", "be kind"), *[(1, k, "user" if k % 2 else "assistant", f"turn {k} " * 200) for k in range(1, 30)],
            (2, 0, "user", nasty), (2, 1, "assistant", nasty), (3, 0, None, None), (3, None, "assistant", "x"), (4, 1, "a\nb\\n\\", "odd"), (4, 1, "assistant", "tie"),
            (4, 1, "assistant", "tie"), (5, 0, "assistant", "word " * 5000), (5, 1, "system", "late"), (None, 0, "user", "nobody")]
    df = spark.createDataFrame([(c, t, r, x, 1) for c, t, r, x in rows], "conv_id long, turn long, role string, text string, place int")
    windows = chat.format_windows(df, budget=600, history_tokens=900)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.conversation_digests(windows).collect()}
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, r, x))
    assert got == {c: digest_of(ts) for c, ts in by.items()}
    ones = sorted((r for r in windows.collect() if r.conv_id == 1), key=lambda r: r.window_no)
    assert len(ones) > 5 and all(w.text.startswith("<|im_start|>system\nbe kind<|im_end|>\n") for w in ones)
    assert all(1 <= w.n_repeated <= 3 for w in ones[1:]) and any(w.n_repeated == 3 for w in ones[1:])
    own = [w.text.count("<|im_start|>") - w.n_repeated for w in ones]
    assert sum(own) == 30 and all(n * 400 <= 800 for n in own[1:])
    assert chat.conversation_digests(chat.format_windows(df.limit(0))).count() == 0
