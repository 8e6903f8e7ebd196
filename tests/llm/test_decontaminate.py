import random

import pytest
from data import docs

from profila.llm import decontaminate as D


def items(rng, n=30):
    return [(k, " ".join(f"b{rng.randrange(300)}" for _ in range(rng.randrange(8, 40)))) for k in range(n)]


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        at, how = rng.randrange(len(out)), rng.randrange(3)
        out[at:at + (how != 0)] = [f"e{rng.randrange(999)}"] if how < 2 else []
    return out


def planted(seed=5, n=120):
    rng = random.Random(seed)
    bench = items(rng)
    rows, want = [], set()
    for i in range(n):
        w = [f"b{rng.randrange(300)}" if rng.random() < 0.4 else f"d{rng.randrange(3000)}" for _ in range(rng.randrange(3, 300))]
        if i % 2:
            k = rng.randrange(len(bench))
            item = bench[k][1].split()
            at = rng.randrange(len(w))
            w[at:at] = edited(rng, item, rng.randrange(D.budget(len(item)) + 1))
            want.add((i, k))
        rows.append((i, " ".join(w), "s"))
    return bench, rows, want


def brute(bench, rows):
    out = {}
    for i, t, _ in rows:
        words = D.tokens(t)
        for k, b in bench:
            item = D.tokens(b)
            if len(item) >= 3:
                e, s, x = D.closest(item, words)
                if e <= D.budget(len(item)):
                    out[(i, k)] = e
    return out


def test_against_all_windows(spark):
    bench, rows, want = planted()
    got = D.contaminated(docs(spark, rows), spark.createDataFrame(bench, "item_id long, text string")).collect()
    truth = brute(bench, rows)
    assert want <= set(truth)
    found = {(r.doc_id, r.item_id): r.edits for r in got}
    assert set(found) <= set(truth) and len(found) >= 0.98 * len(truth)
    assert all(found[p] == truth[p] for p in found)
    texts = {i: t for i, t, _ in rows}
    for r in got:
        item = D.tokens(dict(bench)[r.item_id])
        assert D.closest(item, D.tokens(texts[r.doc_id][r.start:r.end]))[0] == r.edits


def test_blocks_of_items_give_the_same(spark):
    bench, rows, _ = planted(6, 60)
    df, b = docs(spark, rows), spark.createDataFrame(bench, "item_id long, text string")
    one, many = ({(r.doc_id, r.item_id) for r in D.contaminated(df, b, block_items=n).collect()} for n in (1000, 7))
    assert one == many
    kept = D.without_leaks(df, b, block_items=7)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, _, _ in rows} - {d for d, _ in one}


def test_window_condition_loses_nothing():
    bench, rows, _ = planted(7, 80)
    index = D.Index(bench)
    for i, t, _ in rows:
        words = D.tokens(t)
        import numpy as np
        ids = np.array([index.number.get(w, 0) for w in words] + [0] * 100)
        windows = {n: set(s.tolist()) for n, s in index.windows(ids)}
        for k, b in bench:
            item = D.tokens(b)
            e, s, x = D.closest(item, words)
            if e <= D.budget(len(item)):
                assert any(s - len(item) <= w <= x for w in windows.get(len(item), ()))


@pytest.mark.parametrize("text", [None, "", "...", "one two"])
def test_texts_without_leaks(text):
    assert D.Index([(1, "a b c d e f g h")]).search([text, text]) == [[], []]


def test_null_items_and_empty_tables(spark):
    b = spark.createDataFrame([(1, None), (2, ""), (None, "q1 q2 q3 q4 q5 q6 q7"), (3, "z y")], "item_id long, text string")
    df = docs(spark, [(None, "x q1 q2 q3 q4 q5 q6 q7 " + "x " * 40_000, None), (1, None, "a"), (1, "z y", "a"), (1, "z y", "a")])
    got = D.contaminated(df, b).collect()
    assert [(r.doc_id, r.item_id, r.edits, r.start, r.end) for r in got] == [(None, None, 0, 2, 22)]
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(df, none).count() == 0 and D.without_leaks(df, none).count() == 4
    assert D.contaminated(docs(spark, []), b).count() == 0


def test_short_items_need_exact_words():
    index = D.Index([(1, "a1 b1 c1 d1"), (2, "k1 k2 k3 k4 k5")])
    assert [x["item_id"] for x in index.search(["z a1 b1 c1 d1 z k1 k2 kx k4 k5"])[0]] == [1]


@pytest.mark.parametrize("most", [24, 4])
def test_every_length_reaches_the_target(monkeypatch, most):
    """A mixed benchmark; with few walks long items are verified without sampling."""
    monkeypatch.setattr(D, "MAX_WALKS", most)
    rng = random.Random(9)

    def text(n):
        return [f"v{rng.randrange(5000)}" for _ in range(n)]
    items = [text(12) for _ in range(150)] + [text(n) for n in (50, 50, 150, 150, 400, 400)]
    index = D.Index([(i, " ".join(w)) for i, w in enumerate(items)])
    assert most == 24 or 400 in index.exact
    assert all(n in index.exact or len(t) // D.TABLES_A_WALK >= 1 for n, t in index.tables.items())
    tried, hit = {}, {}
    for i in [*range(0, 150, 2), *range(150, 156)] + [*range(150, 156)] * 9:
        w = list(items[i])
        for _ in range(D.budget(len(w))):
            at, how = rng.randrange(len(w)), rng.randrange(3)
            w[at:at + (how != 0)] = [f"new{rng.randrange(99)}"] if how < 2 else []
        found = index.search([" ".join(text(30) + w + text(30))])[0]
        tried[len(items[i])] = tried.get(len(items[i]), 0) + 1
        hit[len(items[i])] = hit.get(len(items[i]), 0) + any(x["item_id"] == i for x in found)
    assert all(hit[n] >= 0.95 * tried[n] for n in tried), (hit, tried)
