import math
import random
import zlib

import numpy as np
import pandas as pd
from data import docs

from profila.llm import toxicity
from profila.llm.toxicity import Model, score_text

LABELS = "doc_id long, quality int, toxic int"


def labelled(n=500, seed=3):
    """Texts with one bad sentence among clean ones; four bad words and a
    family of words with a common beginning."""
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        parts = [" ".join(f"w{rng.randrange(60)}" for _ in range(6)) + "." for _ in range(rng.randrange(1, 12))]
        y = int(rng.random() < 0.25)
        if y:
            bad = rng.choice(["vile", "rotten", "nasty", f"zork{rng.randrange(50)}"])
            parts.insert(rng.randrange(len(parts) + 1), f"you {bad} w{rng.randrange(60)}.")
        rows.append((i, " ".join(parts), f"src{i % 3}"))
        labels.append((i, 1, y))
    return rows, labels


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy_and_location(spark):
    rows, labels = labelled()
    df = docs(spark, rows)
    model = toxicity.fit(df, spark.createDataFrame(labels, LABELS))
    got = {r.doc_id: r for r in toxicity.classify(df, model).collect()}
    y = {i: t for i, _, t in labels}
    assert len(got) == len(rows)
    assert all(got[i].held_out == is_held_out(i) and got[i].predicted == int(got[i].score >= 0.7) and 0 <= got[i].score <= 1 for i in got)
    apart = [i for i in got if got[i].held_out]
    assert sum(got[i].predicted == y[i] for i in apart) >= 0.97 * len(apart)
    for i, text, _ in rows:
        if got[i].predicted and y[i]:
            assert any("you " in text[s.start:s.end] for s in got[i].sentences)
    kept = toxicity.without_toxic(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i in got if not got[i].predicted}


def test_held_out_labels_are_never_read(spark):
    rows, labels = labelled(200)
    df = docs(spark, rows)
    other = [(i, q, 1 - t if is_held_out(i) else t) for i, q, t in labels]
    a, b = (toxicity.fit(df, spark.createDataFrame(x, LABELS)) for x in (labels, other))
    assert a == b


def test_long_clean_text_stays_clean(spark):
    rows, labels = labelled(300)
    model = toxicity.fit(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    assert score_text("w1 w2 w3 w4. " * 20_000, model)[0] < 0.7
    assert score_text("w1 w2. " * 20_000 + "you vile w3.", model)[0] >= 0.7


def test_noisy_or():
    model = Model({"bad": 0}, [10.0], -9.0, 0.1)
    p, found = score_text("Fine words. Bad word! fine", model)
    assert [(s, e) for s, e, _ in found] == [(11, 20)]
    import math
    ps = [1 / (1 + math.exp(9)), 1 / (1 + math.exp(-1)), 1 / (1 + math.exp(9))]
    assert abs(p - (1 - math.exp(-0.1) * math.prod(1 - x for x in ps))) < 1e-12


def test_nulls_empty_tables_and_single_class(spark):
    rows = [(1, None, None), (2, "", "a"), (None, "you vile", "a"), (3, "x " * 50_000, "a"), (3, "x " * 50_000, "a")]
    none = spark.createDataFrame([], LABELS)
    df = docs(spark, rows)
    model = toxicity.fit(df, none)
    got = toxicity.classify(df, model).collect()
    assert len(got) == 5 and all(r.score == 0.0 for r in got) and not any(r.held_out for r in got if r.doc_id is None)
    labels = spark.createDataFrame([(3, 1, 1), (2, None, 1), (None, 1, 1), (1, 1, None), (99, 1, 0)], LABELS)
    assert all(0 <= r.score <= 1 for r in toxicity.classify(df, toxicity.fit(df, labels)).collect())
    empty = docs(spark, [])
    assert toxicity.classify(empty, toxicity.fit(empty, none)).count() == 0


def test_clean_text_of_any_length_stays_clean(spark):
    rows, labels = labelled(300)
    model = toxicity.fit(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    clean = score_text("w1 w2 w3 w4.\n" * 100_000, model)[0]
    assert clean < 0.7 and clean == score_text("w1 w2 w3 w4.", model)[0]
    assert score_text("w1 w2.\n" * 100_000 + "you vile w3.", model)[0] >= 0.7
    some = Model({"bad": 0, "even": 1, "good": 2}, [10.0, 0.1, -2.0], -9.0, 0.1, toxicity.LEAST)
    assert score_text("even so.\ngood.\nplain.\n" * 100_000, some)[0] == score_text("", some)[0]


def plain_loss(theta, bags, prior, l2):
    """Negative log likelihood of a leaky noisy-or, document by document."""
    w, bias, leak = theta[:-2], theta[-2], math.exp(theta[-1])
    loss = l2 / 2 * float(((w - prior) ** 2).sum())
    for y, sentences in bags:
        clean = math.exp(-leak)
        for ids in sentences:
            clean *= 1 - 1 / (1 + math.exp(-(bias + sum(w[i] for i in ids))))
        loss -= math.log(1 - clean) if y else math.log(clean)
    return loss


def slope(theta, *rest, h=1e-5):
    out = []
    for k in range(len(theta)):
        step = np.zeros(len(theta))
        step[k] = h
        out.append((plain_loss(theta + step, *rest) - plain_loss(theta - step, *rest)) / (2 * h))
    return np.array(out)


def test_steps_follow_the_plain_likelihood():
    rng = np.random.default_rng(5)
    n = 12
    bags = [(int(rng.random() < 0.4), [sorted(set(rng.integers(0, n, rng.integers(1, 4)).tolist())) for _ in range(rng.integers(0, 6))])
            for _ in range(80)]
    pdf = pd.DataFrame({"y": [y for y, _ in bags], "ids": [s for _, s in bags]})
    prior = rng.uniform(0, 8, n)
    for _ in range(5):  # a first step goes by its rate against the slope's sign
        start = np.append(rng.uniform(0, 10, n), [-10.0, math.log(rng.uniform(0.05, 1))])
        new, by = toxicity._steps(pdf, start, prior, 1, 0.01, 1.0)
        want = slope(start, bags, prior, 1.0)
        clear = np.abs(want) > 1e-3
        assert clear.sum() > n / 2 and (np.sign(start - new) == np.sign(want))[clear].all()
        assert by[:n].tolist() == [sum(i in s for _, d in bags for s in d) for i in range(n)]
    new, _ = toxicity._steps(pdf, start, prior, 6000, 0.02, 1.0)
    left = slope(new, bags, prior, 1.0)
    assert plain_loss(new, bags, prior, 1.0) < plain_loss(start, bags, prior, 1.0)
    assert np.abs(left[:-2]).max() < 0.05 and abs(left[-1]) < 0.05  # the bias stays at its bound or below
