import random

import numpy as np
import pytest
from data import corpus, docs, words

from profila.llm import lines as L


def plain(rows, similarity=0.8):
    """line → smallest line of its component, by all pairs."""
    unique = sorted({x for _, t, _ in rows for x in (t or "").split("\n") if x and not x.isspace()})
    sets, root = [L.shingles(x) for x in unique], list(range(len(unique)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(unique)):
        for j in range(i):
            if L.jaccard(sets[i], sets[j]) >= similarity:
                root[find(i)] = find(j)
    return {x: find(i) for i, x in enumerate(unique)}


def fuzzy(seed=6):
    rng, rows = random.Random(seed), []
    bases = [" ".join(words(rng, rng.randrange(4, 30))) for _ in range(12)]
    for i in range(60):
        out = []
        for _ in range(rng.randrange(1, 5)):
            w = rng.choice(bases).split(" ")
            if rng.random() < 0.6:
                w[rng.randrange(len(w))] = f"z{rng.randrange(99)}"
            out.append(" ".join(w))
        out.append(rng.choice(["", "  ", "abc", "Abc!", "héé😀"]))
        rows.append((i, "\n".join(out), "s"))
    return rows + [(None if i is None else i + 1000, t, s) for i, t, s in corpus(8, 20)]


def check(rows, got):
    of = plain(rows)
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, []).append((t or "").split("\n"))
    groups, kept = {}, {}
    for r in got:
        lines = {x[r.line_no] for x in texts[r.doc_id] if r.line_no < len(x)}
        for x in lines & set(of):
            groups.setdefault(r.line_class, set()).add(of[x])
        if r.kept:
            kept.setdefault(r.line_class, set()).add((r.doc_id, r.line_no))
    assert all(len(v) == 1 for v in kept.values()) and set(kept) == {r.line_class for r in got}
    return of, groups


def test_against_all_pairs(spark):
    rows = fuzzy()
    rows = [r for r in rows if r[0] is not None]
    got = L.classes(docs(spark, rows)).collect()
    assert len(got) == sum(1 for _, t, _ in rows for x in (t or "").split("\n") if x and not x.isspace())
    of, groups = check(rows, got)
    assert all(len(v) == 1 for v in groups.values())  # no false link
    assert len(groups) <= len(set(of.values())) * 1.01  # recall of the bands
    firsts = {}
    for i, t, _ in rows:
        for n, x in enumerate((t or "").split("\n")):
            if x in of:
                firsts[of[x]] = min((i, n), firsts.get(of[x], (i, n)))
    stays = {(r.doc_id, r.line_no) for r in got if r.kept}
    assert len(stays & set(firsts.values())) >= 0.99 * len(stays)


def test_small_tiles_give_the_same(spark):
    rows = [r for r in fuzzy(9) if r[0] is not None]
    df = docs(spark, rows)
    from profila.llm.common import durable
    from profila.llm.components import components
    table = durable(L.cut(df))
    one, many = ({(r.node, r.root) for r in components(L.links(df, table, tile=n)).collect()} for n in (512, 4))
    assert one == many and one


def test_matrix_overlaps_equal_sets():
    rng = random.Random(3)
    texts = [" ".join(words(rng, rng.randrange(1, 40), 30)) for _ in range(40)]
    sets = [L.shingles(t) for t in texts]
    both = L.overlaps(sets)
    assert all(both[i, j] == len(sets[i] & sets[j]) for i in range(40) for j in range(40) if i != j)
    i, j = L.near_copies(texts, 0.3)
    assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a in range(40) for b in range(a) if L.jaccard(sets[a], sets[b]) >= 0.3}


@pytest.mark.parametrize("s,low", [(0.8, 0.99), (0.9, 0.9999)])
def test_designed_recall(s, low):
    assert 1 - (1 - s ** L.ROWS) ** L.BANDS >= low


def test_deduplicated_texts(spark):
    rows = [(1, "one long line that is shared by all\n\nown line of one", "s"), (2, "own line of two\none long line that is shared by all\n ", "s"),
            (3, None, "s"), (4, "", "s"), (None, "one long line that is shared by all\nlast", None)]
    got = {r.doc_id: r.text for r in L.deduplicate(docs(spark, rows)).collect()}
    assert got == {1: rows[0][1], 2: "own line of two\n ", 3: None, 4: "", None: "last"}
    assert L.classes(docs(spark, [])).count() == 0 and L.deduplicate(docs(spark, [])).count() == 0


def test_shared_line_is_signed_once_a_task(spark):
    rng = random.Random(12)
    shared = " ".join(words(rng, 12, 100_000))
    rows = [(i, "\n".join([" ".join(words(rng, 8, 100_000)), shared if i % 2 else shared + "!"]), "s") for i in range(2000)]
    df = docs(spark, rows).repartition(5)
    L.prepare(spark)
    table = L.cut(df)
    assert table.count() == 4000 and table.where("k0 is not null").count() <= 2000 + 2 * 5
    got = L.classes(df).where("line_no = 1")
    assert got.count() == 2000 and got.select("line_class").distinct().count() == 1
    assert [(r.doc_id, r.line_no) for r in got.where("kept").collect()] == [(0, 1)]


def test_every_line_is_met_first_once_until_forgotten():
    rng, told, met = random.Random(13), np.empty(0, np.int64), []
    for _ in range(50):
        batch = np.array([rng.randrange(3000) for _ in range(400)] + [-5] * 9, np.int64)
        at, told = L.first_met(batch, told)
        assert len(set(batch[at].tolist())) == len(at)
        met.append(set(batch[at].tolist()))
    assert sum(-5 in x for x in met) == 1 and len(set().union(*met)) > 2900
    at, told = L.first_met(np.arange(L._REMEMBERED + 1).repeat(2), told)
    again, told = L.first_met(np.array([-5, -5]), told)
    assert len(again) == 0 and len(L.first_met(np.array([-5]), L.first_met(np.array([1]), told)[1])[0]) == 1
