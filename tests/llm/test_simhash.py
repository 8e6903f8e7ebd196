import random

import numpy as np
import pytest
import xxhash
from data import corpus, docs

from profila.llm import simhash


def plain_fingerprint(text, k=4):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    values = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_classes(fps, bits=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_against_brute_force(spark):
    rows = corpus()
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    fps = [plain_fingerprint(t) for _, t, _ in rows]
    classes = plain_classes(fps)
    least = {}
    for (i, _, _), c in zip(rows, classes):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = sorted(((i, f"{f:016x}", least.get(c)) for (i, _, _), f, c in zip(rows, fps, classes)), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want


@pytest.mark.parametrize("bits,blocks,tile", [(4, None, 2048), (4, 7, 8), (3, 5, 16)])
def test_links_of_dense_groups(spark, bits, blocks, tile):
    """Chains and dense groups of fingerprints, cut into many tiles."""
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for base in list(fps)[:4]:
        for _ in range(60):
            x = base
            for _ in range(rng.randrange(1, 9)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    ids = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "doc_id long, fp long")
    from profila.llm.components import components
    found = {r.node: r.root for r in components(simhash.links(ids.select("fp"), bits, blocks, tile)).collect()}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    groups = {}
    for s, c in zip(signed, plain_classes(fps, bits)):
        groups.setdefault(c, set()).add(s)
    got = {}
    for s in signed:
        got.setdefault(found.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_one_of_each_class_stays(spark):
    rows = corpus()
    df = docs(spark, rows)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    got = kept.collect()
    classes = dict(zip(range(len(rows)), plain_classes([plain_fingerprint(t) for _, t, _ in rows])))
    assert len(got) == len(set(classes.values()))
    best = {}
    for k, (i, t, _) in enumerate(rows):
        if i is not None:
            best[classes[k]] = min(i, best.get(classes[k], i))
    assert {r.doc_id for r in got} == set(best.values())


def test_empty_table(spark):
    df = docs(spark, [])
    assert simhash.near_duplicates(df).count() == 0 and simhash.keep_one(df).count() == 0


def test_pivot_distances():
    refs = simhash.pivots()
    assert len(refs) == simhash.N_PIVOTS == len(np.unique(refs))


def test_many_shingles_in_parts():
    text = " ".join(f"a{i % 977}" for i in range(70_000))
    assert simhash.simhash(text.encode()) == plain_fingerprint(text)
