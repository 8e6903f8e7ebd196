import math
import random

import numpy as np
import pytest

from profila.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=10, every=100):
    usable = []
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        if (i, v) not in usable:
            usable.append((i, v))
    out = []
    for q in sorted({i for i, _ in usable if i % every == 0}):
        x = min(v for i, v in usable if i == q)
        near = sorted((float(N.distance(np.array([x], float), np.array([v], float))[0]), i)
                      for i, v in usable if i != q and len(v) == len(x))
        out += [(q, r, i, s) for r, (s, i) in enumerate(near[:k], 1)]
    return out


def vectors(seed=2, n=700, dim=12):
    rng = random.Random(seed)
    f = lambda: float(np.float32(rng.gauss(0, 1)))
    rows = [(i, [f() for _ in range(dim)], 0) for i in range(n)]
    rows += [(1000 + i, rows[3][1], 1) for i in range(60)]  # ties
    rows += [(2000, None, 0), (2100, [], 0), (2200, [0.0] * dim, 0), (2300, [float("nan")] * dim, 0), (2401, [float("inf")] + [1.0] * (dim - 1), 0),
             (2500, [None] + [1.0] * (dim - 1), 0), (None, [1.0] * dim, 0), (2600, [1.0, 2.0], 0), (2701, [1.0, 2.5], 0), rows[5], rows[100]]
    return rows


@pytest.mark.parametrize("blocks", [(1024, 4096), (3, 40)])
def test_against_brute_force(spark, blocks):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as v", "2 as dim", "3 as query_id", "4 as score")
    got = sorted(tuple(r) for r in N.nearest(df, query_block=blocks[0], block=blocks[1]).collect())
    assert got == plain(rows)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(20, 64)), rng.normal(size=(500, 64))
    low, high = N.bounds(N.quantise(a), N.quantise(b))
    true = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    assert (low <= true).all() and (true <= high).all()
    cut = np.partition(high, 9, axis=1)[:, 9]
    assert (low <= cut[:, None]).mean() < 0.3


def test_empty_and_tiny_tables(spark):
    assert N.nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    two = spark.createDataFrame([(100, [1.0, 0.0], 0), (7, [1.0, 1.0], 0)], SCHEMA)
    assert [tuple(r) for r in N.nearest(two).collect()] == [(100, 1, 7, 1.0)]
    assert N.nearest(spark.createDataFrame([(100, [1.0], 0)], SCHEMA)).count() == 0
