import random

import numpy as np

from profila.llm.components import components, forest


def plain(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_random_graphs_paths_and_hubs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(1000 + i, 1001 + i) for i in range(64)] + [(2000, 2001 + i) for i in range(200)] + [(7, 7), (9000, 9000)]
    df = spark.createDataFrame([*edges, *edges[:20], (None, 3), (None, None)], "u long, v long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == plain([e for e in edges if e[0] != e[1]])


def test_no_links(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_forest_keeps_components():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 200, 150), rng.integers(0, 200, 150)
    nodes, roots = forest(a, b)
    want = {x: r for x, r in plain(zip(a.tolist(), b.tolist())).items() if x != r}
    assert dict(zip(nodes.tolist(), roots.tolist())) == want
