"""What wide models leave on the driver: mapped vectors, turns, broadcasts that go."""

import pickle
import threading
import time
import tracemalloc

import numpy as np
import pytest
from pyspark import Broadcast
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from profila.operators import cluster as CL
from profila.operators import csr as CS
from profila.operators import learners as LN
from profila.operators import second_order as SO


@pytest.mark.parametrize("mapped,collected", [(1 << 30, 1 << 30), (0, 1 << 30), (0, 0)])
def test_sums_are_the_same_however_they_reach_the_driver(spark, monkeypatch, mapped, collected):
    length = 3 * CS.BLOCK + 7
    monkeypatch.setattr(CS, "MAPPED", mapped)
    monkeypatch.setattr(CS, "COLLECTED", collected)

    def partial(batches):
        from pyspark import TaskContext
        v = np.zeros(length)
        for batch in batches:
            for i in batch.column("id").to_pylist():
                v[i * 1000] += i                       # a few places of a block
                v[CS.BLOCK:2 * CS.BLOCK] += 1.0 / 3    # a full block; the third stays empty
        yield TaskContext.get().partitionId(), v
    rows = spark.range(0, 12, 1, 4)
    want = np.zeros(length)
    for i in range(12):
        want[i * 1000] += i
    want[CS.BLOCK:2 * CS.BLOCK] += 12 / 3
    for tasks, source in ((0, rows), (1, rows.coalesce(1))):
        assert np.allclose(CS.vector_sum(source, partial, length, tasks), want, rtol=1e-14, atol=0)


def test_long_arrays_need_no_memory_of_their_own():
    tracemalloc.start()
    held = CS.numbers(20, 1_000_000)
    assert tracemalloc.get_traced_memory()[1] < 1e6 and not held[3, :5].any()
    held[3] = 2.0
    got = pickle.loads(pickle.dumps(CS.by_rows(held[2:5, :7]), 5))
    tracemalloc.stop()
    assert type(got) is np.ndarray and (got == held[2:5, :7]).all()


def test_wide_learners_take_turns():
    turns, most, now, lock = CS._Turns(10), [0], [0], threading.Lock()

    def work(size):
        with turns.take(size):
            with lock:
                now[0] += size
                most[0] = max(most[0], now[0])
            time.sleep(0.02)
            with lock:
                now[0] -= size
    threads = [threading.Thread(target=work, args=(n,)) for n in (4, 6, 3, 8, 2, 10)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(10)
    assert most[0] <= 10 and turns.free == 10
    with turns.take(99):  # more than there is room for: alone
        assert turns.free == 0


def _wide(spark, width=1500, n=120):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        at = sorted(rng.choice(width, 12, replace=False).tolist())
        rows.append((i, Vectors.sparse(width, at, rng.random(12).tolist()), float(rng.random() < 0.5), i % 5 if i % 6 else None))
    schema = StructType([StructField("device_id", LongType()), StructField("features", VectorUDT()),
                         StructField("label", DoubleType()), StructField("fold", IntegerType())])
    return spark.createDataFrame(rows, schema).repartition(3).persist()


def test_logistic_models_too_wide_for_the_heap_are_fitted_by_passes(spark, monkeypatch):
    data = _wide(spark)
    monkeypatch.setattr(LN, "LBFGS_NUMBERS", 1000)
    monkeypatch.setattr(LN, "LogisticRegression", None)
    found = LN.sgd_logistic(0.05).models(data, 5)
    rows = [r for r in data.collect() if r["fold"] is not None]
    x, s, fold = np.stack([r["features"].toArray() for r in rows]), np.array([2 * r["label"] - 1 for r in rows]), np.array([r["fold"] for r in rows])
    for m, w in enumerate(found):  # the gradient of mean loss + 0.05/2 ‖w‖² is 0
        own = fold != m
        g = -s[own] / (1 + np.exp(s[own] * (x[own] @ w[:-1] + w[-1])))
        assert np.abs(x[own].T @ g / own.sum() + 0.05 * w[:-1]).max() < 1e-6 and abs(g.mean()) < 1e-6


def test_passes_leave_no_broadcast_behind(spark, monkeypatch):
    data, made, gone = _wide(spark), [], []
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a, f=Broadcast.destroy: (gone.append(id(self)), f(self, *a))[1])
    sc = type(spark.sparkContext)
    monkeypatch.setattr(sc, "broadcast", lambda self, v, f=sc.broadcast: (made.append(b := f(self, v)), b)[1])
    SO.fit(data, "squared_hinge", 5, reg_bias=1.0, tol=1e-3)
    CL.fit(data, (3, 4))
    assert made and {id(b) for b in made} == set(gone)


def test_plus_plus_in_pieces_picks_the_same_points(monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.random((30, 40)) * (rng.random((30, 40)) < 0.3)
    i, j = np.nonzero(x)
    points = np.searchsorted(i, np.arange(31)), j, x[i, j]
    want = CL._plus_plus(points, 40, 9, 7)
    monkeypatch.setattr(CL, "_DENSE", 100)
    assert CL._plus_plus(points, 40, 9, 7) == want


def test_driver_gives_memory_back_at_most_every_so_often(spark, monkeypatch):
    from profila import session as S
    monkeypatch.setitem(S._given, "at", 0.0)
    assert S.give_back(spark) and not S.give_back(spark)
    monkeypatch.setattr(S, "GIVE_BACK_S", 0)
    assert S.give_back(spark)


def test_misplaced_rows_meet_the_means_where_they_lie(spark):
    rng = np.random.default_rng(2)
    x = rng.random((60, 9)) * (rng.random((60, 9)) < 0.4)
    x[5] = 0.0
    own = rng.integers(0, 4, 60)
    cells = spark.createDataFrame([(int(i), f"c{j}", float(x[i, j])) for i, j in zip(*np.nonzero(x))], "device_id long, col string, value double")
    found = spark.createDataFrame([(i, int(c), int(c) % 2) for i, c in enumerate(own)], "device_id long, a int, b int")
    rows = CL.gathered_cells(cells, found)
    for column, c in (("a", own), ("b", own % 2)):
        means = np.stack([x[c == m].mean(axis=0) for m in range(c.max() + 1)])
        d = ((x[:, None] - means) ** 2).sum(axis=2)
        want = int((d[np.arange(60), c] > d.min(axis=1) + 1e-6).sum())
        assert want and CL.misplaced(cells, found, column).first()[:] == (60, want)
        out = CL.misplaced(cells, found, column, rows=rows)
        assert out.first()[:] == (60, want)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Generate" not in plan  # no row for each cell and cluster
