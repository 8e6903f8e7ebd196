"""Results stay exact when one device holds a large share of the log."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from profila.operators import events as EV
from profila.operators import naive_bayes as NB
from profila.operators import sequence as S
from profila.operators import text as TX
from profila.plans.queries import active_terms

EV_SCHEMA = "event_id long, device_id long, app_id int, is_installed int, is_active int, date int, tag_list string"


def skewed_log(n=6000, seed=3):
    rng = np.random.default_rng(seed)
    dev = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 60, n))  # device 0 holds ~40 %
    app = rng.integers(5, 40, n)
    return pd.DataFrame({"event_id": np.arange(n), "device_id": dev, "app_id": app,
                         "is_installed": rng.integers(0, 2, n), "is_active": rng.integers(0, 2, n),
                         "date": rng.integers(1, 10, n), "tag_list": ["t" + ",t".join(["1"] * (a % 3 + 1)) for a in app]})


def test_aggregates_and_top_n_under_skew(spark):
    pdf = skewed_log()
    ev = spark.createDataFrame(pdf, EV_SCHEMA)
    got = {r.device_id: r for r in EV.device_event_aggregates(ev, with_tri_day=True).collect()}
    g = pdf.groupby("device_id")
    assert got[0].event_id_count == int((pdf.device_id == 0).sum())
    for d, grp in g:
        r = got[d]
        assert r.app_id_nunique == grp.app_id.nunique() and r.date_nunique == grp.date.nunique()
        assert r.tri_day_event_cnt == (int(grp.date.between(1, 3).sum()) or None)
    use = {r.device_id: r for r in EV.app_usage_features(ev, ns=(10,)).collect()}
    pop = pdf.groupby("app_id").size().reset_index(name="n").sort_values(["n", "app_id"], ascending=[False, True])
    top10 = set(pop.app_id[:10])
    for d, grp in g:
        assert use[d].top10_app_cnt == int(grp.app_id.isin(top10).sum())
        cnt = grp.groupby("app_id").size()
        assert use[d].max_app_id == int(cnt[cnt == cnt.max()].index.min())


def test_positions_and_bigrams_under_skew(spark):
    pdf = skewed_log(3000)
    ev = spark.createDataFrame(pdf, EV_SCHEMA)
    devs = spark.createDataFrame(pd.DataFrame({"device_id": np.arange(60)}))
    terms = active_terms(ev, devs, n_max=2).where("device_id = 0").groupBy("term").count().collect()
    got = {r.term: r["count"] for r in terms}
    act = pdf[(pdf.device_id == 0) & (pdf.is_active == 1)].sort_values(["date", "event_id", "app_id"])
    toks = [t for t in act.app_id.astype(str) if len(t) >= 2]  # T1: one-character tokens vanish first
    want = {}
    for t in toks:
        want[t] = want.get(t, 0) + 1
    for a, b in zip(toks, toks[1:]):
        want[f"{a} {b}"] = want.get(f"{a} {b}", 0) + 1
    assert got == want


def test_ngrams_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 4)
    toks = {0: [f"t{i % 5}" for i in range(23)], 1: ["a"], 2: ["a", "b"], 3: [f"u{i}" for i in range(8)]}
    df = spark.createDataFrame([(g, p, t) for g, ts in toks.items() for p, t in enumerate(ts, 1)], "g int, pos long, tok string")
    got = sorted((r.g, r.term) for r in S.ngrams(df, "g", "tok", 3).collect())
    assert got == sorted((g, " ".join(ts[i:i + n])) for g, ts in toks.items() for n in (1, 2, 3) for i in range(len(ts) - n + 1))


# ---------------------------------------------------------------- splits in the executed plan

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.files.maxPartitionBytes": "16k",
    "spark.sql.files.openCostInBytes": "1k",
}


@pytest.fixture
def large_tables(spark):
    """Plans as for tables too large to broadcast, with small partitions."""
    before = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def written(monkeypatch):
    """Final plans of the tables an operator writes."""
    from profila import session
    plans = []

    def recording(df):
        out = session.durable(df)
        plans.append(final_plan(df))
        return out
    for module in ("sequence", "text", "naive_bayes"):
        monkeypatch.setattr(f"profila.operators.{module}.durable", recording)
    return plans


def final_plan(df):
    df.foreach(lambda r: None)
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_group_is_split_in_positions(spark, large_tables, written):
    rng = np.random.default_rng(5)
    n = 40_000
    pdf = pd.DataFrame({"device_id": np.where(rng.random(n) < 0.5, 0, rng.integers(1, 2000, n)), "event_id": np.arange(n),
                        "pad": [f"{x:032x}" for x in rng.integers(0, 1 << 60, n)]})
    pos = S.group_positions(spark.createDataFrame(pdf), "device_id", ["event_id"])
    assert any("SortMergeJoin(skew=true)" in p for p in written)
    assert pos.where("device_id = 0").agg(F.max("pos")).first()[0] == int((pdf.device_id == 0).sum())


def test_hot_term_is_split_in_tfidf(spark, large_tables, written):
    rng = np.random.default_rng(6)
    n = 30_000
    tf = spark.createDataFrame(pd.DataFrame({"device_id": np.arange(n) // 2, "tf": 1,
                                             "term": np.where(np.arange(n) % 2 == 0, "hot", [f"t{x}" for x in rng.integers(0, 3000, n)])}))
    out = TX.tfidf(tf, "device_id")
    assert any("SortMergeJoin(skew=true)" in p for p in [*written, final_plan(out)])
    assert out.count() == n


def test_hot_column_is_split_in_naive_bayes(spark, large_tables, monkeypatch):
    rng = np.random.default_rng(7)
    n = 12_000
    cells = pd.DataFrame({"device_id": np.repeat(np.arange(n), 2), "value": 1.0,
                          "col": np.where(np.arange(2 * n) % 2 == 0, "hot", [f"c{x}" for x in rng.integers(0, 1500, 2 * n)])})
    rows = pd.DataFrame({"device_id": np.arange(n), "label": rng.integers(0, 2, n), "fold": np.arange(n) % 5})
    out = NB.oof_naive_bayes(spark.createDataFrame(cells), spark.createDataFrame(rows), 1501, "multinomial")
    assert "SortMergeJoin(skew=true)" in final_plan(out) and out.count() == n
