"""Cells of frequent keys stay where they lie; those of the others go by key."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from profila.operators import naive_bayes as NB
from profila.operators import text as TX
from profila.operators.joins import join_by_frequency
from profila.operators.vectors import block_matrix
from profila.session import durable


def documents():
    """(device, term, tf): two words of every document, pairs, and words of one document."""
    rows = []
    for d in range(60):
        terms = {"the": 1 + d % 3, "of": 1, f"pair{d // 2}": 2, f"own{d}": 1 + d % 2, f"many{d % 4}": 1}
        rows += [(d, t, n) for t, n in terms.items()]
    return pd.DataFrame(rows, columns=["device_id", "term", "tf"])


@pytest.fixture
def threshold(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}

    def put(n):
        for k in before:
            spark.conf.set(k, str(n))
    yield put
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("bytes_", [-1, 100, 80 * 7, 1 << 20])
def test_tfidf_is_the_same_for_any_share_of_frequent_terms(spark, threshold, bytes_):
    threshold(bytes_)
    pdf = documents()
    got = {(r.device_id, r.term): r.tfidf for r in TX.tfidf(spark.createDataFrame(pdf), "device_id").collect()}
    df = pdf.groupby("term").size()
    w = {(r.device_id, r.term): r.tf * (math.log(61 / (1 + df[r.term])) + 1) for r in pdf.itertuples()}
    norm = {d: math.sqrt(sum(x * x for (e, _), x in w.items() if e == d)) for d in range(60)}
    assert got == pytest.approx({k: x / norm[k[0]] for k, x in w.items()})


def test_frequent_terms_are_not_shuffled_by_term(spark, threshold):
    threshold(80 * 7)  # the, of, many0 … many3; not the pairs and own words
    tf = durable(spark.createDataFrame(documents()))
    out = TX.tfidf(tf, "device_id", written=True)
    out.foreach(lambda r: None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [term" in plan and "LeftAnti" in plan


def test_no_key_is_lost_or_met_twice(spark, threshold):
    threshold(50)
    cells = spark.createDataFrame([(i, i % 7 if i % 3 else 100 + i) for i in range(60)], "i int, key int")
    table = durable(cells.groupBy("key").agg(F.count(F.lit(1)).alias("n"), (F.max("key") * 2).alias("v")))
    for row_bytes in (1, 10, 25, 50, 100):
        got = sorted(tuple(r) for r in join_by_frequency(cells, table, "key", "n", row_bytes).select("i", "key", "v").collect())
        assert got == sorted((r.i, r.key, 2 * r.key) for r in cells.collect())


@pytest.mark.parametrize("kind", ["multinomial", "bernoulli"])
@pytest.mark.parametrize("bytes_", [-1, 300, 1 << 20])
def test_blocks_side_by_side_score_like_stacked_ones(spark, threshold, kind, bytes_):
    threshold(bytes_)
    pdf = documents()
    pdf["half"] = pdf.tf / 2.0
    pdf.loc[pdf.term == "of", "half"] = 0.0
    cells = spark.createDataFrame(pdf)
    rows = spark.createDataFrame([(d, d % 2 if d < 50 else None, d // 2 % 5 if d < 50 else None) for d in range(60)],
                                 "device_id long, label int, fold int")
    width = 2 * pdf.term.nunique()
    stacked = NB.oof_naive_bayes(block_matrix([("c", cells, "tf"), ("h", cells, "half")]), rows, width, kind)
    beside = NB.oof_naive_bayes(cells.withColumnRenamed("term", "col"), rows, width, kind, values=("tf", "half"))
    got, want = ({r.device_id: r.nb_clf_1 for r in t.collect()} for t in (beside, stacked))
    assert len(want) == 60 and got == pytest.approx(want, abs=2e-6)
