"""Hand-made edge tables (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F

from profila.operators.joins import chain_predicted, result_rows
from profila.operators import events as EV
from profila.operators import lists as L
from profila.operators import text as TX
from profila.operators.encode import kfold_target_encode
from profila.operators.joins import attach
from profila.plans.queries import active_terms

EV_SCHEMA = "event_id long, device_id long, app_id int, is_installed int, is_active int, date int, tag_list string"
DEV_SCHEMA = "device_id long, phone_brand int, device_model int, gender int, age int, is_train int"


def ev(spark, rows):
    return spark.createDataFrame(rows, EV_SCHEMA)


def dev(spark, rows):
    return spark.createDataFrame(rows, DEV_SCHEMA)


def one(df, key, value):
    return df.where(F.col(key) == value).first()


def test_one_event_device_std_null(spark):
    a = EV.device_event_aggregates(ev(spark, [(1, 10, 42, 1, 1, 5, "a,b")]))
    r = a.first()
    assert r.tag_list_len_std is None and r.tag_list_len_mean_div_std is None
    assert r.event_id_count == 1 and r.event_id_count_nunique_ratio == 1.0


def test_constant_tag_count_ratio_null(spark):
    a = EV.device_event_aggregates(ev(spark, [(1, 10, 42, 1, 1, 5, "a,b"), (2, 10, 43, 0, 0, 6, "c,d")]))
    r = a.first()
    assert r.tag_list_len_std == 0.0 and r.tag_list_len_mean_div_std is None
    assert r.is_installed_sum == 1 and r.is_active_mean == 0.5




def test_most_used_tie_smallest_app(spark):
    e = ev(spark, [(1, 10, 5, 1, 1, 1, "x"), (2, 10, 5, 1, 1, 1, "x"), (3, 10, 3, 1, 1, 1, "y"),
                   (4, 10, 3, 1, 1, 1, "y"), (5, 10, 9, 1, 1, 1, "z")])
    assert EV.most_used_app(EV.device_app_counts(e)).first().max_app_id == 3


def test_top_n_cut_tie_smaller_app_in(spark):
    # apps 7 and 8 tie for the second place; top-2 keeps 7
    rows = [(i, 1, 1, 1, 1, 1, "t") for i in range(3)]
    rows += [(10 + i, 2, 7, 1, 1, 1, "t") for i in range(2)] + [(20 + i, 3, 8, 1, 1, 1, "t") for i in range(2)]
    e = ev(spark, rows)
    top = EV.top_apps(EV.app_popularity(EV.device_app_counts(e)), 2).collect()
    assert sorted(r.app_id for r in top) == [1, 7]
    f = EV.app_usage_features(e, ns=(2,))
    assert one(f, "device_id", 2)["top2_app_cnt"] == 2 and one(f, "device_id", 3)["top2_app_cnt"] == 0


def test_no_events_all_null(spark):
    d = dev(spark, [(1, 1, 1, 1, 30, 1), (2, 1, 1, 0, 30, 1)])
    e = ev(spark, [(1, 1, 42, 1, 1, 9, "a")])
    t = attach(d, [EV.device_event_aggregates(e, with_tri_day=True), EV.app_usage_features(e)])
    r2 = one(t, "device_id", 2)
    assert all(r2[c] is None for c in ["event_id_count", "tri_day_event_cnt", "max_app_id", "top10_app_cnt"])
    r1 = one(t, "device_id", 1)
    assert r1.tri_day_event_cnt is None and r1.top10_app_cnt == 1  # no event on days 1-3, top-N >= 0


def test_category_in_one_fold_and_test_only_get_global_mean(spark):
    # brand 9 only in fold 2; brand 5 only on the unlabelled device
    d = dev(spark, [(1, 1, 1, 1, 30, 1), (2, 1, 1, 0, 30, 1), (3, 9, 1, 1, 30, 1), (4, 1, 1, 1, 30, 1),
                    (5, 5, 1, None, None, 0)])
    folds = spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, 3)], "device_id long, fold int")
    enc = kfold_target_encode(d, folds, ["phone_brand"], "gender")
    g = 3 / 4
    assert one(enc, "device_id", 3).phone_brand_gender_kfold_mean == pytest.approx(g)
    assert one(enc, "device_id", 5).phone_brand_gender_kfold_mean == pytest.approx(g)
    # device 1 (fold 0): brand 1 over folds 1, 3 → gender 0 and 1
    assert one(enc, "device_id", 1).phone_brand_gender_kfold_mean == pytest.approx(0.5)


def test_no_active_app_is_nan_token(spark):
    d = dev(spark, [(1, 1, 1, 1, 30, 1), (2, 1, 1, 1, 30, 1)])
    e = ev(spark, [(1, 1, 42, 1, 0, 1, "a"), (2, 2, 42, 1, 1, 1, "a")])
    terms = active_terms(e, d).where("device_id = 1").collect()
    assert [r.term for r in terms] == ["nan"]


def test_one_digit_app_vanishes(spark):
    e = ev(spark, [(1, 1, 7, 1, 1, 1, "a"), (2, 1, 42, 1, 1, 1, "a")])
    tf = TX.term_counts(L.distinct_app_tags(e), "device_id", F.col("app_id").cast("string"))
    assert [r.term for r in tf.collect()] == ["42"]


def test_app_with_two_tag_lists_stays_twice(spark):
    e = ev(spark, [(1, 1, 42, 1, 1, 1, "a"), (2, 1, 42, 1, 1, 2, "b"), (3, 1, 42, 1, 1, 3, "a")])
    assert L.distinct_app_tags(e).count() == 2


@pytest.mark.parametrize("n", [60, 3])
def test_padding_keeps_last_50(spark, n):
    seq = spark.createDataFrame([(1, i + 1, str(100 + i)) for i in range(n)], "device_id long, pos long, token string")
    ranks = spark.createDataFrame([(str(100 + i), 1, i + 1) for i in range(n)], "token string, cnt long, rank long")
    out = TX.padded_sequence(seq, "device_id", "token", ranks, 50).first().seq
    assert len(out) == 50
    if n == 60:
        assert out == list(range(11, 61))
    else:
        assert out == [0] * 47 + [1, 2, 3]


def test_duplicate_device_row_two_result_rows(spark):
    raw = dev(spark, [(7, 1, 1, None, None, 0), (7, 1, 1, None, None, 0), (8, 1, 1, None, None, 0)])
    preds = spark.createDataFrame([(7, 1, 30.0), (8, 0, 40.0)], "device_id long, gender int, age double")
    raw = raw.unionByName(dev(spark, [(9, 1, 1, None, None, 0)]))
    got = sorted(result_rows(raw.where("is_train = 0"), preds).collect())
    assert [tuple(r) for r in got] == [(7, 1, 30.0), (7, 1, 30.0), (8, 0, 40.0), (9, None, None)]


def test_predicted_gender_only_where_unlabelled(spark):
    table = dev(spark, [(1, 1, 1, 0, 20, 1), (2, 1, 1, None, None, 0), (3, 1, 1, None, None, 0)])
    got = chain_predicted(table, spark.createDataFrame([(1, 1), (2, 1)], "device_id long, p int")).collect()
    assert {r.device_id: r.gender for r in got} == {1: 0, 2: 1, 3: None}


def test_approximate_ids_hold_few_sketches_a_task(spark, monkeypatch):
    """Rows of ordinary devices are dealt by device before any sketch is made, those of
    devices with a large share of the log merge map-side; the counts stay those of one
    plain aggregate."""
    monkeypatch.setattr(EV, "HEAVY_DEVICES", 4)
    rows = [(i, None if i % 9 == 0 else 7 if i % 2 else i % 40, 1, 1, 1, 1, "a") for i in range(2_000)] + [(None, 5, 1, 1, 1, 1, "a")] * 3
    log = ev(spark, rows)
    sizes = log.where("device_id is not null").groupBy("device_id").agg(F.count(F.lit(1)).alias("n"))
    found = EV.approx_distinct_ids(log, sizes, 0.01)
    plain = log.where("device_id is not null").groupBy("device_id").agg(F.approx_count_distinct("event_id", 0.01).alias("n"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    light, heavy = found._jdf.queryExecution().optimizedPlan().toString().split("Aggregate [device_id")[1:]
    assert "LeftAnti" in light and "RepartitionByExpression [device_id" in light
    assert "LeftSemi" in heavy and "RepartitionByExpression" not in heavy
    none = EV.approx_distinct_ids(ev(spark, []), sizes.limit(0), 0.01)
    assert none.count() == 0
