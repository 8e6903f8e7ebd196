"""Gender stacking features (the SG, AC and NN stages) and the gender model.

SG  app/tag count + tf-idf matrix → lr, sgd, pac, ridge, svc (Spark ML /
    linear_mix), bnb, mnb (relational) → ``tfidf_{m}_clf_{0,1}``; k-means
    k = 5 … 70 → ``kmeansword_{k}``.
AC  active-app 1–3-gram matrix → lr, sgd, pac, svc, bnb, mnb →
    ``ac_tfidf_{m}_clf_{0,1}``; k-means k = 5 … 30 → ``kmeansac_word_{k}``.
NN  skip-gram device vectors → MLP → ``nn_sex_1``, ``nn_sex_0``.

Every stage writes its output once (checkpoint) and is joined by key (J6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import learners as LN
from ..operators import lists as L
from ..operators.cluster import kmeans_features
from ..operators import skipgram
from ..operators.embed import mlp
from ..operators.joins import attach
from ..operators.naive_bayes import oof_naive_bayes
from ..operators.skipgram import device_vectors
from ..operators.stack import oof_stack
from .matrices import active_matrix, app_tag_matrix
from ..session import durable, once, run_concurrently

# Cluster counts of the two k-means families.
SG_KS = (5, 10, 19, 30, 40, 50, 60, 70)
AC_KS = (5, 10, 19, 30)


def write_table(build, name: str, params: str | None = "") -> DataFrame:
    """A stage output as a table of this run."""
    return durable(build())


def stack_rows(devs: DataFrame, folds: DataFrame, label: str = "gender") -> DataFrame:
    """(device_id, label, fold) for every device; fold NULL when unlabelled."""
    return (devs.select("device_id", F.col(label).alias("label"), "is_train").distinct()
            .join(folds, "device_id", "left")
            .select("device_id", F.col("label").cast("double").alias("label"),
                    F.when(F.col("is_train") == 1, F.col("fold")).alias("fold")))


def learner_stacks(mat, rows: DataFrame, learners: dict, prefix: str, nb: bool = True,
                   ks=(), kmeans_prefix: str = "", workers: int = 4, save=write_table) -> DataFrame:
    """All stack outputs over one matrix (``mat``: a callable that gives it),
    joined by device_id.  The learners are independent, so their fits are
    submitted concurrently and each family's output is written once, by
    ``save(build, name, params)``, which need not build what it has."""
    data = once(lambda: mat().vectors(rows))
    tasks = {}
    for name, make in learners.items():
        learner = make()
        tasks[name] = (lambda n=f"{prefix}_{name}", x=learner: save(lambda: oof_stack(data(), x, n), n, x.params))
    if nb:
        nb_rows = rows.withColumn("label", F.col("label").cast("int"))
        for kind, tag in (("bernoulli", "bnb"), ("multinomial", "mnb")):
            tasks[tag] = (lambda kind=kind, n=f"{prefix}_{tag}": save(
                lambda: oof_naive_bayes(mat().cells, nb_rows, mat().n_cols, kind, prefix=n), n, kind))
    if ks:
        tasks["kmeans"] = lambda: save(lambda: kmeans_features(data().select("device_id", "features"), ks, kmeans_prefix),
                                       f"{prefix}_kmeans", f"ks={tuple(ks)}")
    parts = run_concurrently(tasks, workers)
    return attach(rows.select("device_id"), list(parts.values()))


def app_sequence(events: DataFrame) -> DataFrame:
    """A10 in long form: (device_id, pos, token)."""
    return L.first_use_sequence(L.distinct_app_tags(events)).withColumn("token", F.col("app_id").cast("string"))


def nn_stack(events: DataFrame, devs: DataFrame, rows: DataFrame) -> DataFrame:
    seq = durable(app_sequence(events))
    # token arrays, bounded by the app catalogue; empty without events
    lists = L.bounded_list(seq, "device_id", "token", name="tokens")
    seqs = devs.select("device_id").distinct().join(lists, "device_id", "left")
    data = (device_vectors(skipgram.fit(seq), seqs).join(rows, "device_id").select("device_id", "features", "label", "fold"))
    out = oof_stack(durable(data), mlp(), "nn", round_output=False)  # the network's output is not rounded
    return out.select("device_id", F.col("nn_clf_1").alias("nn_sex_1"), F.col("nn_clf_0").alias("nn_sex_0"))


def gender_stacks(events: DataFrame, devs: DataFrame, folds: DataFrame, nn: bool = True,
                  sg_ks=SG_KS, ac_ks=AC_KS, workers: int = 3, mat=None, save=write_table) -> DataFrame:
    mat = mat or once(lambda: app_tag_matrix(events, devs).materialize())
    active = once(lambda: active_matrix(events, devs).materialize())
    rows = durable(stack_rows(devs, folds))
    tasks = {
        "sg": lambda: learner_stacks(mat, rows, LN.GENDER_LEARNERS, "tfidf", ks=sg_ks,
                                     kmeans_prefix="kmeansword_", save=save),
        "ac": lambda: learner_stacks(active, rows, LN.AC_GENDER_LEARNERS,
                                     "ac_tfidf", ks=ac_ks, kmeans_prefix="kmeansac_word_", save=save),
    }
    if nn:
        tasks["nn"] = lambda: save(lambda: nn_stack(events, devs, rows), "nn")
    parts = run_concurrently(tasks, workers)
    return attach(rows.select("device_id"), [parts[k] for k in tasks])
