"""The end-to-end path with closed-form models, so that every step after the
stacks has an exact SQL twin: union of sources (U1, U2), stack columns joined
by key (J6), features by exclusion list (P2) and the matrix before imputing
(M19), threshold (P10), predicted gender chained into the age table (J7, M18),
the result joined to the raw unlabelled list (J8, S2), a stage written and
read back (S3), the best loss over rounds (A19, F8, F9)."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import round6, sigmoid, threshold
from ..operators import metrics as MT
from ..operators.encode import kfold_target_encode
from ..operators.events import device_event_aggregates
from ..operators.folds import assign_folds
from ..operators.assemble import feature_columns
from ..operators.joins import attach, chain_predicted, result_rows
from ..operators.naive_bayes import oof_naive_bayes
from ..session import durable, tables_folder
from ..sources import app_events, devices
from ..sources.files import Stages
from . import gender as G
from .features import device_feature_table, gender_folds
from .matrices import app_tag_matrix
from .profile import NOT_FEATURES


def _round(df: DataFrame) -> DataFrame:
    return df.select(*[round6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _stacks(spark, sf_dir, devs, folds, kinds=("multinomial", "bernoulli")) -> list[DataFrame]:
    mat = app_tag_matrix(app_events(spark, sf_dir), devs).materialize()
    rows = durable(G.stack_rows(devs, folds).withColumn("label", F.col("label").cast("int")))
    names = {"multinomial": "tfidf_mnb", "bernoulli": "tfidf_bnb"}
    return [durable(oof_naive_bayes(mat.cells, rows, mat.n_cols, k, prefix=names[k])) for k in kinds]


def q_union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 + U2: labelled and unlabelled devices and their logs as two sources
    each, the unlabelled one without label columns, unioned again."""
    devs, log = devices(spark, sf_dir), app_events(spark, sf_dir)
    labelled = devs.where("is_train = 1")
    unlabelled = devs.where("is_train = 0").drop("gender", "age")
    both = labelled.unionByName(unlabelled, allowMissingColumns=True)
    ours = F.col("device_id") % 5 != 0
    logs = log.where(ours).unionByName(log.where(~ours))
    return _round(attach(both.select("device_id", "phone_brand", "device_model", "gender", "age", "is_train"),
                         [device_event_aggregates(logs)]))


def q_model_matrix_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 + P2 + M19 before imputing + S3: shared features and stacks joined by
    key, the stacks read back from a written stage; the columns that the
    exclusion list leaves."""
    devs = durable(devices(spark, sf_dir))
    folds = durable(gender_folds(devs))
    base = device_feature_table(devs, app_events(spark, sf_dir), folds)
    stage = attach(devs.select("device_id"), _stacks(spark, sf_dir, devs, folds))
    stages = Stages(spark, f"{tables_folder(spark)}/stages-{uuid4().hex}")  # runs side by side don't meet
    table = attach(base, [stages(lambda: stage, "model_matrix")])
    return _round(table.select("device_id", *feature_columns(table, NOT_FEATURES)))


def _predicted_gender(spark, sf_dir, devs) -> DataFrame:
    folds = durable(gender_folds(devs))
    mnb, = _stacks(spark, sf_dir, devs, folds, ("multinomial",))
    return durable(mnb.join(devs.where("is_train = 0").select("device_id"), "device_id", "left_semi")
                   .select("device_id", threshold("tfidf_mnb_clf_1").alias("gender_pred")))


def q_chained_gender_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 + J7 + M18: the age model's gender column, true where it is known and
    predicted elsewhere."""
    devs = durable(devices(spark, sf_dir))
    return (chain_predicted(devs, _predicted_gender(spark, sf_dir, devs))
            .select("device_id", "phone_brand", "device_model", "is_train", "gender"))


def q_result_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 + S2: predictions joined to the raw unlabelled list, in which a device
    may stand twice (here: the list unioned with its even ids)."""
    devs = durable(devices(spark, sf_dir))
    afolds = durable(assign_folds(devs.where("is_train = 1"), "age"))
    age = kfold_target_encode(devs, afolds, ["phone_brand"], "age").select(
        "device_id", F.round("phone_brand_age_kfold_mean", 6).alias("age"))
    preds = _predicted_gender(spark, sf_dir, devs).withColumnRenamed("gender_pred", "gender").join(age, "device_id", "left")
    raw = devices(spark, sf_dir, dedup=False).where("is_train = 0").select("device_id")
    raw = raw.unionAll(raw.where("device_id % 2 = 0"))
    return result_rows(raw, preds).select("device_id", "gender", "age")


def q_best_log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19 + F8 + F9: margins r·(encoding − 0.5) of rounds r = 1 … 8 as
    probabilities; each fold's smallest loss, of the class and of its complement."""
    devs = durable(devices(spark, sf_dir))
    folds = durable(gender_folds(devs))
    enc = kfold_target_encode(devs, folds, ["phone_brand"], "gender")
    rows = (devs.where("is_train = 1").select("device_id", F.col("gender").alias("label"))
            .join(folds, "device_id").join(enc, "device_id")
            .withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(8))))
            .withColumn("p1", sigmoid((F.col("phone_brand_gender_kfold_mean") - 0.5) * F.col("round")))
            .withColumn("p0", 1.0 - F.col("p1")).withColumn("other", 1 - F.col("label")))
    one = MT.best_log_loss(rows)
    two = MT.best_log_loss(rows, label="other", p="p0").withColumnRenamed("best_log_loss", "best_log_loss_0")
    return one.join(two, "fold").select("fold", F.round("best_log_loss", 6).alias("best_log_loss"),
                                        F.round("best_log_loss_0", 6).alias("best_log_loss_0"))
