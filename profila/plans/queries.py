"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of the inventory.  Doubles are rounded to 6 places and
every computed column is aliased, so results compare by value with the
DuckDB twins in ``profila.oracle``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import round6
from ..operators import events as ev_ops
from ..operators.encode import kfold_target_encode
from ..operators.folds import assign_folds
from ..operators.joins import attach, chain_predicted
from ..sources import app_events, devices, retail_events
from .features import ENCODED, device_feature_table, gender_folds
from ..functions import word_tokens
from ..operators import lists as L
from ..operators import sequence as S
from ..operators import text as TX
from ..operators.naive_bayes import oof_naive_bayes
from .matrices import app_tag_matrix, active_matrix
from ..operators import learners as LN
from ..operators import metrics as MT
from ..operators.boost import gbt_oof
from ..operators.cluster import gathered_cells, kmeans_features, misplaced
from ..operators.csr import csr
from ..operators import skipgram
from ..operators.embed import embedded_sequence, mlp
from ..operators.stack import oof_stack
from ..operators.svd import residuals, svd_scores
from ..sources import document_tokens_source
from ..sources.tables import read_table
from . import gender as G
from .age import AGE_OUTPUT, svd_features, svd_inputs, svd_names
from .profile import NOT_FEATURES, NOT_AGE_FEATURES, _model_table, device_profile
from ..functions import threshold
from ..session import durable

DEVICE_COLS = ["device_id", "phone_brand", "device_model", "gender", "age", "is_train"]


def _round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[round6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q_device_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + F1 + F2 + F3 + J1."""
    devs = devices(spark, sf_dir)
    aggs = ev_ops.device_event_aggregates(app_events(spark, sf_dir))
    return _round_doubles(attach(devs, [aggs]))


def q_device_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the 22 shared device features."""
    devs = devices(spark, sf_dir)
    return _round_doubles(device_feature_table(devs, app_events(spark, sf_dir)))


def q_retail_device_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same table over the retail-size log (lineitem ⋈ orders ⋈ part)."""
    devs = devices(spark, sf_dir)
    return _round_doubles(device_feature_table(devs, retail_events(spark, sf_dir), encode=False))


def q_tri_day_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + P6 + J1."""
    devs = devices(spark, sf_dir).select("device_id")
    return attach(devs, [ev_ops.tri_day_event_count(app_events(spark, sf_dir))])


def q_most_used_app(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + A4 (W3) + J1."""
    devs = devices(spark, sf_dir).select("device_id")
    pairs = ev_ops.device_app_counts(app_events(spark, sf_dir))
    return attach(devs, [ev_ops.most_used_app(pairs)])


def q_top_app_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + A4 + A5 + O3 + J4 + A6."""
    devs = devices(spark, sf_dir).select("device_id")
    return attach(devs, [ev_ops.app_usage_features(app_events(spark, sf_dir))])


def q_retail_top_app_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 with 2,000+ apps, where the top-50/10 cuts bite."""
    devs = devices(spark, sf_dir).select("device_id")
    return attach(devs, [ev_ops.app_usage_features(retail_events(spark, sf_dir))])


def q_gender_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 on the binary label."""
    return gender_folds(devices(spark, sf_dir))


def q_age_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 on the numeric label (age stratification)."""
    devs = devices(spark, sf_dir).where("is_train = 1")
    return assign_folds(devs, "age")


def q_target_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + A11 + A12 + J3 + P9."""
    devs = devices(spark, sf_dir)
    enc = kfold_target_encode(devs, gender_folds(devs), ENCODED, "gender")
    return _round_doubles(enc)


# ---------------------------------------------------------------- lists, text


def q_app_event_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's app per device, positioned in event order."""
    return L.event_app_sequence(app_events(spark, sf_dir))


def q_app_tag_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 + A8: distinct (device, app, tag list) with first use day."""
    return L.distinct_app_tags(app_events(spark, sf_dir))


def _triple_tfidf(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    triples = L.distinct_app_tags(app_events(spark, sf_dir))
    text = F.col(column).cast("string")
    tf = TX.term_counts(triples, "device_id", text)
    # every device is a document, also one without events
    n_docs = devices(spark, sf_dir).select("device_id").distinct().agg(F.count(F.lit(1))).scalar()
    return _round_doubles(TX.tfidf(tf, "device_id", n_docs))


def q_app_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T2 + T3 over the distinct-triple app lists (one-digit ids vanish)."""
    return _triple_tfidf(spark, sf_dir, "app_id")


def q_tag_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T2 + T3 over the distinct-triple tag lists."""
    return _triple_tfidf(spark, sf_dir, "tag_list")


def active_terms(events: DataFrame, devs: DataFrame, n_max: int = 3) -> DataFrame:
    """A9 + O1 + T1 + T4: 1..n-grams of each device's active-app tokens in
    date order; a device with no active event has the single term 'nan'."""
    act = (events.where((F.col("is_active") == 1) & F.col("device_id").isNotNull())
           .select("device_id", "date", "event_id", "app_id",
                   F.explode(word_tokens(F.col("app_id").cast("string"))).alias("tok")))
    seq = S.group_positions(act, "device_id", ["date", "event_id", "app_id"], write=False)
    grams = S.ngrams(seq, "device_id", "tok", n_max)
    # devices with at least one active event, one row each (partial aggregation
    # before the shuffle, so a device with a huge log is no join hot spot)
    active_devs = events.where("is_active = 1").select("device_id").distinct()
    silent = (devs.select("device_id").distinct()
              .join(active_devs, "device_id", "left_anti")
              .select("device_id", F.lit("nan").alias("term")))
    return grams.unionByName(silent)


def q_active_ngram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 + P5 + O1 + T4 + T2: n-gram counts of the date-ordered active list."""
    terms = active_terms(app_events(spark, sf_dir), devices(spark, sf_dir))
    return TX.term_counts_of_terms(terms, "device_id")


def q_token_frequency_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 over the A10 sequences: app token → frequency rank."""
    triples = L.distinct_app_tags(app_events(spark, sf_dir))
    seq = L.first_use_sequence(triples).withColumn("token", F.col("app_id").cast("string"))
    return TX.frequency_rank(seq, "token")


def q_app_sequence_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + W2 + T10 + O4: last 50 app ranks per device, left-padded."""
    triples = L.distinct_app_tags(app_events(spark, sf_dir))
    seq = L.first_use_sequence(triples).withColumn("token", F.col("app_id").cast("string"))
    ranks = TX.frequency_rank(seq, "token")
    padded = TX.padded_sequence(seq, "device_id", "token", ranks, 50)
    return padded.select("device_id", F.array_join(F.col("seq").cast("array<string>"), ",").alias("seq_text"))


def q_embedded_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 over T10: each place of the padded app sequences with its vector, the
    embeddings table as the vector table (an app of rank r has vec_id 7 r);
    components in thousandths."""
    triples = L.distinct_app_tags(app_events(spark, sf_dir))
    seq = L.first_use_sequence(triples).withColumn("token", F.col("app_id").cast("string"))
    padded = TX.padded_sequence(seq, "device_id", "token", TX.frequency_rank(seq, "token"), 50)
    vectors = (read_table(spark, sf_dir, "embeddings").where("vec_id % 7 = 0")
               .select((F.col("vec_id") / 7).cast("long").alias("token"), F.col("embedding").alias("vector")))
    found = embedded_sequence(padded, vectors, 64).select("device_id", F.posexplode("matrix").alias("pos", "v"))
    text = F.array_join(F.transform("v", lambda x: F.floor(x * 1000).cast("string")), ",")
    return found.select("device_id", "pos", text.alias("vec_text"))


def q_event_id_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1's distinct event ids from stored daily sketches, held against the exact
    count: within three standard errors."""
    log = app_events(spark, sf_dir)
    merged = ev_ops.merged_distinct_ids(durable(ev_ops.daily_id_sketches(log)))
    exact = log.where("device_id is not null").groupBy("device_id").agg(F.countDistinct("event_id").alias("exact"))
    off = F.abs(F.col("event_id_nunique") - F.col("exact"))
    return merged.join(exact, "device_id").select(
        "device_id", "exact", (off <= F.ceil(F.col("exact") * 3 * 1.04 / 2 ** (ev_ops.SKETCH_LG_K / 2))).alias("within"))


# ---------------------------------------------------------------- stacks


def stack_rows(devs: DataFrame, folds: DataFrame, label: str = "gender") -> DataFrame:
    """(device_id, label, fold) with an integer class label, for the
    relational naive Bayes."""
    return G.stack_rows(devs, folds, label).withColumn("label", F.col("label").cast("int"))


def _nb_stack(spark, sf_dir, kind, prefix, active=False):
    devs = devices(spark, sf_dir)
    ev = app_events(spark, sf_dir)
    mat = (active_matrix(ev, devs) if active else app_tag_matrix(ev, devs)).materialize()
    rows = durable(stack_rows(devs, gender_folds(devs)))
    return oof_naive_bayes(mat.cells, rows, mat.n_cols, kind, prefix=prefix)


def q_stack_mnb_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 + M2 + A14 + U3 + F7 + T5 over the app/tag matrix."""
    return _nb_stack(spark, sf_dir, "multinomial", "tfidf_mnb")


def q_stack_bnb_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 + T11 + M2 + A14 + U3 + F7 over the app/tag matrix."""
    return _nb_stack(spark, sf_dir, "bernoulli", "tfidf_bnb")


def q_stack_ac_mnb_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 over the active-app 1–3-gram matrix (A9 + T4)."""
    return _nb_stack(spark, sf_dir, "multinomial", "ac_tfidf_mnb", active=True)


def q_stack_ac_bnb_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 over the active-app 1–3-gram matrix."""
    return _nb_stack(spark, sf_dir, "bernoulli", "ac_tfidf_bnb", active=True)


# ---------------------------------------------------------------- learned operators


def _gender_data(spark, sf_dir, active=False):
    devs = devices(spark, sf_dir)
    ev = app_events(spark, sf_dir)
    mat = (active_matrix(ev, devs) if active else app_tag_matrix(ev, devs)).materialize()
    rows = durable(G.stack_rows(devs, gender_folds(devs)))
    return mat.vectors(rows)


def _learner_query(name, prefix, active=False):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return oof_stack(_gender_data(spark, sf_dir, active), LN.GENDER_LEARNERS[name](), prefix)
    q.__doc__ = f"M2 out-of-fold stack of the {name} learner over the {'active n-gram' if active else 'app/tag'} matrix."
    return q


q_stack_lr_gender = _learner_query("lr", "tfidf_lr")          # M3
q_stack_sgd_gender = _learner_query("sgd", "tfidf_sgd")       # M4
q_stack_pac_gender = _learner_query("pac", "tfidf_pac")       # M5 (linear_mix)
q_stack_ridge_gender = _learner_query("ridge", "tfidf_ridge")  # M6
q_stack_svc_gender = _learner_query("svc", "tfidf_svc")       # M9
q_stack_ac_lr_gender = _learner_query("lr", "ac_tfidf_lr", active=True)


def q_kmeans_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster numbers for k = 5 … 70 over every device."""
    data = _gender_data(spark, sf_dir)
    return kmeans_features(data.select("device_id", "features"), G.SG_KS, "kmeansword_")


def q_kmeans_fixed_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 checked from the long cells: at the end of Lloyd's passes every device
    is at the nearest mean (misplaced = 0) for every k."""
    devs = devices(spark, sf_dir)
    mat = app_tag_matrix(app_events(spark, sf_dir), devs).materialize()
    found = durable(kmeans_features(mat.vectors(mat.rows), (5, 19, 70), "k"))
    rows = gathered_cells(mat.cells, found)  # once for every k
    parts = [misplaced(mat.cells, found, f"k{k}", rows=rows).select(F.lit(k).alias("k"), "points", "misplaced") for k in (5, 19, 70)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_svd_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 + T7 checked from the long cells: X Xᵀ s = σ² s for every score column."""
    parts = []
    for kind, column, cells, vec in svd_inputs(app_events(spark, sf_dir)):
        names = svd_names(kind, column)
        scores = durable(svd_scores(vec, names))
        parts.append(residuals(cells, scores, names).select(
            F.lit(f"{kind}_{column}").alias("matrix"), "component", (F.col("residual") < 1e-6).alias("holds")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def q_matrix_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: the vectors of the app/tag matrix read back as (device, column place, value)."""
    devs = devices(spark, sf_dir)
    mat = app_tag_matrix(app_events(spark, sf_dir), devs).materialize()
    vectors = mat.vectors(mat.rows)

    def run(batches):
        for batch in batches:
            indptr, indices, values = csr(batch.column("features"))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(indptr))
            yield pa.RecordBatch.from_arrays([batch.column("device_id").take(pa.array(owner)), pa.array(indices, pa.int64()),
                                              pa.array(values)], ["device_id", "idx", "value"])
    return _round_doubles(vectors.mapInArrow(run, "device_id long, idx long, value double"))


def _age_query(name):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        devs = devices(spark, sf_dir)
        mat = app_tag_matrix(app_events(spark, sf_dir), devs).materialize()
        rows = durable(G.stack_rows(devs, assign_folds(devs.where("is_train = 1"), "age"), "age"))
        data = mat.vectors(rows)
        return _round_doubles(oof_stack(data, LN.AGE_LEARNERS[name](), AGE_OUTPUT[name]))
    q.__doc__ = f"M2 out-of-fold age stack of the {name} learner."
    return q


q_stack_ridge_age = _age_query("ridge")  # M11
q_stack_par_age = _age_query("par")      # M12 (linear_mix)
q_stack_svr_age = _age_query("svr")      # M13 (linear_mix)


def q_svd_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 + T7: 10-component SVD scores of tf-idf and count vectors."""
    return svd_features(app_events(spark, sf_dir))


def q_app_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 + T9: skip-gram app vectors (token, vector)."""
    return skipgram.embedding_table(spark, skipgram.fit(G.app_sequence(app_events(spark, sf_dir))))


def q_skipgram_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8's training pairs: how often each app meets each other one within the
    seeded windows, after sub-sampling."""
    found = skipgram.pairs(durable(G.app_sequence(app_events(spark, sf_dir))))
    return found.groupBy("centre", "context").agg(F.count(F.lit(1)).alias("n"))


def q_stack_nn_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 + T8: skip-gram device vectors → MLP, out of fold."""
    devs = devices(spark, sf_dir)
    rows = durable(G.stack_rows(devs, gender_folds(devs)))
    return G.nn_stack(app_events(spark, sf_dir), devs, rows)


def q_stack_nn_log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out log loss of the sequence classifier, per fold."""
    devs = devices(spark, sf_dir)
    rows = durable(G.stack_rows(devs, gender_folds(devs)))
    out = G.nn_stack(app_events(spark, sf_dir), devs, rows)
    scored = out.join(rows.where("fold is not null"), "device_id")
    return MT.log_loss(scored, p="nn_sex_1").select("fold", F.round("log_loss", 6).alias("log_loss"))


def q_device_aggregates_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 with HyperLogLog distinct counts (the opt-in for very large logs)."""
    devs = devices(spark, sf_dir)
    aggs = ev_ops.device_event_aggregates(app_events(spark, sf_dir), exact_distinct=False)
    return _round_doubles(attach(devs, [aggs]))


def _base_models(spark, sf_dir):
    devs = devices(spark, sf_dir)
    folds = durable(gender_folds(devs))
    base = durable(device_feature_table(devs, app_events(spark, sf_dir), folds))
    return devs, folds, base


def q_gender_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15 + P10 (+M19 P2): boosted trees out of fold on the shared device
    features; unlabelled devices get the K-model mean and a 0/1 label."""
    devs, folds, base = _base_models(spark, sf_dir)
    data, cols = _model_table(base, folds, "gender", NOT_FEATURES)
    oof, test, imp, _ = gbt_oof(data, "classification", cols)
    return test.select("device_id", F.bround("s", 6).alias("gender_prob"), threshold("s").alias("gender"))


def q_gender_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M17 + A15: mean gain importance over folds, top 10."""
    devs, folds, base = _base_models(spark, sf_dir)
    data, cols = _model_table(base, folds, "gender", NOT_FEATURES)
    _, _, imp, _ = gbt_oof(data, "classification", cols)
    return MT.top_importances(imp)


def q_age_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16 + M18 + J7 + A18: the age model sees the true gender of labelled
    devices and the predicted gender of the others."""
    devs, folds, base = _base_models(spark, sf_dir)
    gdata, gcols = _model_table(base, folds, "gender", NOT_FEATURES)
    _, g_test, _, _ = gbt_oof(gdata, "classification", gcols)
    chained = chain_predicted(base, g_test.select("device_id", threshold("s").alias("gender_pred")))
    afolds = durable(assign_folds(devs.where("is_train = 1"), "age"))
    adata, acols = _model_table(chained, afolds, "age", NOT_AGE_FEATURES)
    _, a_test, _, _ = gbt_oof(adata, "regression", acols)
    return a_test.select("device_id", F.round("s", 6).alias("age"))


def q_device_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run: every stack, both boosted models, the result table
    (one row per raw unlabelled device row)."""
    prof = device_profile(devices(spark, sf_dir, dedup=False), app_events(spark, sf_dir))
    return prof.result


# ---------------------------------------------------------------- evaluation with SQL twins
def _encoded_train(spark, sf_dir, label, folds):
    devs = devices(spark, sf_dir)
    enc = kfold_target_encode(devs, folds, ["phone_brand"], label)
    return (devs.where("is_train = 1").select("device_id", F.col(label).alias("label"))
            .join(folds, "device_id").join(enc, "device_id"))


def q_encoding_binary_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16 (+M1): per-fold error of the out-of-fold brand encoding used as
    a gender score."""
    devs = devices(spark, sf_dir)
    t = _encoded_train(spark, sf_dir, "gender", gender_folds(devs))
    per = MT.binary_error(t, p="phone_brand_gender_kfold_mean")
    return per.select("fold", F.round("binary_error", 6).alias("binary_error"))


def q_encoding_error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16 summary: mean and population std over folds."""
    devs = devices(spark, sf_dir)
    t = _encoded_train(spark, sf_dir, "gender", gender_folds(devs))
    s = MT.summarize(MT.binary_error(t, p="phone_brand_gender_kfold_mean"), "binary_error")
    return s.select(*[F.round(c, 6).alias(c) for c in s.columns])


def q_encoding_age_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17 + A18 (+M1 on age, W1 by age): MAE and round(1/(1+MAE), 7) per fold."""
    devs = devices(spark, sf_dir)
    afolds = assign_folds(devs.where("is_train = 1"), "age")
    t = _encoded_train(spark, sf_dir, "age", afolds)
    s = MT.age_score(t, pred="phone_brand_age_kfold_mean")
    return s.select("fold", F.round("mae", 6).alias("mae"), "age_score")


def _doc_matrix(spark, sf_dir):
    docs = document_tokens_source(spark, sf_dir)
    texts = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("device_id"), "text")
    n = texts.agg(F.count(F.lit(1))).scalar()
    # texts are dealt out by document before they are tokenised: the counts by
    # (document, term) then need no shuffle of their own, which would move more
    # bytes than the texts
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tf = TX.term_counts(texts.repartition(n_parts, "device_id"), "device_id", "text")
    return docs, tf, n


def q_document_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T2 + T3 over whole documents (four languages)."""
    docs, tf, n = _doc_matrix(spark, sf_dir)
    return _round_doubles(TX.tfidf(tf, "device_id", n)).withColumnRenamed("device_id", "doc_id")


def q_document_nb_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 + M2 over documents: quality label, folds stratified by quality."""
    docs, tf, n = _doc_matrix(spark, sf_dir)
    # the count block and the tf-idf block have the same terms: one cell a term
    # carries both values
    tf = durable(tf)
    cells = durable(TX.tfidf(tf, "device_id", n, written=True).withColumnRenamed("term", "col"))
    # a document without an id has counts, but no weights
    width = (tf.groupBy("term").agg(F.max(F.col("device_id").isNotNull().cast("long")).alias("_w"))
             .agg(F.count(F.lit(1)) + F.coalesce(F.sum("_w"), F.lit(0))).first()[0])
    folds = assign_folds(docs.where("is_train = 1"), "label", n_labels_bound=2)
    rows = durable((docs.select("device_id", "label").join(folds, "device_id", "left")))
    out = oof_naive_bayes(cells, rows, width, "multinomial", prefix="doc_mnb", values=("tf", "tfidf"))
    return out.withColumnRenamed("device_id", "doc_id")


# ---------------------------------------------------------------- dense-vector learners on the embeddings table
def _embedding_rows(spark, sf_dir, label_mod=None):
    from pyspark.ml.functions import array_to_vector
    emb = read_table(spark, sf_dir, "embeddings")
    lab = (F.col("label") % label_mod) if label_mod else F.col("label")
    base = emb.select(F.col("vec_id").alias("device_id"), array_to_vector("embedding").alias("features"),
                      lab.cast("int").alias("label"), F.lit(1).alias("is_train"))
    folds = assign_folds(base, "label", key="device_id")
    return base.join(folds, "device_id").select("device_id", "features",
                                                F.col("label").cast("double").alias("label"), "fold")


def q_embedding_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 on dense 64-float vectors."""
    data = _embedding_rows(spark, sf_dir)
    return kmeans_features(data.select("device_id", "features"), (5, 10), "kmeans_").withColumnRenamed(
        "device_id", "vec_id")


def q_embedding_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15 on dense vectors (label % 2): held-out probabilities."""
    data = _embedding_rows(spark, sf_dir, 2)
    names = [f"e{i}" for i in range(64)]
    oof, _, _, _ = gbt_oof(data, "classification", names)
    return oof.select(F.col("device_id").alias("vec_id"), "fold", F.bround("s", 6).alias("p1"))


def q_embedding_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14's MLP on dense vectors (label % 2), out of fold."""
    data = _embedding_rows(spark, sf_dir, 2)
    out = oof_stack(data, mlp(layers=(64, 32, 2)), "emb_nn")
    return out.withColumnRenamed("device_id", "vec_id")
