"""Stratified, shuffled, seeded K-fold assignment.

Rows are ordered by ``(label, md5(key ':' seed))`` and dealt round-robin to
K folds, so each class is spread over the folds with sizes differing by at
most one, and the same seed gives the same folds in any engine that has
md5.

The global position is computed without a single-partition window: the
hash space is cut into ``16**prefix`` buckets by its leading hex digits.
Counting rows per (label, bucket) gives a small table whose running sum is
each bucket's offset; the position inside a bucket is a ``row_number``
partitioned by (label, bucket).  md5 spreads rows evenly over buckets, so
no bucket is hot whatever the key distribution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import broadcast_bounded

DEFAULT_K = 5
DEFAULT_SEED = 2021


def shuffle_hash(key: str = "device_id", seed: int = DEFAULT_SEED):
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def assign_folds(train: DataFrame, label: str, k: int = DEFAULT_K, seed: int = DEFAULT_SEED,
                 key: str = "device_id", prefix: int = 3, n_labels_bound: int | None = None,
                 fold_col: str = "fold") -> DataFrame:
    """Return ``(key, fold)`` for every row of ``train`` with a label.

    ``n_labels_bound``: a known bound on distinct labels (2 for a binary
    target) lets the offset table be broadcast; otherwise AQE sizes it.
    """
    h = shuffle_hash(key, seed)
    rows = (train.where(F.col(label).isNotNull())
            .select(F.col(key), F.col(label).alias("_lbl"), h.alias("_h"))
            .withColumn("_b", F.substring("_h", 1, prefix)))
    per_bucket = rows.groupBy("_lbl", "_b").agg(F.count(F.lit(1)).alias("_n"))
    # Running offset over the bucket table (≤ labels × 16**prefix rows).
    w_off = Window.orderBy("_lbl", "_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select("_lbl", "_b", F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    if n_labels_bound is not None:
        offsets = broadcast_bounded(offsets, n_labels_bound * 16 ** prefix)
    w_pos = Window.partitionBy("_lbl", "_b").orderBy("_h")
    ranked = rows.withColumn("_rn", F.row_number().over(w_pos))
    return (ranked.join(offsets, ["_lbl", "_b"], "inner")
            .select(F.col(key), ((F.col("_off") + F.col("_rn") - 1) % k).cast("int").alias(fold_col)))
