"""Positions in a global order without a single-partition window.

``global_row_number`` range-partitions the rows on the order key (Spark
samples the key to cut ranges, so one device with a third of the rows is
spread over many partitions), sorts inside each partition, and adds each
partition's offset: the offsets come from a per-partition count table with
one row per partition, which is broadcast (bounded by the partition count).

Positions are consecutive inside every group that leads the order key, so
neighbours in a sequence are found inside blocks of positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..session import durable

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition index above bit 33


def global_row_number(df: DataFrame, order: list, name: str = "pos",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row in the total order
    ``order`` (columns or names; ties must be broken by the caller)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    ensure_checkpoint_dir(spark)
    ranged = durable(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off")))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _LOCAL_BITS)
    return (ranged.join(offsets, "_pid", "inner")
            .withColumn(name, F.col("_off") + local + 1)
            .drop("_pid", "_mid", "_off"))


def group_positions(df: DataFrame, group: str, order: list, name: str = "pos", write: bool = True) -> DataFrame:
    """1-based position inside ``group`` in ``order``: global position minus
    the group's first position (a partial ``min`` per group).  ``write``: the
    positions have several readers and are written once."""
    ranked = global_row_number(df, [group, *order], "_gpos")
    # written first, one row per group: joined as a plain side, so AQE can
    # split the rows of a hot group
    first = durable(ranked.groupBy(group).agg(F.min("_gpos").alias("_first")))
    out = (ranked.join(first, group, "inner")
           .withColumn(name, F.col("_gpos") - F.col("_first") + 1)
           .drop("_gpos", "_first"))
    return durable(out) if write else out


BLOCK = 4096


def ngrams(seq: DataFrame, group: str, token: str, n_max: int = 3, pos: str = "pos",
           sep: str = " ") -> DataFrame:
    """T4 over a positioned token sequence: ``(group, term)`` rows for every
    1..n_max-gram of consecutive positions (one row per occurrence).

    A group is cut into blocks of ``BLOCK`` positions, and the first n_max − 1
    rows of a block are copied to the end of the one before, so the next
    tokens are ``lead`` values inside a block: one shuffle, in which a hot
    group is many blocks."""
    block = F.floor((F.col(pos) - 1) / BLOCK)
    own = F.struct(block.alias("b"), F.lit(False).alias("copy"))
    back = F.struct((block - 1).alias("b"), F.lit(True).alias("copy"))
    near = ((F.col(pos) - 1) % BLOCK < n_max - 1) & (block > 0)
    rows = seq.select(F.col(group), F.col(pos).alias("_p"), F.col(token).alias("_t"),
                      F.explode(F.when(near, F.array(own, back)).otherwise(F.array(own))).alias("_b"))
    w = Window.partitionBy(group, "_b.b").orderBy("_p")
    ahead = rows.select(group, "_b", "_t", *(F.lead("_t", k).over(w).alias(f"_t{k}") for k in range(1, n_max)))
    grams, parts = [F.col("_t")], [F.col("_t")]
    for k in range(1, n_max):
        parts = [*parts, F.col(f"_t{k}")]
        grams.append(F.when(F.col(f"_t{k}").isNotNull(), F.concat_ws(sep, *parts)))
    return (ahead.where(~F.col("_b.copy")).select(group, F.explode(F.array(*grams)).alias("term"))
            .where(F.col("term").isNotNull()))
