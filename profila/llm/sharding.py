"""Operator 5 — sharding by rendezvous hashing over weighted shards.

Every shard j gives a record the draw −ln(u(key, j)) / weight[j], u a hash in
(0, 1); the record goes to the shard of the smallest draw.  So the stable key
(doc_id) and the shards alone decide (law ``key``), shards get records in
proportion to their weights, and a further shard takes records only into
itself: about one in n + 1 moves, none between old shards.

Slots number the records of a shard from 0 without gaps, in the order of a
hash of the key.  They come from counts of 4,096 hash ranges of each shard and
the order inside one range, so no task orders a whole shard; records that
agree in all returned columns are counted before they are ordered.

A null id is a key of its own.  Null text has size 1 and the checksum of an
empty text.  Repeated rows share a shard and have slots of their own.  Other
columns are ignored by ``assign`` and kept by ``write``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, fresh, prepare, read

SHARDS = 16
LAW = "key"
_CHUNK = 65_536


def draw(key: Column, shard: int, weight: float) -> Column:
    """The record's draw at one shard: exponential with the shard's rate."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(f"shard {shard}")), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.ln(u) / F.lit(float(weight))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key over shards 0 … len(weights) − 1."""
    draws = (F.struct(draw(key, j, w).alias("draw"), F.lit(j).alias("shard")) for j, w in enumerate(weights) if w > 0)
    return F.array_min(F.array(*draws)).getField("shard")


def assign(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, added: float = 1.0) -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes plus 1), text_crc32,
    law, shard, slot and grown_shard (with a further shard of weight ``added``)."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = (docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
            .groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n")))
    key = F.col("doc_id")
    rows = durable(rows.withColumn("shard", shard_of(key, weights))
                   .withColumn("grown_shard", shard_of(key, [*weights, added]))
                   .withColumn("at", F.xxhash64(F.lit("slot"), "doc_id", "size", "text_crc32"))
                   .withColumn("range", F.shiftrightunsigned(F.col("at"), 52).cast("int")))
    counts = rows.groupBy("shard", "range").agg(F.sum("n").alias("m"))  # 4,096 rows a shard at most
    run = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = durable(counts.select("shard", "range", F.coalesce(F.sum("m").over(run), F.lit(0)).alias("start")))
    inside = (Window.partitionBy("shard", "range").orderBy("at", "doc_id", "size", "text_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.join(starts, ["shard", "range"]).withColumn("first", F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _CHUNK)))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("n") - F.col("chunk") * _CHUNK, F.lit(_CHUNK).cast("long")) - 1))
    return (placed.withColumn("chunk", chunk).withColumn("copy", each)
            .select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
                    (F.col("first") + F.col("chunk") * _CHUNK + F.col("copy")).alias("slot"), "grown_shard"))


def write(docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * SHARDS) -> None:
    """Write the documents as one folder of Parquet files for each shard."""
    name, = fresh(docs.columns, "shard")
    docs.withColumn(name, shard_of(F.col("doc_id"), weights)).write.partitionBy(name).parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    return assign(read(spark, sf_dir, "documents"))
