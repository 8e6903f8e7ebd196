"""Corpus pipeline over ``documents``: toxicity, SimHash near-dedup, benchmark
decontamination, mixing, sharding.  Each stage is written as Parquet and
reread as the next one's input; all but the last return documents' columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from profila.llm import decontaminate, mixing, sharding, simhash, toxicity
from profila.llm.common import durable, read


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that score 0.7 or more go."""
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.without_toxic(docs, toxicity.fit(docs.select("doc_id", "text"), labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each class stays."""
    return simhash.keep_one(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: each document as often as the mix takes it."""
    return mixing.sample(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: shard and slot of each document of the mix."""
    return sharding.assign(docs)


STAGES = [
    ("toxicity", toxic),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", leaks),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Learned scores and edit distances have no SQL; tests/llm holds the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
