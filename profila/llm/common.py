"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable, ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
#: rows in one Arrow batch of whole texts; bounds what a Python worker holds
TEXT_BATCH = 500
#: bytes of text that a worker works on at once (one longer text stands alone)
TEXT_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, by Spark's reader (any store Spark can reach)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of text and name the shared folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH))
    ensure_checkpoint_dir(spark)


def partitions(spark: SparkSession) -> int:
    """Tasks of a shuffle that feeds Python: the session's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_bytes(batch: pa.RecordBatch, column: str, most: int = TEXT_BYTES):
    """Slices of a batch whose texts hold about ``most`` bytes together."""
    sizes = batch.column(column).cast(pa.binary()).fill_null(b"")
    ends = np.cumsum(pa.compute.binary_length(sizes).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def lists_of(arrays: list[np.ndarray], kind=pa.int32()) -> pa.ListArray:
    """One list for each array."""
    ends = np.cumsum([0, *(len(x) for x in arrays)], dtype=np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each lengthened until no given column has it."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def words_of(text):
    """Number of words in a text column (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


__all__ = ["TEXT_BATCH", "TEXT_BYTES", "WORD", "by_bytes", "durable", "fresh", "lists_of", "partitions", "prepare", "read", "words_of"]
