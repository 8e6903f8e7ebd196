"""Sparse feature matrices (T5) in long form and as ML vectors.

Long form: ``(device_id, col, value)`` where ``col`` = ``"{block}|{term}"``;
blocks are laid side by side in the order given (``hstack``).  Column
indices come from the alphabetical order of the keys, each block prefixed
with its position so blocks stay in order.

``to_vectors`` gathers each device's non-zero cells (one row of the matrix: at
most as many as the device has different terms, whatever its event volume) and
writes them in the stored form of ML's sparse vectors, which the table is then
read back as: no Python on the way.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import durable
from .text import tfidf, vocabulary


def block_matrix(blocks: list[tuple[str, DataFrame, str]], group: str = "device_id") -> DataFrame:
    """Stack ``(name, df(group, term, value_col), value_col)`` blocks into one
    long matrix ``(group, col, value)``."""
    parts = []
    for i, (name, df, value_col) in enumerate(blocks):
        parts.append(df.select(F.col(group), F.concat(F.lit(f"{i:02d}{name}|"), F.col("term")).alias("col"),
                               F.col(value_col).cast("double").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_tfidf_blocks(tf: DataFrame, name: str, n_docs, group: str = "device_id") -> list:
    """A count block and a tf-idf block of the same terms (T2 + T3).  The
    term counts feed three branches (counts, document frequency, tf-idf),
    so they are written once."""
    tf = durable(tf)
    w = tfidf(tf, group, n_docs, written=True)
    return [(f"c{name}", tf, "tf"), (f"t{name}", w, "tfidf")]


def matrix_vocabulary(matrix: DataFrame) -> DataFrame:
    """``(col, idx)`` for every matrix column."""
    return vocabulary(matrix.select(F.col("col").alias("term"))).withColumnRenamed("term", "col")


def to_vectors(matrix: DataFrame, vocab: DataFrame, size, base: DataFrame,
               group: str = "device_id", out: str = "features") -> DataFrame:
    """One sparse vector per row of ``base``, as a written table (rows without
    cells get an all-zero vector)."""
    cells = (matrix.join(vocab, "col", "inner")
             .groupBy(group)
             .agg(F.array_sort(F.collect_list(F.struct(F.col("idx").cast("int").alias("i"),
                                                       F.col("value").alias("v")))).alias("_cells")))
    own = F.coalesce("_cells", F.array().cast("array<struct<i:int,v:double>>"))
    # the stored form: kind 0 (sparse), length, places, values
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"),
                      (size if isinstance(size, F.Column) else F.lit(size)).cast("int").alias("size"),
                      own.getField("i").alias("indices"), own.getField("v").alias("values"))
    stored = base.join(cells, group, "left").withColumn(out, vector).drop("_cells")
    read_as = StructType([StructField(out, VectorUDT()) if f.name == out else f for f in stored.schema.fields])
    return durable(stored, read_as)
