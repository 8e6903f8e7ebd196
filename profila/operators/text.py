"""Text features of the app and tag lists in relational form (T1–T4, T10,
T11, W2, O4).

A document is a device's list; its terms are word tokens (T1).  Term
frequencies are an explode + ``groupBy(device, term)`` (partial
aggregation, skew-safe); document frequencies a ``groupBy(term)`` of the
(device, term) pairs.  TF-IDF follows the smooth-idf rule
``tf · (ln((1+n)/(1+df)) + 1)`` with per-document L2 normalisation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import word_tokens
from ..session import durable
from .joins import join_by_frequency
from .sequence import global_row_number, group_positions


def term_counts(docs: DataFrame, group: str, text, min_len: int = 2, weight: str | None = None) -> DataFrame:
    """T1 + T2: ``(group, term, tf)``.  ``text`` is a string column whose
    word tokens are the terms; ``weight`` optionally counts a row more than
    once."""
    text_col = F.col(text) if isinstance(text, str) else text
    w = F.col(weight) if weight else F.lit(1)
    return (docs.select(F.col(group), F.explode(word_tokens(text_col, min_len)).alias("term"), w.alias("_w"))
            .groupBy(group, "term").agg(F.sum("_w").cast("long").alias("tf")))


def term_counts_of_terms(terms: DataFrame, group: str, term: str = "term") -> DataFrame:
    """T2 for already-formed terms (n-grams): ``(group, term, tf)``."""
    return terms.groupBy(group, F.col(term).alias("term")).agg(F.count(F.lit(1)).cast("long").alias("tf"))


def document_frequency(tf: DataFrame, group: str) -> DataFrame:
    return tf.groupBy("term").agg(F.count(F.lit(1)).cast("long").alias("df"))


def tfidf(tf: DataFrame, group: str, n_docs=None, written: bool = False) -> DataFrame:
    """``(group, term, tf, tfidf)`` with smooth idf + 1 and L2 norm.
    ``n_docs`` (int or Column, e.g. a scalar subquery) defaults to the
    number of documents present in ``tf``; ``written``: tf is a table."""
    tf = tf if written else durable(tf)  # read by the frequency, the norm and the result
    df_ = document_frequency(tf, group)
    if n_docs is None:
        n_docs = tf.select(group).distinct().agg(F.count(F.lit(1))).scalar()
    # both aggregated sides are written before they are joined: a side that
    # arrives grouped on the join key keeps AQE from splitting a hot term or
    # a hot document
    idf = durable(df_.select("term", "df", (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf")))
    raw = join_by_frequency(tf, idf, "term", "df", 80).withColumn("_w", F.col("tf") * F.col("idf"))
    norm = durable(raw.groupBy(group).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm")))
    return (raw.join(norm, group, "inner")
            .select(F.col(group), "term", "tf", (F.col("_w") / F.col("_norm")).alias("tfidf")))


def vocabulary(tf: DataFrame, prefix: str = "") -> DataFrame:
    """Term → 0-based column index in alphabetical order (the vectoriser's
    convention), numbered with a distributed global row number."""
    terms = tf.select(F.concat(F.lit(prefix), F.col("term")).alias("term")).distinct()
    return global_row_number(terms, ["term"], "idx").select("term", (F.col("idx") - 1).alias("idx"))


def frequency_rank(seq: DataFrame, token: str) -> DataFrame:
    """Token → rank, 1 = most frequent, ties by token text."""
    counts = seq.groupBy(F.col(token).alias("token")).agg(F.count(F.lit(1)).alias("cnt"))
    return global_row_number(counts, [F.col("cnt").desc(), F.col("token").asc()], "rank") \
        .select("token", "cnt", "rank")


def padded_sequence(seq: DataFrame, group: str, token: str, ranks: DataFrame, maxlen: int = 50) -> DataFrame:
    """T10 + O4: the group's tokens as frequency ranks, last ``maxlen`` kept,
    left-padded with 0 → ``(group, seq)`` with ``seq`` an int array of
    length ``maxlen``.  Only ≤ maxlen rows per group are collected."""
    coded = seq.join(ranks.select(F.col("token").alias(token), "rank"), token, "inner")
    coded = group_positions(coded.select(group, "pos", "rank"), group, ["pos"], "_k")
    length = durable(coded.groupBy(group).agg(F.max("_k").alias("_n")))  # a plain side, so AQE can split a hot group
    tail = coded.join(length, group).where(F.col("_k") > F.col("_n") - maxlen)
    arr = tail.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_k", F.col("rank").cast("int").alias("r")))),
                    lambda s: s["r"]).alias("_tail"))
    pad = F.array_repeat(F.lit(0), F.greatest(F.lit(maxlen) - F.size("_tail"), F.lit(0)))
    return arr.select(group, F.concat(pad, F.col("_tail")).alias("seq"))
