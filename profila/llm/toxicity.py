"""Operator 1 — toxicity by multiple-instance learning.

A document is a bag of sentences.  A word is known by its most telling prefix
(three to seven characters, or the whole word), and a sentence s scores
p_s = σ(b + Σ w[f]) over its distinct prefixes f; the document's score is a
leaky noisy-or, 1 − (1 − leak)·Π(1 − p_s): the leak takes up labels that no
sentence explains.  Sentences without a known word take no part, and in scoring
only those count whose words raise the log odds by ``LEAST`` (1) or more, so
that a long clean text does not become toxic by its length.  w, b and leak are trained from document labels
alone by the gradient of the document likelihood; the sentence scores then
locate the offending sentences.

Training uses a bounded sample: ``max_train`` labelled documents (default
20,000), those with the smallest hash of their id, equal texts counted once,
and at most ``max_features`` prefixes (default 8,192): those whose share of
toxic documents deviates from the whole's by ``min_z`` standard errors.  They
start at their smoothed log odds where these are positive, else at 0, and
``l2`` holds them near that.  The sample is kept as a table of prefix numbers
per sentence, cut into ``n_shards`` shards by hash; in each round every shard
takes some gradient steps in a task of its own and the shards' weights are
averaged prefix by prefix.  The result depends on the data and these parameters only.  Scoring
runs over every whole text, in one pass and without a shuffle.

Null and empty texts, and texts without a sentence, score as one sentence
without words.  Labels that are null, have a null id or no document are
ignored; of several labels for an id the largest counts.  Without labels of
both classes every text gets the share of toxic labels (0 if there are none).
Repeated rows score alike; other columns pass through untouched.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import durable, prepare, read

SENTENCE = re.compile(r"[^.!?\n]+")
TOKEN = re.compile(r"\w+")
THRESHOLD = 0.7
LOCATE = 0.5  # z = 0
LEAST = 1.0
_START = -9.0
_MEMO = 200_000


@dataclass
class Model:
    """Prefixes, the most telling first, and their weights; sentence bias;
    leak as −log(1 − leak); the least sum of weights of a sentence that counts
    (``LEAST`` in fitted models)."""
    number: dict[str, int] = field(default_factory=dict)
    weights: list[float] = field(default_factory=list)
    bias: float = -800.0
    leak: float = 0.0
    least: float = -math.inf


def prefixes(word: str) -> set[str]:
    return {word[:k] for k in range(3, 8)} | {word}


class Known(dict):
    """word → number of its most telling prefix, −1 if it has none; forgets
    when full."""

    def __init__(self, number: dict[str, int]):
        super().__init__()
        self.number = number

    def __missing__(self, word: str) -> int:
        if len(self) >= _MEMO:
            self.clear()
        found = [self.number[p] for p in prefixes(word) if p in self.number]
        at = self[word] = min(found, default=-1)
        return at


def sentences(text: str):
    """(start, end, distinct lower-case words) of each sentence; one empty
    sentence if there is none."""
    some = False
    for m in SENTENCE.finditer(text):
        words = set(TOKEN.findall(m.group().lower()))
        if words:
            some = True
            yield m.start(), m.end(), words
    if not some:
        yield 0, 0, set()


def score_text(text: str | None, model: Model, known: Known | None = None) -> tuple[float, list[tuple[int, int, float]]]:
    """Document score and the offending sentences (start, end, p)."""
    known = Known(model.number) if known is None else known
    at, weights = known.__getitem__, model.weights
    total, base, found = model.leak, math.log1p(math.exp(model.bias)) if model.least <= 0 else 0.0, []
    for start, end, words in sentences(text or ""):
        ids = set(map(at, words))
        ids.discard(-1)
        if not ids:
            total += base
            continue
        lift = sum([weights[i] for i in ids])
        if lift < model.least:
            continue
        z = model.bias + lift
        total += z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))
        if z >= 0:
            found.append((start, end, 1 / (1 + math.exp(-z))))
    return -math.expm1(-total), found


def score(text: Column, model: Model) -> Column:
    """struct(score, sentences: array of (start, end, p)) of a text column;
    sentences are those with p of ``LOCATE`` or more."""
    kind = "struct<score:double,sentences:array<struct<start:int,end:int,p:double>>>"
    arrow = pa.struct([("score", pa.float64()), ("sentences", pa.list_(pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))])

    @arrow_udf(kind)
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Known(model.number)
        for batch in texts:
            out = []
            for t in batch.to_pylist():
                p, found = score_text(t, model, known)
                out.append({"score": p, "sentences": [{"start": a, "end": b, "p": q} for a, b, q in found]})
            yield pa.array(out, arrow)
    return run(text)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """(text, y) of the bounded sample, equal texts once."""
    known = (labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("y"))
             .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    known = F.broadcast(durable(known))  # max_train rows at most
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id")
            .groupBy("text").agg(F.max("y").alias("y")))


def _bags(rows: DataFrame, n_shards: int) -> DataFrame:
    """(shard, y, words) with words an array of sentences' words."""
    @arrow_udf("array<array<string>>")
    def bag(texts: pa.Array) -> pa.Array:
        return pa.array([[sorted(w) for _, _, w in sentences(t)] for t in texts.to_pylist()], pa.list_(pa.list_(pa.string())))
    return rows.select(F.pmod(F.xxhash64("text"), F.lit(n_shards)).cast("int").alias("shard"), "y", bag("text").alias("words"))


def _count(batches):
    """Documents and toxic documents of each prefix, per batch of documents."""
    for b in batches:
        df, hits = Counter(), Counter()
        for y, doc in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            found = set().union(*(prefixes(w) for w in set().union(*doc)))
            df.update(found)
            if y:
                hits.update(found)
        words = list(df)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([df[w] for w in words], pa.int64()),
                                          pa.array([hits[w] for w in words], pa.int64())], ["word", "df", "hits"])


def _steps(pdf: pd.DataFrame, start: np.ndarray, prior: np.ndarray, steps: int, rate: float, l2: float):
    """Gradient steps of one shard: new parameters (w, bias, log leak) and, for
    each, the number of sentences it moved by."""
    n_features = len(start) - 2
    feats = [np.asarray(s, np.int64) for doc in pdf["ids"] for s in doc]
    doc = np.repeat(np.arange(len(pdf)), [len(d) for d in pdf["ids"]])
    y = pdf["y"].to_numpy(float)
    sent = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    at = np.concatenate(feats) if feats else np.empty(0, np.int64)
    theta, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    seen = np.bincount(at, minlength=n_features).astype(float)
    pace = rate * np.append(seen > 0, [0.2, 0.2])
    for k in range(1, steps + 1):
        w, b, a = theta[:-2], theta[-2], theta[-1]
        z = b + np.bincount(sent, w[at], len(feats))
        leak = np.exp(a)
        total = leak + np.bincount(doc, np.logaddexp(0, z), len(pdf))
        pull = np.where(y > 0, -1 / np.expm1(np.maximum(total, 1e-9)), 1.0)  # dNLL / dtotal
        g = pull[doc] / (1 + np.exp(-z)) if len(doc) else np.empty(0)
        grad = np.concatenate([np.bincount(at, g[sent], n_features) + l2 * (w - prior),
                               [g.sum(), (pull * leak).sum()]])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta - pace * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
        theta[-2] = min(theta[-2], _START)
    return theta, np.append(seen, [len(pdf), len(pdf)])


def _local(start: np.ndarray, prior: np.ndarray, steps: int, rate: float, l2: float):
    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        new, by = _steps(pdf, start, prior, steps, rate, l2)
        return pd.DataFrame({"theta": [new], "by": [by]})
    return local


def fit(docs: DataFrame, labels: DataFrame, max_train: int = 20_000, max_features: int = 8_192,
        n_shards: int = 4, rounds: int = 3, steps: int = 30, rate: float = 0.1, l2: float = 4.0,
        min_docs: int = 5, min_share: float = 0.002, min_z: float = 5.0, smooth: float = 2.0) -> Model:
    """Train from ``labels`` (doc_id, toxic) over ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    bags = durable(_bags(training_rows(docs, labels, max_train), n_shards))
    n, toxic = bags.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n or toxic in (0, n):
        share = toxic / n if n else 0.0
        return Model(leak=-math.log1p(-share) if share < 1 else 40.0)
    base = toxic / n
    z = (F.col("hits") - F.col("df") * base) / F.sqrt(F.col("df") * (base * (1 - base)))
    chosen = (bags.select("y", "words").mapInArrow(_count, "word string, df long, hits long").groupBy("word")
              .agg(F.sum("df").alias("df"), F.sum("hits").alias("hits"))
              .where((F.col("df") >= max(min_docs, min_share * n)) & (F.abs(z) >= min_z))
              .orderBy(F.abs(z).desc(), F.length("word"), "word").limit(max_features)
              .select("word").collect())  # max_features rows at most
    number = {r.word: i for i, r in enumerate(chosen)}

    @arrow_udf("array<array<int>>")
    def coded(docs_words: pa.Array) -> pa.Array:
        known, out = Known(number), []
        for doc in docs_words.to_pylist():
            ids = [sorted(set(map(known.__getitem__, s)) - {-1}) for s in doc]
            out.append([s for s in ids if s])
        return pa.array(out, pa.list_(pa.list_(pa.int32())))

    table = durable(bags.select("shard", "y", coded("words").alias("ids")))
    counts = (table.select("y", F.explode(F.array_distinct(F.flatten("ids"))).alias("i")).groupBy("i")
              .agg(F.count(F.lit(1)).alias("df"), F.sum("y").alias("hits")).collect())  # max_features rows at most
    odds = np.full(len(number), -1.0)
    for r in counts:
        odds[r.i] = math.log((r.hits + 0.5) / (r.df - r.hits + smooth))
    prior = np.where(odds > 0, odds - _START, 0.0)
    telling = F.array(*(F.lit(int(i)) for i in np.flatnonzero(odds > 0))).cast("array<int>")
    unled = table.where(~F.arrays_overlap(F.flatten("ids"), telling)) if (odds > 0).any() else table
    blind, hits = unled.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    leak = -math.log1p(-(hits + 0.5) / (blind + 1))  # toxic labels no telling word explains
    theta = np.concatenate([prior, [_START, math.log(leak)]])
    for _ in range(rounds):
        local = _local(theta, prior, steps, rate, l2)
        parts = table.groupBy("shard").applyInPandas(local, "theta array<double>, by array<double>").collect()
        new, by = (np.array([r[k] for r in parts]) for k in (0, 1))  # n_shards rows
        weight = by.sum(axis=0)
        theta = np.where(weight > 0, (new * by).sum(axis=0) / np.maximum(weight, 1), theta)
    return Model(number, theta[:-2].tolist(), float(theta[-2]), float(np.exp(theta[-1])), LEAST)


def classify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, sentences) of every row."""
    return (docs.select("doc_id", score(F.col(text_col), model).alias("s"))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("s.score").alias("score"),
                    (F.col("s.score") >= THRESHOLD).cast("int").alias("predicted"), F.col("s.sentences").alias("sentences")))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    return (classify(docs, model)
            .select("doc_id", "held_out", "score", "predicted", F.size("sentences").cast("long").alias("n_offending")))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that score below the threshold, columns as they are."""
    return docs.where(score(F.col("text"), model).getField("score") < THRESHOLD)
