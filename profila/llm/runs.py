"""Operator 11 — periodic runs of words by descending-LCP Kruskal.

A run is a longest stretch of consecutive words with smallest period q that is
at least ``MIN_WORDS`` and twice q words long.  In each text

1. places are sorted by the words that follow, by doubling of ranks, which also
   gives the LCP of sorted neighbours.  A run that starts at i makes the places
   i and i + q agree in L = length − q ≥ max(q, ``MIN_WORDS`` − q) words, so only
   places whose next ⌈``MIN_WORDS`` / 2⌉ words occur twice in the text are sorted;
2. neighbours are united by decreasing LCP, down to that bound, in a union-find
   whose classes hold their places in order; the smaller class goes into the
   larger one.  At LCP L a class holds the places that agree in L words or more;
3. places that become neighbours within a class at a distance d ≤ L seed a run
   of period d from the first place on, L + d words long.  A period below d
   would put a place of the class between them, so d is the smallest; i and
   i + q of a run always become neighbours, so no run is missing.  A seed that the
   word before continues belongs to a run that starts earlier and is dropped.

``collapsed`` is the text without the words that a run repeats: a word goes if
any run holds it after that run's first q words; the rest is joined by a space.

Each text is worked on alone, so no task gathers more than a batch of rows; a
text takes memory in proportion to its words, whole.  A null or empty text has
no words and no runs.  Repeated rows and null ids stay rows of their own; other
columns are kept if asked for by ``keep``.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, by_bytes, lists_of, prepare, read

MIN_WORDS = 12


class Places:
    """Places in order, in blocks of bounded length."""

    BLOCK = 1024
    __slots__ = ("blocks", "heads", "size")

    def __init__(self, place: int):
        self.blocks, self.heads, self.size = [[place]], [place], 1

    def add(self, place: int) -> tuple[int, int]:
        """Put a place in; its neighbours (−1: none)."""
        i = max(bisect_left(self.heads, place) - 1, 0)
        block = self.blocks[i]
        k = bisect_left(block, place)
        below = block[k - 1] if k else -1
        if k < len(block):
            above = block[k]
        else:
            above = self.heads[i + 1] if i + 1 < len(self.heads) else -1
        block.insert(k, place)
        self.size += 1
        if not k:
            self.heads[i] = place
        if len(block) > self.BLOCK:
            half = len(block) // 2
            self.blocks.insert(i + 1, block[half:])
            self.heads.insert(i + 1, block[half])
            del block[half:]
        return below, above


def encoded(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text, all words as numbers, and the texts' ends."""
    words = [t.split() for t in texts]  # bytes split at \x20 and \x09 to \x0D alone
    flat = pa.array([w for own in words for w in own], pa.binary()).dictionary_encode().indices
    return words, flat.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum([len(w) for w in words])


def repeating(numbers: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Whether a text holds any ``least`` words in a row twice, for each text."""
    sizes = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(len(ends)), sizes + 1)
    # a word of its own behind each text: no row of words across it occurs twice
    rank = np.insert(numbers, ends, len(numbers) + np.arange(len(ends)))
    at, width = np.arange(len(rank)), 1
    while width < least:
        step = min(width, least - width)
        ahead = rank[np.minimum(at + step, len(rank) - 1)]
        rank = pd.factorize(rank * (2 * len(rank)) + ahead)[0]
        width += step
    pair = pd.factorize(rank * len(ends) + owner)[0]
    return np.bincount(owner[np.bincount(pair)[pair] > 1], minlength=len(ends)) > 0


def suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places sorted by the words that follow, and the LCP of neighbours."""
    n = len(words)
    levels, width = [np.append(np.unique(words, return_inverse=True)[1] + 1, 0)], 1
    at = np.arange(n)
    while levels[-1].max() < n:
        rank = levels[-1]
        both = rank[:n] * (n + 1) + rank[np.minimum(at + width, n)]
        levels.append(np.append(np.unique(both, return_inverse=True)[1] + 1, 0).astype(np.int64))
        width *= 2
    order = np.argsort(levels[-1][:n])
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    for level in reversed(levels):
        same = level[a] == level[b]  # 0 stands for the end, which only one of them can reach
        for x in (a, b, lcp):
            x[same] += width
        width //= 2
    return order, lcp


def seeds(order: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """(place, distance, LCP) of places that become neighbours at a distance
    within the LCP, by Kruskal over decreasing LCP."""
    edges = np.flatnonzero(lcp >= least)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    parent = {}
    held: dict[int, Places] = {}

    def find(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    found = []
    for x, y, length in zip(order[edges].tolist(), order[edges + 1].tolist(), lcp[edges].tolist()):
        a, b = find(x), find(y)
        large, small = held.get(a) or Places(a), held.pop(b, None) or Places(b)
        if small.size > large.size:
            large, small = small, large
        parent[b] = a
        held[a] = large
        # neighbours are one place of either class: those within a class are old
        own, last = [p for block in small.blocks for p in block], -1
        for p, later in zip(own, [*own[1:], None]):
            below, above = large.add(p)
            if below >= 0 and below != last and p - below <= length:
                found.append((below, p - below, length))
            if above >= 0 and (later is None or above < later) and above - p <= length:
                found.append((p, above - p, length))
            last = p
    return np.array(found, np.int64).reshape(-1, 3)


def runs_of(words: np.ndarray, least: int = MIN_WORDS) -> np.ndarray:
    """(start, length, period) of every run of a text, by start, then period."""
    if len(words) < 2:
        return np.empty((0, 3), np.int64)
    start, period, length = seeds(*suffixes(words), -(-least // 2)).T
    first = (start == 0) | (words[start - 1] != words[start + period - 1])
    out = np.stack([start, length + period, period], axis=1)[first & (length + period >= least)]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Places of the words that no run repeats."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.flatnonzero(np.cumsum(edge[:n]) == 0)


def periodic_runs(docs: DataFrame, text: str = "text", keep=("doc_id",), min_words: int = MIN_WORDS) -> DataFrame:
    """The columns ``keep`` and n_words, the arrays starts, lengths and periods
    over the text's runs, and the collapsed text."""
    prepare(docs.sparkSession)
    fields = [docs.schema[c] for c in keep]
    rows = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    least, none = -(-min_words // 2), np.empty((0, 3), np.int64)

    def run(batches):
        for batch in batches:
            for part in by_bytes(batch, "text"):
                words, numbers, ends = encoded(part.column("text").to_pylist())
                again = repeating(numbers, ends, least) if len(numbers) else np.zeros(len(ends), bool)
                found = [runs_of(numbers[end - len(w):end], min_words) if r else none
                         for w, end, r in zip(words, ends, again)]
                kept = [b" ".join(w if not len(f) else [w[i] for i in kept_words(len(w), f)]).decode()
                        for w, f in zip(words, found)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([len(w) for w in words], pa.int64()),
                     *(lists_of([f[:, c] for f in found], pa.int64()) for c in range(3)), pa.array(kept, pa.string())],
                    [*part.schema.names[:-1], "n_words", "starts", "lengths", "periods", "collapsed"])

    kinds = [f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(fields)]
    out = rows.mapInArrow(run, ", ".join([*kinds, "n_words long", "starts array<long>", "lengths array<long>",
                                          "periods array<long>", "collapsed string"]))
    return out.select(*(F.col(f"k{i}").alias(f.name) for i, f in enumerate(fields)),
                      "n_words", "starts", "lengths", "periods", "collapsed")


def unrolled(docs: DataFrame) -> DataFrame:
    """The query's texts: where h = crc32(doc_id) ends in 0, word i ≥ a becomes
    word a + (i − a) mod p.  A null id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr(f"regexp_extract_all(text, r'{WORD}', 0)")
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    g, n = F.floor(F.col("h") / 10), F.size("w")
    rows = rows.withColumn("a", F.when(n > 0, g % n))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    rolled = F.expr("array_join(transform(sequence(0, size(w) - 1), i -> w[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')")
    return rows.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(rolled).alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: runs of every document of ``unrolled``, and digests."""
    found = periodic_runs(unrolled(read(spark, sf_dir, "documents").select("doc_id", "text")))
    zipped = F.arrays_zip("starts", "lengths", "periods")
    longest = F.array_max(F.transform(zipped, lambda r: F.struct(
        r["lengths"].alias("length"), (-r["starts"]).alias("start"), (-r["periods"]).alias("period"))))
    lines = F.array_join(F.transform(zipped, lambda r: F.concat_ws(
        ",", r["starts"].cast("string"), r["lengths"].cast("string"), r["periods"].cast("string"))), "\n")
    runs = F.when(F.size("starts") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    top = found.withColumn("top", longest)
    length, period = F.col("top.length"), -F.col("top.period")
    return top.select("doc_id", F.size("starts").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
                      length.alias("length"), period.alias("period"),
                      F.floor(1000 * length / period).alias("exponent_milli"),
                      F.sha2(runs.cast("binary"), 256).alias("runs_sha256"),
                      F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def oracle_sql() -> str:
    """Islands of places whose next 6 words recur q words on are stretches of
    period q; those inside a stretch of a smaller period are no runs."""
    half = -(-MIN_WORDS // 2)
    return f"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
    4294967295 - list_reduce(list_concat([4294967295], list_transform(range(1, len(doc_id::varchar) + 1), lambda i: ord(substr(doc_id::varchar, i, 1)))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) as h
  from documents
), s as (
  select *, len(w) as n, (h // 10) % len(w) as a, 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) as p from d
), t as (
  select r, doc_id, n, case when h % 10 = 0 and n > 0
    then list_transform(range(n), lambda i: w[(case when i < a then i else a + (i - a) % p end) + 1]) else w end as w from s
), g as (
  select r, i, array_to_string(w[i + 1:i + {half}], ' ') as gram
  from (select r, w, n, unnest(range(n - {half - 1})) as i from t where n >= {half})
), j as (
  select x.r, y.i - x.i as q, x.i from g x join g y on x.r = y.r and x.gram = y.gram and y.i > x.i
), k as (
  select r, q, min(i) as start, count(*) + {half - 1} + q as length
  from (select *, i - row_number() over (partition by r, q order by i) as island from j) group by r, q, island
), c as (
  select * from k where length >= {MIN_WORDS} and length >= 2 * q
), runs as (
  select * from c where not exists (select 1 from c b where b.r = c.r and b.q < c.q and b.start <= c.start
    and b.start + b.length >= c.start + c.length)
), u as (
  select r, count(*) as n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' order by start, q) as lines,
    first({{'start': start, 'length': length, 'period': q}} order by length desc, start, q) as top from runs group by r
), gone as (
  select distinct r, unnest(range(start + q, start + length)) as i from runs
), kept as (
  select f.r, string_agg(f.word, ' ' order by f.i) as words
  from (select r, unnest(w) as word, unnest(range(n)) as i from t) f anti join gone using (r, i) group by f.r
)
select t.doc_id, coalesce(u.n_runs, 0)::bigint as n_runs, top.start::bigint as start, top.length::bigint as length,
  top.period::bigint as period, (1000 * top.length // top.period)::bigint as exponent_milli,
  sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(words, '')) as collapsed_sha256
from t left join u using (r) left join kept using (r)"""
