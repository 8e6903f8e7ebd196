"""Operator 9 — substring dedup by content-defined chunking.

A gear hash rolls over the UTF-8 bytes of each whole text,
h = (h << 1) + G[byte] mod 2^16; a chunk ends where its four highest bits are
0, so the ends depend on the 16 bytes before them only and an insertion moves
no other end.  Chunks have 8 to 128 bytes, about 24, and never cut a character.
Chunks are deduplicated by a 64-bit digest wherever they lie: of one that occurs
more than once, in one document or in several, the first occurrence stays (by
document id, then hash of id and text, then place) and the others are copies.

Neighbouring repeated chunks form a run; runs of at least ``min_words`` (25)
words are reported, in ``parts``: a part ends where chunks that stay meet
chunks that are copies, so every chunk stays in one place.  A passage
repeated word for word loses part of a chunk at either end, so a passage of
over 50 words makes such a run, while a shared line or phrase does not (chunks
across its ends are not repeated).

Texts are chunked where they are read; only (digest, text's hash, place) rows,
three longs and a mark, are shuffled, once.  A stream sorted by digest hands on
the chunks of digests that occur twice, holding one row at most.  A digest that
a reading task meets twice is known to recur: one row of it goes to the digest's
partition for all others, the rest are dealt by place, so a digest of a third
of all documents fills no task.  What the streams hand on is written; the rest
works on that small part: the first occurrence of each digest, aggregated
before it is shuffled and written before it is joined, and runs in a stream
sorted by place.

Rows that agree in id and text are one document; rows of one id with different
texts are different ones.  A null id stands for a document of its own text,
after all others.  Null and empty texts have no chunks.  Other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, durable, partitions, prepare, read

LOW, HIGH = 8, 128
WINDOW = 16
MIN_WORDS = 25
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 9) & 0xFFFF for b in range(256)], np.uint16)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_NO_KEY = 1 << 62
_PLACE = "digest long, rid long, place long"
#: of a chunk's digest: met once so far; recurs, and this row tells it; recurs
_ONCE, _TELLS, _KNOWN = 0, 1, 2
_BUFFER = 1 << 16
#: recurring digests that a reading task remembers to have told
_REMEMBERED = 1 << 16


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, all at once: the hash of 2s bytes is
    that of the last s plus that of the s before, shifted."""
    h = GEAR[data]
    for s in (1, 2, 4, 8):
        h = np.concatenate([h[:s], h[s:] + (h[:-s] << np.uint16(s))])
    return h


def cut(ends: np.ndarray, size: int) -> list[int]:
    """Chunk ends of a text of ``size`` bytes, from its possible ends and
    the starts of its characters."""
    out, last = [], 0
    for end in ends:
        if end - last >= LOW:
            out.append(end)
            last = end
    if last < size:
        out.append(size)
    return out


def chunks(data: bytes) -> list[tuple[int, int]]:
    """(start, end) in bytes of one text's chunks."""
    flat = np.frombuffer(data, np.uint8)
    return list(_spans(flat, gear(flat), 0, len(flat)))


def _spans(flat: np.ndarray, h: np.ndarray, a: int, b: int):
    """Chunks of the text flat[a:b], relative to a."""
    first = np.append((flat[a + 1:b] & 0xC0) != 0x80, True)  # a character may end here
    possible = np.flatnonzero((h[a:b] >> 12 == 0) & first) + 1
    last = 0
    for end in cut(possible[possible >= WINDOW].tolist(), b - a):
        while end - last > HIGH:
            stop = last + HIGH
            while not first[stop - 1]:
                stop -= 1
            yield last, stop
            last = stop
        yield last, end
        last = end


def pack(start: np.ndarray, length: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A chunk's place: start and length (code points) and words begun."""
    return start.astype(np.int64) << 16 | length.astype(np.int64) << 8 | words.astype(np.int64)


def _places(batch: pa.RecordBatch):
    """digest, rid and place of the chunks of a batch of (rid, text)."""
    texts = batch.column(1).cast(pa.binary())
    if not len(texts) or texts.null_count == len(texts):
        return None
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    low = int(offsets[0])
    data = memoryview(texts.buffers()[2] or b"")[low:int(offsets[-1])]
    flat = np.frombuffer(data, np.uint8)
    if not len(flat):
        return None
    h, space = gear(flat), _SPACE[flat]
    point = np.append(0, np.cumsum((flat & 0xC0) != 0x80))
    fresh = ~space & np.append(True, space[:-1])
    fresh[(offsets[:-1] - low)[offsets[:-1] < offsets[-1]]] |= ~space[(offsets[:-1] - low)[offsets[:-1] < offsets[-1]]]
    begun = np.append(0, np.cumsum(fresh))
    digests, places, rids, met = [], [], [], set()
    for rid, a, b in zip(batch.column(0).to_pylist(), (offsets[:-1] - low).tolist(), (offsets[1:] - low).tolist()):
        if a == b or rid in met:  # a repeated row is the same document
            continue
        met.add(rid)
        spans = list(_spans(flat, h, a, b))
        digests.extend([xxhash.xxh3_64_intdigest(data[a + s:a + e]) for s, e in spans])
        at = np.array(spans) + a
        places.append(pack(point[at[:, 0]] - point[a], point[at[:, 1]] - point[at[:, 0]], begun[at[:, 1]] - begun[at[:, 0]]))
        rids.append(np.full(len(at), rid, np.int64))
    return np.array(digests, np.uint64).view(np.int64), np.concatenate(rids), np.concatenate(places)


def _known(digest: np.ndarray, told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mark of each chunk of a batch, and the digests told from now on."""
    values, first, back, count = np.unique(digest, return_index=True, return_inverse=True, return_counts=True)
    before = np.isin(values, told)
    mark = np.where((before | (count > 1))[back], _KNOWN, _ONCE).astype(np.int8)
    new = ~before & (count > 1)
    mark[first[new]] = _TELLS
    if len(told) > _REMEMBERED:  # forgotten ones are told again
        told = told[:0]
    return mark, np.concatenate([told, values[new]])


def _chunk(batches):
    told = np.empty(0, np.int64)
    for batch in batches:
        for part in by_bytes(batch, "text"):
            found = _places(part)
            if found is None:
                continue
            mark, told = _known(found[0], told)
            columns = [*found, mark]
            for p in range(0, len(mark), _BUFFER):
                yield pa.RecordBatch.from_arrays([pa.array(c[p:p + _BUFFER]) for c in columns], ["digest", "rid", "place", "known"])


def _shared(batches):
    """Places of digests that recur, each once, of a stream sorted by
    (digest, rid, place)."""
    wait, open_digest = None, None  # the row of a digest met once; a digest known to recur
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        digest, rid, place, known = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        if wait is not None:
            digest, rid, place, known = (np.concatenate(x) for x in zip(wait, (digest, rid, place, known)))
        at = np.flatnonzero(np.append(True, digest[1:] != digest[:-1]))
        stop = np.append(at[1:], len(digest))
        shared = (rid[at] != rid[stop - 1]) | (place[at] != place[stop - 1]) | (np.maximum.reduceat(known, at) > _ONCE)
        if digest[0] == open_digest:
            shared[0] = True
        open_digest = digest[-1] if shared[-1] else None
        wait = None if shared[-1] else tuple(x[-1:] for x in (digest, rid, place, known))
        fresh = np.append(last != (digest[0], rid[0], place[0]),
                          (digest[1:] != digest[:-1]) | (rid[1:] != rid[:-1]) | (place[1:] != place[:-1]))
        last = (digest[-1], rid[-1], place[-1]) if shared[-1] else None
        keep = np.repeat(shared, stop - at) & fresh
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (digest, rid, place)], ["digest", "rid", "place"])


def _runs(min_words: int, split: bool):
    """Runs of neighbouring chunks, or their parts, in a stream sorted by (rid, place)."""
    names = ["rid", "place", "own", "first", "doc_id"]

    def close(rows):
        rid, place, own, first, doc = rows
        start, length, words = place >> 16, place >> 8 & 0xFF, place & 0xFF
        again = np.append(False, (rid[1:] == rid[:-1]) & (place[1:] == place[:-1]))  # of a repeated row
        new = np.append(True, (rid[1:] != rid[:-1]) | ~again[1:] & (start[1:] != (start + length)[:-1]))
        at = np.flatnonzero(new | split & np.append(True, own[1:] != own[:-1]))  # a part stays or is a copy as a whole
        fresh = np.where(again, 0, words)
        total, count = np.add.reduceat(fresh, at), np.add.reduceat((~again).astype(np.int64), at)
        low, high = np.minimum.reduceat(first, at), np.maximum.reduceat(start + length, at)
        ok = np.add.reduceat(fresh, np.flatnonzero(new))[np.cumsum(new)[at] - 1] >= min_words  # of the whole run
        return pa.RecordBatch.from_arrays(
            [doc.take(pa.array(at[ok])), pa.array(start[at][ok].astype(np.int32)), pa.array(high[ok].astype(np.int32)),
             pa.array(total[ok].astype(np.int64)), pa.array(count[ok].astype(np.int64)), pa.array(np.logical_and.reduceat(own, at)[ok]),
             pa.array(low[ok])],
            ["doc_id", "start", "end", "words", "chunks", "kept", "first_doc"])

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)] + [b.column(4)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held[:4], cols[:4])] + [pa.concat_arrays([held[4], cols[4]])]
            other = np.flatnonzero(cols[0] != cols[0][-1])
            stop = int(other[-1]) + 1 if len(other) else 0
            if stop:
                yield close([c[:stop] for c in cols])
            held = [c[stop:] for c in cols]
        if held is not None:
            yield close(held)

    return names, run


def chunked(docs: DataFrame) -> DataFrame:
    """One row per chunk: digest, rid (hash of the row's id and text), place
    (start, length in code points and words begun, packed) and known, whether
    the task that read it met the digest again."""
    return docs.select(F.xxhash64("doc_id", "text").alias("rid"), "text").mapInArrow(_chunk, _PLACE + ", known byte")


def repeated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each repeated passage of a document: doc_id, start, end
    (code points), words, chunks, kept (all of it stays here; what
    stays of the others is told by ``parts``) and first_doc (the smallest id
    that holds part of it; null for documents without ids)."""
    return _repeated(docs, min_words, False)


def parts(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``repeated``, cut where chunks that stay meet copies: kept
    holds for the whole part, and every chunk is kept in one place;
    ``min_words`` is of the whole passage."""
    return _repeated(docs, min_words, True)


def _repeated(docs: DataFrame, min_words: int, split: bool) -> DataFrame:
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    own = F.xxhash64("text").bitwiseAND(F.lit(_NO_KEY - 1)).bitwiseOR(F.lit(_NO_KEY))
    rows = durable(docs.select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", F.coalesce("doc_id", own).alias("key")).distinct())
    home = F.when(F.col("known") == _KNOWN, F.xxhash64("rid", "place")).otherwise(F.col("digest"))
    shared = durable(chunked(docs).repartition(partitions(spark), home).sortWithinPartitions("digest", "rid", "place")
                     .mapInArrow(_shared, _PLACE))
    first = durable(shared.join(rows.select("rid", "key"), "rid").groupBy("digest")
                    .agg(F.min(F.struct("key", "rid", "place")).alias("at"))
                    .select("digest", F.col("at.key").alias("first"), F.col("at.rid").alias("first_rid"), F.col("at.place").alias("first_place")))
    names, run = _runs(min_words, split)
    own = (F.col("rid") == F.col("first_rid")) & (F.col("place") == F.col("first_place"))
    placed = (shared.join(first, "digest").select("rid", "place", own.alias("own"), "first").join(rows, "rid").select(*names)
              .repartition(partitions(spark), "rid").sortWithinPartitions("rid", "place"))
    out = placed.mapInArrow(run, "doc_id long, start int, end int, words long, chunks long, kept boolean, first_doc long")
    return out.withColumn("first_doc", F.when(F.col("first_doc") < _NO_KEY, F.col("first_doc")))


def query(spark, sf_dir: str) -> DataFrame:
    return parts(read(spark, sf_dir, "documents"))
