"""Operator 10 — SimHash near-duplicates with pivot distance tables.

Fingerprint: 64-bit SimHash of the word shingles' XXH64.  Fingerprints that
differ in at most ``max_bits`` bits are linked; a class is a connected
component.

1. Each text gives its fingerprint where it is read (no text is shuffled);
   everything after works on distinct fingerprints.
2. A *pivot table* holds, for each distinct fingerprint, its Hamming distances
   to 24 fixed reference fingerprints, computed once.
3. Candidates meet in cells.  The 64 bits are cut into ``max_bits + 2``
   blocks; at most ``max_bits`` of them can differ, so two linked fingerprints
   agree in some pair of blocks: one cell for each pair of blocks.  (More
   blocks and larger agreeing sets, ``same``, suit much larger corpora.)
4. In a cell two fingerprints whose distances to any reference differ by more
   than ``max_bits`` cannot be linked (triangle inequality), so the largest
   coordinate difference of the pivot table discards them; the surviving pairs
   are verified bit by bit.
5. A cell of many fingerprints is cut into slots and every pair of slots is a
   tile of its own, so no task holds a whole hot cell; a tile hands on a
   spanning forest of its links, never all pairs.
6. ``components`` joins the tiles' forests.

Empty and null texts have fingerprint 0 and link like any other.  Documents
are not keyed by ``doc_id``: repeated rows are copies of each other; null ids
get the class of their text; a class whose ids are all null has a null id.
Other columns of the input are ignored.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import durable, fresh, partitions, prepare, read
from .components import components, forest

SHINGLE = 4
MAX_BITS = 4
N_PIVOTS = 24
TILE = 2048
_BUFFER = 1 << 17
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPOT = (np.arange(8, dtype=np.int64) * 256)[None, :]
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def simhash(text: bytes | None, shingle: int = SHINGLE, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint of one whole text (UTF-8)."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n], ends[min(shingle, len(words)) - 1:])
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    while part := b"".join([digest(flat[s:e - 1], seed) for s, e in _take(spans, 1 << 16)]):
        at = np.frombuffer(part, np.uint8).reshape(-1, 8) + _SPOT
        seen = np.bincount(at.ravel(), minlength=2048).reshape(8, 256)
        ones += (seen @ _BITS).ravel()
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _take(items, n):
    for _, item in zip(range(n), items):
        yield item


def fingerprint(shingle: int = SHINGLE):
    """Arrow function: text column → fingerprint as a (signed) long."""
    @arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([simhash(t, shingle) for t in texts.cast(pa.binary()).to_pylist()], np.uint64).view(np.int64))
    return fp


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """The reference fingerprints."""
    return np.array([xxhash.xxh64_intdigest(f"pivot {i}".encode(), 42) for i in range(n)], np.uint64)


def pivot_table(fps: DataFrame) -> DataFrame:
    """fp → fp, p0, p1, p2: the distances to 24 references, a byte each."""
    def distances(batches):
        refs = pivots()
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            far = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.uint8)
            p = np.ascontiguousarray(far).view(np.int64).reshape(len(fp), -1)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(np.ascontiguousarray(p[:, i])) for i in range(3))],
                                             ["fp", "p0", "p1", "p2"])
    return fps.mapInArrow(distances, "fp long, p0 long, p1 long, p2 long")


def cells(max_bits: int = MAX_BITS, blocks: int | None = None) -> list[int]:
    """Bit masks such that two fingerprints within ``max_bits`` agree under one."""
    blocks = blocks or max_bits + 2
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(masks, blocks - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _linked(fp, near, tile, max_bits):
    """Links inside runs of equal ``tile``, as a spanning forest."""
    at, step = np.arange(len(fp) - 1), 1
    held, pending = [(np.empty(0, np.int64),) * 2], 0
    while len(at):
        at = at[at + step < len(fp)]
        at = at[tile[at] == tile[at + step]]
        i, j = at, at + step
        for k in range(0, N_PIVOTS, 8):
            gap = np.abs(near[i, k:k + 8] - near[j, k:k + 8]).max(axis=1, initial=0)
            i, j = i[gap <= max_bits], j[gap <= max_bits]
        ok = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
        held.append((fp[i[ok]].view(np.int64), fp[j[ok]].view(np.int64)))
        pending += len(held[-1][0])
        if pending > _BUFFER:
            held, pending = [forest(*(np.concatenate(x) for x in zip(*held)))], 0
        step += 1
    return forest(*(np.concatenate(x) for x in zip(*held)))


def links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints (column fp) → (u, v): links that connect exactly
    the fingerprints within ``max_bits`` bits of each other."""
    spark = fps.sparkSession
    masks = cells(max_bits, blocks)
    cell = F.explode(F.array(*(F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")))
                               for k, m in enumerate(masks))))
    table = durable(pivot_table(fps))
    hot = durable(table.select(cell.alias("cell")).groupBy("cell").count().where(F.col("count") > tile))
    dealt = (table.withColumn("cell", cell).join(hot, "cell", "left")
             .withColumn("slots", F.coalesce(F.ceil(F.col("count") / tile), F.lit(1)).cast("int"))
             .withColumn("slot", F.pmod(F.xxhash64("fp", F.lit("slot")), F.col("slots")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
             .select("fp", "p0", "p1", "p2",
                     F.xxhash64("cell", F.least("slot", "other"), F.greatest("slot", "other")).alias("tile")))
    dealt = dealt.repartition(partitions(spark), "tile").sortWithinPartitions("tile")

    def verify(batches):
        held, names = None, ["u", "v"]
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            if len(held[0]) >= _BUFFER and held[4][0] != held[4][-1]:
                cut = int(np.flatnonzero(held[4] != held[4][-1])[-1]) + 1
                u, v = solve([x[:cut] for x in held])
                held = [x[cut:] for x in held]
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names)
        if held is not None:
            u, v = solve(held)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names)

    def solve(cols):
        near = np.stack(cols[1:4], axis=1).view(np.uint8).astype(np.int16)
        return _linked(cols[0].view(np.uint64), near, cols[4], max_bits)

    return dealt.mapInArrow(verify, "u long, v long")


def classes(ids: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None) -> DataFrame:
    """(doc_id, fp) of all documents → (fp, root, component_id): one row per
    distinct fingerprint; component_id is the smallest doc_id of its class."""
    each = durable(ids.groupBy("fp").agg(F.min("doc_id").alias("own")))
    found = components(links(each.select("fp"), max_bits, blocks))
    lone = each.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left") \
        .select("fp", "own", F.coalesce("root", "fp").alias("root"))
    lone = durable(lone)
    least = durable(lone.groupBy("root").agg(F.min("own").alias("component_id")))
    return durable(lone.join(least, "root").select("fp", "root", "component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, blocks: int | None = None) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prepare(docs.sparkSession)
    ids = durable(docs.select(F.col(id_col).alias("doc_id"), fingerprint(shingle)(F.col(text_col)).alias("fp")))
    return (ids.join(classes(ids, max_bits, blocks), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS, blocks: int | None = None) -> DataFrame:
    """The documents with one of each class: that of the smallest id (null
    ids last, then by the text's hash).  Columns stay as they are; of rows
    that agree in id and text, the smallest by all columns stays."""
    prepare(docs.sparkSession)
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    ids = durable(docs.select(F.col(id_col).alias("doc_id"), mark.alias("mark"),
                              fingerprint(shingle)(F.col(text_col)).alias("fp")))
    of = classes(ids, max_bits, blocks).select("fp", "root")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    first = (ids.groupBy("fp", key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
             .join(of, "fp").groupBy("root").agg(F.min(F.struct("key", "n")).alias("best")))
    stay = durable(first.select("best.key.doc_id", "best.key.mark", "best.n"))
    cols = docs.columns
    i, m, n = fresh(cols, "keep_id", "keep_mark", "keep_rows")
    stay = stay.toDF(i, m, n)
    on = F.col(id_col).eqNullSafe(F.col(i)) & (mark == F.col(m))
    once = docs.join(stay.where(F.col(n) == 1).hint("shuffle_hash"), on, "left_semi")
    again = stay.where(F.col(n) > 1)
    if again.isEmpty():
        return once
    few = (docs.join(again, on).groupBy(i, m).agg(F.min(F.struct(*(F.col(f"`{c}`") for c in cols))).alias("row"))
           .select(*(F.col("row").getField(c).alias(c) for c in cols)))
    return once.unionByName(few)


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
