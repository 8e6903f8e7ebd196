"""Operator 4 — fuzzy line dedup by MinHash.

Lines (text between line feeds) are near copies if the Jaccard similarity of
their sets of 7-character shingles is at least 0.8; a line shorter than that is
its own shingle.  Of each connected component of near copies, equal lines
included, the first line stays, by document id and line number.

1. Each text is cut into lines where it is read; each line gets a digest and a
   MinHash signature of 40 values, banded by 4: lines of similarity 0.8 share
   one of the 10 bands with probability 0.995, more similar ones nearly always.
   A reading task signs a line once a batch and remembers those that recur, so
   a line of a third of all documents is signed, dealt by band and sent with
   its text about once a task, not once a document.
2. Bands that hold two different lines are found with partial minima and
   maxima, so a line in a third of all documents weighs nothing.  Their lines
   are candidates; bands with the same lines count once.
3. A band of many lines is cut into slots, and every pair of slots is a tile of
   bounded size.  In a tile pairs that are not yet connected are verified by
   their exact Jaccard similarity, and a spanning forest is handed on.
4. ``components`` joins the forests; each line learns whether it is the first
   of its component.

Lines of white space only are layout: they are no candidates and always stay.
Null and empty texts have no line.  Rows with equal id and text are one
document, whose lines stay or go in all of them; a null id stands after all
others, by its text.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, durable, partitions, prepare, read
from .components import components, forest

SHINGLE = 7
SIMILARITY = 0.8
BANDS, ROWS = 10, 4
TILE = 512
_NO_KEY = 1 << 62
_WIDTH = 4096
_BLOCK = 1 << 15
_rng = np.random.default_rng(4)
_MULTIPLY = _rng.integers(0, 1 << 31, SHINGLE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_A = _rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_KEYS = [f"k{i}" for i in range(BANDS)]
#: recurring lines that a reading task remembers; forgotten ones are signed again
_REMEMBERED = 1 << 13


def shingles(line: str) -> set[str]:
    return {line[i:i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def signatures(lines: list[str]) -> np.ndarray:
    """MinHash signatures (one row each) of non-empty lines."""
    sizes = np.array([len(x) for x in lines])
    code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    h = np.zeros(len(code), np.uint32)
    for j, m in enumerate(_MULTIPLY):
        h[:len(code) - j] += code[j:] * m
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    start = np.cumsum(sizes) - sizes
    count = np.maximum(sizes - SHINGLE + 1, 1)
    for i in np.flatnonzero(sizes < SHINGLE):
        h[start[i]] = xxhash.xxh32_intdigest(lines[i].encode("utf-8", "surrogatepass"), 4)
    first = np.cumsum(count) - count
    h = h[np.arange(int(count.sum())) + np.repeat(start - first, count)]
    out = np.empty((BANDS * ROWS, len(lines)), np.uint32)
    low, ends = 0, np.append(first[1:], len(h))
    while low < len(lines):  # as many lines at once as a core's cache holds
        high = max(low + 1, int(np.searchsorted(ends, first[low] + _BLOCK, side="right")))
        part, at = h[first[low]:ends[high - 1]], first[low:high] - first[low]
        room = np.empty_like(part)
        for k in range(BANDS * ROWS):
            np.multiply(part, _A[k], out=room)
            room += _B[k]
            np.minimum.reduceat(room, at, out=out[k, low:high])
        low = high
    return out.T


def bands(signature: np.ndarray) -> np.ndarray:
    """One key for each band of each signature."""
    out = np.empty((len(signature), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(signature), b + 1, np.uint64)
        for k in range(b * ROWS, (b + 1) * ROWS):
            key = (key ^ signature[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        out[:, b] = key
    return out.view(np.int64)


def _lines(text) -> list[tuple[int, str]]:
    """(number, line) of the lines with a visible character."""
    return [(n, x) for n, x in enumerate((text or "").split("\n")) if x and not x.isspace()]


def _digests(lines: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x, 42) for x in lines], np.uint64).view(np.int64)


def first_met(digests: np.ndarray, told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lines of a batch that were not met before, and the
    recurring lines told from now on."""
    values, first, count = np.unique(digests, return_index=True, return_counts=True)
    new = ~np.isin(values, told)
    if len(told) > _REMEMBERED:
        told = told[:0]
    return np.sort(first[new]), np.concatenate([told, values[new & (count > 1)]])


def _cut(batches):
    told = np.empty(0, np.int64)
    for batch in (part for whole in batches for part in by_bytes(whole, "text")):
        ids, marks, numbers, texts = [], [], [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = _lines(text)
            ids.extend([i] * len(found))
            marks.extend([xxhash.xxh64_intdigest(text or "", 42) - (1 << 63)] * len(found))
            numbers.extend([n for n, _ in found])
            texts.extend([x for _, x in found])
        digests = _digests(texts)
        fresh, told = first_met(digests, told)
        keys, known = np.zeros((len(texts), BANDS), np.int64), np.ones(len(texts), bool)
        known[fresh] = False
        if len(fresh):
            keys[fresh] = bands(signatures([texts[k] for k in fresh.tolist()]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(numbers, pa.int32()), pa.array(digests),
             *(pa.array(np.ascontiguousarray(keys[:, b]), mask=known) for b in range(BANDS))],
            ["doc_id", "mark", "n", "line", *_KEYS])


def _texts(batches):
    told = np.empty(0, np.int64)
    for batch in (part for whole in batches for part in by_bytes(whole, "text")):
        texts = [x for text in batch.column("text").to_pylist() for _, x in _lines(text)]
        digests = _digests(texts)
        fresh, told = first_met(digests, told)
        yield pa.RecordBatch.from_arrays([pa.array(digests[fresh]), pa.array([texts[k] for k in fresh.tolist()], pa.string())], ["line", "text"])


def cut(docs: DataFrame) -> DataFrame:
    """One row per line with a visible character: doc_id, mark (the text's
    hash), n (line number from 0), line (digest) and its band keys, which are
    null where the task that cut the line has met it before."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _cut, "doc_id long, mark long, n int, line long, " + ", ".join(f"{k} long" for k in _KEYS))


def overlaps(sets: list[set]) -> np.ndarray:
    """Sizes of the intersections of all pairs of a tile's sets: products of
    0/1 matrices over the shingles that at least two sets have."""
    seen: dict[str, int] = {}
    for x in sets:
        for g in x:
            seen[g] = seen.get(g, 0) + 1
    number = {g: i for i, g in enumerate(g for g, n in seen.items() if n > 1)}
    at = [np.fromiter((number[g] for g in x if g in number), np.int64) for x in sets]
    row, column = np.repeat(np.arange(len(sets)), [len(x) for x in at]), np.concatenate(at)
    both = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, len(number), _WIDTH):
        part = (column >= low) & (column < low + _WIDTH)
        has = np.zeros((len(sets), min(_WIDTH, len(number) - low)), np.float32)
        has[row[part], column[part] - low] = 1
        both += has @ has.T
    return both


def near_copies(texts: list[str], similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i > j, of near copies among the texts of a tile."""
    sets = [shingles(t) for t in texts]
    if len(sets) < 12:
        found = [(i, j) for i in range(len(sets)) for j in range(i)
                 if min(len(sets[i]), len(sets[j])) >= similarity * max(len(sets[i]), len(sets[j]))
                 and jaccard(sets[i], sets[j]) >= similarity]
        return tuple(np.array([x[k] for x in found], np.int64) for k in (0, 1))
    both, size = overlaps(sets).astype(np.float64), np.array([len(x) for x in sets])
    return np.nonzero(np.tril(both / (size[:, None] + size[None, :] - both) >= similarity, -1))


def _verify(similarity: float):
    """Forest of the near copies of each tile, in a stream sorted by tile."""
    def solve(lines, texts):
        kept = dict(zip(lines, texts))
        names = np.array(list(kept), np.int64)
        i, j = near_copies(list(kept.values()), similarity)
        if len(i):
            yield from zip(*(x.tolist() for x in forest(names[i], names[j])))

    def run(batches):
        held, lines, texts = None, [], []
        for b in batches:
            out = []
            for tile, line, text in zip(*(c.to_pylist() for c in b.columns)):
                if tile != held:
                    out.extend(solve(lines, texts))
                    held, lines, texts = tile, [], []
                lines.append(line)
                texts.append(text)
            yield _links(out)
        yield _links(list(solve(lines, texts)))
    return run


def _links(out):
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["u", "v"])


def links(docs: DataFrame, table: DataFrame, similarity: float = SIMILARITY, tile: int = TILE) -> DataFrame:
    """(u, v) digests of near copies, as forests of the tiles."""
    spark = docs.sparkSession
    rows = table.where(F.col(_KEYS[0]).isNotNull()).select(F.explode(F.array(*_KEYS)).alias("key"), "line")
    shared = durable(rows.groupBy("key").agg(F.min("line").alias("a"), F.max("line").alias("b")).where("a < b").select("key"))
    members = durable(rows.join(shared.hint("shuffle_hash"), "key").distinct())
    sets = members.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("line")).alias("x"),
                                      F.bit_xor(F.xxhash64("line", F.lit(1))).alias("y"))
    once = durable(sets.groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key", "m"))
    members = members.join(once, "key")
    wanted = durable(members.select("line").distinct())
    texts = (docs.select("text").mapInArrow(_texts, "line long, text string")
             .join(wanted.hint("shuffle_hash"), "line").groupBy("line").agg(F.min("text").alias("text")))
    texts = durable(texts)
    dealt = (members.withColumn("slots", F.ceil(F.col("m") / tile).cast("int"))
             .withColumn("slot", F.pmod(F.xxhash64("line", F.lit("slot")), F.col("slots")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
             .select("line", F.xxhash64("key", F.least("slot", "other"), F.greatest("slot", "other")).alias("tile")))
    tiles = (dealt.join(texts, "line").select("tile", "line", "text")
             .repartition(partitions(spark), "tile").sortWithinPartitions("tile"))
    return tiles.mapInArrow(_verify(similarity), "u long, v long")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per line with a visible character: doc_id, mark, line_no,
    line_class (smallest digest of its component) and kept."""
    prepare(docs.sparkSession)
    table = durable(cut(docs))
    found = components(links(docs, table, similarity))
    key = F.coalesce("doc_id", F.col("mark").bitwiseAND(F.lit(_NO_KEY - 1)).bitwiseOR(F.lit(_NO_KEY)))
    placed = durable(table.select("doc_id", "mark", "n", "line", key.alias("key"))
                     .join(found.select(F.col("node").alias("line"), "root"), "line", "left")
                     .select("doc_id", "mark", "n", "key", F.coalesce("root", "line").alias("line_class")))
    first = durable(placed.groupBy("line_class").agg(F.min(F.struct("key", "mark", "n")).alias("first")))
    return (placed.join(first, "line_class")
            .select("doc_id", "mark", F.col("n").alias("line_no"), "line_class",
                    (F.struct("key", "mark", "n") == F.col("first")).alias("kept")))


def deduplicate(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text) with the lines that go left out."""
    gone = (classes(docs, similarity).where("not kept").groupBy("doc_id", "mark")
            .agg(F.collect_set("line_no").alias("gone")))  # at most a text's own lines
    gone = durable(gone.select(F.col("doc_id").alias("i"), F.col("mark").alias("m"), "gone"))
    docs = docs.select("doc_id", "text")
    mark = F.expr("xxhash64(coalesce(text, ''))").bitwiseXOR(F.lit(-(1 << 63)))  # unsigned minus 2^63
    kept = "array_join(transform(filter(transform(split(text, '\\n'), (x, i) -> struct(x, i)), s -> not array_contains(gone, s.i)), s -> s.x), '\\n')"
    return (docs.join(gone, F.col("doc_id").eqNullSafe(F.col("i")) & (mark == F.col("m")), "left")
            .select("doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.expr(kept)).alias("text")))


def query(spark, sf_dir: str) -> DataFrame:
    return classes(read(spark, sf_dir, "documents")).select("doc_id", "line_no", "line_class", "kept")
