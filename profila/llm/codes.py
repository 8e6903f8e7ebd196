"""Operator 13 — vector code compression by active-entry Lloyd rounds.

Vectors become integers, floor(scale · x), and are cut into equal consecutive
parts.  The codebook of a part position holds a few entries; a part is stored as
the index of its nearest entry (squared Euclidean distance in integers, exact;
ties to the lower index).  Codebooks start as the parts of the first vectors by
id and move in Lloyd rounds: all parts are assigned, then each entry that has
parts becomes their componentwise floor(sum / count); the others stay.

*Active entries.*  From the second assignment on a part keeps the index and the
exact distance of its last one.  If its entry did not move, neither did that
distance, and every other entry that stayed lost to it before: the part is
compared with the moved entries only, and a moved entry of equal distance wins
where its index is lower.  A part whose entry moved scans the whole codebook.
The result is that of full scans.

Rows with codes and distances are a table in the shared folder after each
assignment.  Tasks add up their own parts by entry before the shuffle; what
reaches the driver, and goes to the tasks, is codebooks: entries × length
numbers, refused beyond ``MAX_CODEBOOK``.

Rows whose vector is null, empty, of a length that the parts do not divide, of
another length than the first vector's, or holds a null or non-finite component
are dropped.  Components are held within ±2^30 / √length, so that a row's error
is a long (of the integers floor(256 x), those of |x| up to 524,288 at length
64).  Fewer rows than entries give fewer entries; no rows give no result and no
codebooks.  Null ids come last in the order of ids, equal ids are ordered by
vector; repeated rows are coded each.  Other columns are ignored.  A sum of
errors beyond a long is null.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, prepare, read

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
MAX_CODEBOOK = 8_000_000
_EXACT = 1 << 53
_ROWS = 2048


@dataclass
class Coded:
    rows: DataFrame         # vec_id, label, code array<int>, error long, scanned int: parts that scanned all entries last
    codebooks: np.ndarray   # parts × entries × width, int64


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of int64 vectors: rows × entries."""
    top = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * int(top) ** 2 * x.shape[1] < _EXACT:  # every sum is a whole number that a double holds
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    return ((x[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)


def scan(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (lowest index of equals) and its distance."""
    d = squares(x, entries)
    code = d.argmin(axis=1)
    return code, d[np.arange(len(x)), code]


def rescan(x, entries, moved, code, distance) -> tuple[np.ndarray, np.ndarray]:
    """The same from the last assignment, comparing moved entries only where the
    assigned entry stayed."""
    code, distance = code.copy(), distance.copy()
    active = np.flatnonzero(moved)
    whole = moved[code]
    if whole.any():
        code[whole], distance[whole] = scan(x[whole], entries)
    stayed = np.flatnonzero(~whole)
    if len(active) and len(stayed):
        at, d = scan(x[stayed], entries[active])
        better = (d < distance[stayed]) | ((d == distance[stayed]) & (active[at] < code[stayed]))
        code[stayed[better]], distance[stayed[better]] = active[at[better]], d[better]
    return code, distance


def _matrix(column, width: int, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _list(x: np.ndarray, kind) -> pa.ListArray:
    offsets = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel(), kind))


def _assign(books: np.ndarray, moved: np.ndarray | None):
    """Batches (…, v[, code, distance]) → (…, v, code, distance, rescanned)."""
    parts, _, width = books.shape

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(start, _ROWS)
                v = _matrix(batch.column("v"), parts * width)
                code, distance = np.empty((len(v), parts), np.int64), np.empty((len(v), parts), np.int64)
                scanned = np.full(len(v), parts)
                if moved is not None:
                    code, distance = _matrix(batch.column("code"), parts), _matrix(batch.column("distance"), parts)
                    scanned = moved[np.arange(parts), code].sum(axis=1)
                for p in range(parts):
                    x = v[:, p * width:(p + 1) * width]
                    if moved is None:
                        code[:, p], distance[:, p] = scan(x, books[p])
                    else:
                        code[:, p], distance[:, p] = rescan(x, books[p], moved[p], code[:, p], distance[:, p])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), batch.column("v"),
                     _list(code, pa.int32()), _list(distance, pa.int64()), pa.array(scanned, pa.int32())],
                    ["vec_id", "label", "v", "code", "distance", "scanned"])
    return run


def _sums(parts: int, entries: int, width: int):
    """What a task's parts add up to, by part, entry and position."""
    def run(batches):
        total, count = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            v, code = _matrix(batch.column("v"), parts * width), _matrix(batch.column("code"), parts)
            for p in range(parts):
                np.add.at(total[p], code[:, p], v[:, p * width:(p + 1) * width])
                count[p] += np.bincount(code[:, p], minlength=entries)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry], pa.int64()),
             _list(total[part, entry].reshape(-1, width), pa.int64())], ["part", "entry", "n", "total"])
    return run


def moved_books(coded: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after an assignment: floor of the mean of each entry's parts."""
    parts, entries, width = books.shape
    task = coded.select("v", "code").mapInArrow(_sums(parts, entries, width), "part int, entry int, n long, total array<long>")
    long = task.select("part", "entry", "n", F.posexplode("total").alias("i", "x"))
    wide = "decimal(38,0)"
    sums = long.groupBy("part", "entry", "i").agg(F.sum(F.col("x").cast(wide)).alias("s"), F.sum("n").alias("n"))
    out = books.copy()
    for r in sums.collect():  # parts × entries × width rows at most
        out[r["part"], r["entry"], r["i"]] = int(r["s"]) // r["n"]
    return out


def integers(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): floor(scale · x) of the vectors that may take part."""
    e = F.col("embedding").cast("array<double>")
    bad = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    bound = F.lit(float(1 << 30)) / F.sqrt(F.size("e").cast("double"))
    v = F.transform("e", lambda x: F.floor(F.greatest(F.least(x * float(scale), bound), -bound)))
    return (vectors.select("vec_id", "label", e.alias("e"))
            .where(F.col("e").isNotNull() & (F.size("e") > 0) & (F.size("e") % parts == 0))
            .where(~bad).select("vec_id", "label", v.alias("v")))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Coded:
    """Codes and errors of all vectors, and the codebooks."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = integers(vectors, parts, scale)
    first = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v")
    length = (first.select(F.size("v")).first() or [0])[0]
    rows = rows.where(F.size("v") == length)
    if length * entries > MAX_CODEBOOK:
        raise ValueError(f"{entries} entries of {length} numbers are not sent to every task")
    start = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r["v"] for r in start], np.int64).reshape(len(start), parts, length // parts).transpose(1, 0, 2).copy()
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}, " \
             "v array<long>, code array<int>, distance array<long>, scanned int"
    if not start:
        coded = spark.createDataFrame([], schema)
        return Coded(coded.select("vec_id", "label", "code", F.lit(0).cast("long").alias("error"), "scanned"), books)
    moved, coded = None, rows
    for _ in range(rounds):
        coded = durable(coded.mapInArrow(_assign(books, moved), schema))
        after = moved_books(coded, books)
        moved, books = (after != books).any(axis=2), after
    final = durable(coded.mapInArrow(_assign(books, moved), schema).select("vec_id", "label", "code", F.aggregate(
        "distance", F.lit(0).cast("long"), lambda a, x: a + x).alias("error"), "scanned"))
    return Coded(final, books)


def codebook_digest(books: np.ndarray) -> str:
    """sha256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: codes of all embeddings, errors by row and label, the codebooks' digest."""
    found = compress(read(spark, sf_dir, "embeddings"))
    by_label = durable(found.rows.groupBy(F.col("label").alias("l")).agg(F.try_sum("error").alias("label_error")))
    code = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return (found.rows.join(by_label, F.col("label").eqNullSafe(F.col("l")))
            .select("vec_id", code.alias("code"), "error", "label_error",
                    F.lit(codebook_digest(found.codebooks)).alias("codebooks_sha256")))


def oracle_sql() -> str:
    """All assignments by full scans."""
    nearest = """
  select p.r, p.part, first(c.k order by d, c.k) as k, min(d) as d from p join {c} c using (part),
    lateral (select list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d)
  group by p.r, p.part"""
    mean = """
  select c.part, c.k, coalesce(m.x, c.x) as x from {c} c left join (
    select part, k, list((s - ((s % n) + n) % n) // n order by i) as x from (
      select part, k, i, sum(v) as s, count(*) as n from (
        select a.part, a.k, unnest(p.x) as v, unnest(range(len(p.x))) as i from {a} a join p using (r, part))
      group by part, k, i) group by part, k) m using (part, k)"""
    steps = []
    for i in range(ROUNDS):
        steps.append(f"a{i} as ({nearest.format(c=f'c{i}')}\n)")
        steps.append(f"c{i + 1} as ({mean.format(c=f'c{i}', a=f'a{i}')}\n)")
    return f"""
with e as (
  select row_number() over (order by vec_id, embedding) as r, vec_id, label,
    list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), p as (
  select r, part, v[part * (len(v) // {PARTS}) + 1:(part + 1) * (len(v) // {PARTS})] as x from e, unnest(range({PARTS})) t(part)
), c0 as (
  select part, r - 1 as k, x from p where r <= {ENTRIES}
), {', '.join(steps)}, f as ({nearest.format(c=f'c{ROUNDS}')}
), g as (
  select r, string_agg(lower(printf('%02x', k)), '' order by part) as code, sum(d)::bigint as error from f group by r
)
select e.vec_id, g.code, g.error, (sum(g.error) over (partition by e.label))::bigint as label_error,
  (select sha256(string_agg(array_to_string(x, ','), ',' order by part, k)) from c{ROUNDS}) as codebooks_sha256
from e join g using (r)"""
