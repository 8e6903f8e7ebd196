"""Operator 6 — nearest neighbours by a block matrix join of int8 tiles.

The stated queries (vec_id divisible by ``every``) and all candidates are dealt
into blocks by hash; every pair of a query block and a candidate block is one
tile, a task's unit of bounded size.  In a tile

1. vectors are quantised to int8 with a scale of their own, x ≈ s·q, and the
   error ‖x − s·q‖ is kept;
2. the int8 product of the two blocks gives all approximate distances, and the
   triangle inequality bounds the true ones: |d − d̂| ≤ err(x) + err(y);
3. a candidate whose lower bound exceeds the k-th smallest upper bound of its
   query cannot be among the tile's k nearest; the others are recomputed from
   the original vectors in double precision.

The tiles' k nearest are merged by heaps of size k, first where they were made
and then by query.  No pair is lost, so the result equals brute force.

Vectors that are null, empty, zero, or hold a null or non-finite component,
and rows without an id, take no part.  Rows that agree in id and vector count
once; of several vectors with a query's id the smallest asks, and none of them
is a candidate for it.  Vectors of different length are never compared.  Equal
distances go to the smaller vec_id.  Other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, partitions, prepare, read

K = 10
EVERY = 100
QUERY_BLOCK = 1024
BLOCK = 4096
_PAIRS = 1 << 16
_OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dim) of the vectors that take part, each once."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .where(~bad & F.exists("v", lambda x: x != 0)).distinct().withColumn("dim", F.size("v")))


def quantise(x: np.ndarray):
    """int8 codes, scales and errors of the rows."""
    scale = np.maximum(np.abs(x).max(axis=1) / 127, 1e-300)
    q = np.rint(x / scale[:, None])
    err = np.sqrt(((x - q * scale[:, None]) ** 2).sum(axis=1))
    return q.astype(np.int8), scale, err


def bounds(a, b):
    """Lower and upper bounds of the distances between two quantised blocks."""
    (qa, sa, ea), (qb, sb, eb) = a, b
    exact = np.float32 if qa.shape[1] <= 1000 else np.float64  # sums of products stay below 2^24
    product = (qa.astype(exact) @ qb.astype(exact).T).astype(np.float64)
    na = sa ** 2 * (qa.astype(np.float64) ** 2).sum(axis=1)
    nb = sb ** 2 * (qb.astype(np.float64) ** 2).sum(axis=1)
    square = na[:, None] + nb[None, :] - 2 * sa[:, None] * sb[None, :] * product
    slack = 1e-12 * (na[:, None] + nb[None, :])  # rounding of the line above
    far = np.sqrt(np.maximum(square - slack, 0)) - ea[:, None] - eb[None, :]
    near = np.sqrt(np.maximum(square, 0) + slack) + ea[:, None] + eb[None, :]
    return far * (1 - 1e-12), near * (1 + 1e-12)


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.cumsum((x - y) ** 2, axis=1)[:, -1])


def tile(query_ids, queries, ids, vectors, k: int = K, rows: int = 128):
    """(query_id, vec_id, score) of the k nearest of a tile, for each query."""
    right, out = quantise(vectors), []
    for a in range(0, len(queries), rows):
        x, own = queries[a:a + rows], query_ids[a:a + rows]
        low, high = bounds(quantise(x), right)
        same = own[:, None] == ids[None, :]
        low[same] = high[same] = np.inf
        cut = np.partition(high, k - 1, axis=1)[:, k - 1] if high.shape[1] > k else np.full(len(x), np.inf)
        i, j = np.nonzero((low <= cut[:, None]) & (low < np.inf))
        score = np.concatenate([distance(x[i[p:p + _PAIRS]], vectors[j[p:p + _PAIRS]])
                                for p in range(0, len(i), _PAIRS)] or [np.empty(0)])
        order = np.lexsort((ids[j], score, i))
        i, j, score = i[order], j[order], score[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        top = place < k
        out.append((own[i[top]], ids[j[top]], score[top]))
    return [np.concatenate(x) for x in zip(*out)]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _tiles(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _OUT.empty_table()
        dim = left.column("dim")[0].as_py()
        found = tile(left.column("vec_id").to_numpy(), _matrix(left.column("v"), dim),
                     right.column("vec_id").to_numpy(), _matrix(right.column("v"), dim), k)
        return pa.table([pa.array(x) for x in found], schema=_OUT)
    return run


def _heaps(k: int):
    """The k nearest of each query in a partition, by heaps of size k."""
    def run(batches):
        best: dict[int, list] = {}
        for b in batches:
            for q, v, s in zip(*(c.to_pylist() for c in b.columns)):
                heap, item = best.setdefault(q, []), (-s, -v)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
        rows = [(q, -v, -s) for q, heap in best.items() for s, v in heap]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(_OUT.types)], schema=_OUT)
    return run


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, query_block: int = QUERY_BLOCK, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each query."""
    spark = vectors.sparkSession
    prepare(spark)
    all_rows = durable(usable(vectors))
    asking = durable(all_rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
                     .withColumn("dim", F.size("v")))
    n_left, n_right = max(1, -(-asking.count() // query_block)), max(1, -(-all_rows.count() // block))
    deal = F.xxhash64("vec_id", "v")
    left = (asking.withColumn("l", F.pmod(deal, F.lit(n_left)))
            .withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_right - 1).cast("long")))))
    right = (all_rows.withColumn("r", F.pmod(deal, F.lit(n_right)))
             .withColumn("l", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_left - 1).cast("long")))))
    found = (left.groupBy("dim", "l", "r").cogroup(right.groupBy("dim", "l", "r"))
             .applyInArrow(_tiles(k), "query_id long, vec_id long, score double"))
    merged = (found.mapInArrow(_heaps(k), "query_id long, vec_id long, score double")
              .repartition(partitions(spark), "query_id").mapInArrow(_heaps(k), "query_id long, vec_id long, score double"))
    ranked = merged.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("top"))  # k each
    return (ranked.select("query_id", F.posexplode("top").alias("at", "x"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"))


def query(spark, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"))


def oracle_sql() -> str:
    return f"""
with e as (
  select distinct vec_id, embedding::double[] as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x != 0)) > 0
), q as (
  select vec_id, min(v) as v from e where vec_id % {EVERY} = 0 group by vec_id
), p as (
  select q.vec_id as query_id, e.vec_id, sqrt(list_sum(list_transform(list_zip(q.v, e.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) as score
  from q join e on e.vec_id != q.vec_id and len(e.v) = len(q.v)
), r as (
  select *, row_number() over (partition by query_id order by score, vec_id) as rank from p
)
select query_id, rank::int as rank, vec_id, score from r where rank <= {K}"""
