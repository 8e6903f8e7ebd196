"""Sparse rows inside a task, and sums of vectors over tasks.

ML vectors reach Python as Arrow structs; ``csr`` reads them without a loop.
``vector_sum`` is how every iterative learner here gathers what it needs of a
pass: a task adds up its own rows into one vector, the vector's blocks are
added on the executors in the order of the parts, and the sum (its length is
bounded by the model, not by the rows) reaches the driver.

What the driver holds of a wide model between passes lies in mapped files
(``numbers``), comes in as small blocks, long sums partition by partition, and goes
out row by row (``by_rows``); learners whose vectors do not fit together take turns (``turn``).
"""

from __future__ import annotations

import math
import mmap
import tempfile
import threading
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..session import give_back

ROWS_PER_TASK = 25_000
BLOCK = 16_384             # 128 KB: no large object to the JVM's collector
PER_ADDER = 65_536
MAX_NUMBERS = 16_000_000   # 128 MB
MAPPED = 1 << 19           # numbers beyond which an array of the driver lies in a file
COLLECTED, FETCHED = 1 << 20, 1 << 20   # numbers of a sum that comes at once; of a partition of a longer one
DRIVER_NUMBERS = 16_000_000   # of all learners that fit side by side
_CHUNK = 1 << 21           # numbers in one intermediate product


class _Turns:
    """Room for so many numbers; who asks for more than all of it has it alone."""

    def __init__(self, room: int):
        self.room, self.free, self.changed = room, room, threading.Condition()

    @contextmanager
    def take(self, size: int):
        size = min(size, self.room)
        with self.changed:
            self.changed.wait_for(lambda: self.free >= size)
            self.free -= size
        try:
            yield
        finally:
            with self.changed:
                self.free += size
                self.changed.notify_all()


_turns = _Turns(DRIVER_NUMBERS)


def turn(size: int):
    """Hold room for ``size`` numbers on the driver while a learner fits; waits
    for others to end where there is none.  Narrow models all fit side by side."""
    return _turns.take(size)


def numbers(*shape: int) -> np.ndarray:
    """Zeros.  A long array lies in a file without a name, gone with the array."""
    size = math.prod(shape)
    if size <= MAPPED:
        return np.zeros(shape)
    with tempfile.TemporaryFile(prefix="profila-") as file:
        file.truncate(8 * size)
        return np.ndarray(shape, np.float64, buffer=mmap.mmap(file.fileno(), 8 * size))


def _joined(shape, *rows) -> np.ndarray:
    out = np.empty(shape)
    for own, row in zip(out, rows):
        own[:] = row
    return out


class by_rows:
    """A matrix to broadcast: written row by row, without a copy of the whole;
    what arrives is the matrix."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix

    def __reduce__(self):
        return _joined, (self.matrix.shape, *self.matrix)


def csr(column: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indptr, indices, values) of a column of ML vectors; null: no cells."""
    values = pc.struct_field(column, "values")
    sizes = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    indptr = np.concatenate([[0], np.cumsum(sizes)])
    flat = values.flatten().to_numpy(zero_copy_only=False)
    own = pc.struct_field(column, "indices")
    indices = np.arange(indptr[-1]) - np.repeat(indptr[:-1], sizes)  # dense vectors
    given = pc.fill_null(pc.list_value_length(own), -1).to_numpy(zero_copy_only=False)
    sparse = np.repeat(given == sizes, sizes)
    if sparse.any():
        indices[sparse] = own.flatten().to_numpy(zero_copy_only=False)
    return indptr, indices, flat


def times(x, w: np.ndarray) -> np.ndarray:
    """X · W for a width × k matrix W."""
    indptr, indices, values = x
    out = np.zeros((len(indptr) - 1, w.shape[1]))
    rows = np.flatnonzero(np.diff(indptr))
    step = max(1, _CHUNK // max(1, w.shape[1]))
    start = 0
    while start < len(rows):
        first = indptr[rows[start]]
        stop = max(start + 1, int(np.searchsorted(indptr[rows + 1], first + step, side="right")))
        own = rows[start:stop]
        last = indptr[own[-1] + 1]
        product = values[first:last, None] * w[indices[first:last]]
        out[own] = np.add.reduceat(product, indptr[own] - first, axis=0)
        start = stop
    return out


def transposed(x, r: np.ndarray, width: int) -> np.ndarray:
    """Xᵀ · R for an n × k matrix R."""
    indptr, indices, values = x
    rows = np.repeat(np.arange(len(indptr) - 1), np.diff(indptr))
    return np.stack([np.bincount(indices, values * r[rows, c], minlength=width) for c in range(r.shape[1])], axis=1)


def dense(x, start: int, stop: int, width: int) -> np.ndarray:
    """Rows start … stop − 1 as a dense matrix."""
    indptr, indices, values = x
    a, b = indptr[start], indptr[stop]
    out = np.zeros((stop - start, width))
    rows = np.repeat(np.arange(stop - start), np.diff(indptr[start:stop + 1]))
    out[rows, indices[a:b]] = values[a:b]
    return out


def gathered(rows: DataFrame, per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, int]:
    """The rows kept in memory or on disk for many passes, and their number of
    tasks: as many as the table has, but no more than one for each ``per_task``
    rows, so that a pass over a small table costs one task."""
    tasks = max(1, -(-rows.count() // per_task))
    now = rows.rdd.getNumPartitions()
    rows = rows.coalesce(tasks) if tasks < now else rows
    return rows.persist(StorageLevel.MEMORY_AND_DISK), min(tasks, now)


def _packed(block: int, v: np.ndarray, part: int = 0) -> pa.RecordBatch:
    """A block of a vector; of a sparse one its places and what is there."""
    at = np.flatnonzero(v)
    at, v = (at.astype(np.uint16), v[at]) if 2 * len(at) < len(v) else (at[:0], v)
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([part], pa.int32()), pa.array([at.tobytes()], pa.binary()),
         pa.array([v.tobytes()], pa.binary())], ["block", "part", "at", "v"])


def _unpack(total: np.ndarray, at: bytes, v: bytes) -> None:
    if at:
        total[np.frombuffer(at, np.uint16)] += np.frombuffer(v)
    elif v:
        total += np.frombuffer(v)


def vector_sum(rows: DataFrame, partial, length: int, tasks: int = 0) -> np.ndarray:
    """The sum of the vectors that ``partial(batches)`` yields as (part,
    vector); parts are added in order, so fixed parts give the same sum on any
    cluster.  ``tasks``: how many the rows have, if known (one needs no adding)."""
    if length > MAX_NUMBERS:
        raise ValueError(f"{length} numbers are not gathered on the driver")

    def run(batches):
        for part, vector in partial(batches):
            for b in range(0, length, BLOCK):
                own = np.asarray(vector[b:b + BLOCK], np.float64)
                if own.any():
                    yield _packed(b // BLOCK, own, part)

    def add(batches):
        now, total = None, None
        for batch in batches:  # sorted by block and part
            for b, at, v in zip(*(batch.column(c).to_pylist() for c in ("block", "at", "v"))):
                if b != now:
                    if now is not None:
                        yield _packed(now, total)
                    now, total = b, np.zeros(min(BLOCK, length - b * BLOCK))
                _unpack(total, at, v)
        if now is not None:
            yield _packed(now, total)

    blocks = rows.mapInArrow(run, "block int, part int, at binary, v binary")
    per = PER_ADDER if length <= COLLECTED else FETCHED
    adders = max(1, min(-(-length // per), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    found = blocks
    if tasks != 1:
        found = (blocks.repartition(adders, "block").sortWithinPartitions("block", "part")
                 .mapInArrow(add, "block int, part int, at binary, v binary"))
    out = numbers(length)
    for r in found.collect() if length <= COLLECTED else found.toLocalIterator(prefetchPartitions=True):
        _unpack(out[r["block"] * BLOCK:(r["block"] + 1) * BLOCK], r["at"], r["v"])
    give_back(rows.sparkSession)
    return out


def width_of(rows: DataFrame, features: str = "features") -> int:
    """Length of the vectors."""
    head = rows.select(features).where(f"{features} is not null").first()
    return int(head[0].size) if head else 0
