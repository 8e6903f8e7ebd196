"""Join helpers shared by the operators.

Broadcast is forced only for sides whose row count is bounded by
construction (a top-N list, a per-label offset table, as many frequent keys as
the session's broadcast threshold holds).  Every other join is left to the
planner: AQE converts a shuffle join into a broadcast one from the measured
size of the small side, and splits skewed partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_bounded(df: DataFrame, bound_rows: int, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast ``df`` whose row count is at most ``bound_rows`` by
    construction.  Raises for bounds that could not fit an executor."""
    if bound_rows > max_rows:
        raise ValueError(f"a side of up to {bound_rows} rows is not bounded enough to broadcast")
    return F.broadcast(df)


def join_by_frequency(cells: DataFrame, table: DataFrame, key: str, count: str, row_bytes: int) -> DataFrame:
    """``cells`` ⋈ ``table`` by ``key``, ``count`` left out; ``table``: a written
    one with a row per key and its number of cells in ``count``.  The most
    frequent keys, which hold most cells, are broadcast, as many as the session's
    threshold holds at ``row_bytes`` each, so their cells stay where they lie;
    the cells of the others, none of them a hot key, are shuffled by key."""
    least = _least_count(table, count, row_bytes)
    if least is None:
        return cells.join(table.drop(count), key)
    often = F.broadcast(table.where(F.col(count) >= least).drop(count))
    near = cells.join(often, key)
    if least <= 1:
        return near
    others = cells.join(often.select(key), key, "left_anti").join(table.where(F.col(count) < least).drop(count), key)
    return near.unionByName(others)


def _least_count(table: DataFrame, count: str, row_bytes: int) -> int | None:
    """The least power of two such that no more keys have as many cells than
    may be broadcast; None: not even the most frequent ones."""
    spark = table.sparkSession
    free = max(0, spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()) // row_bytes
    least = None
    # one row for each power of two
    found = table.groupBy(F.length(F.bin(count)).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    for b, n in sorted(found, reverse=True):
        free -= n
        if free < 0:
            return least
        least = 2 ** (b - 1)
    return 1


def attach(base: DataFrame, parts: list[DataFrame], key: str = "device_id") -> DataFrame:
    """Left-join each per-key feature table onto ``base`` by key.
    Each part must carry one row per key."""
    return reduce(lambda acc, p: acc.join(p, key, "left"), parts, base)


def chain_predicted(table: DataFrame, predicted: DataFrame, column: str = "gender", key: str = "device_id") -> DataFrame:
    """J7 + M18: ``column`` true where the row is labelled (``is_train`` = 1) and
    predicted elsewhere.  ``predicted``: (key, value), one row per key."""
    value, = (c for c in predicted.columns if c != key)
    return (table.join(predicted.select(key, F.col(value).alias("_pred")), key, "left")
            .withColumn(column, F.when(F.col("is_train") == 1, F.col(column)).otherwise(F.col("_pred"))).drop("_pred"))


def result_rows(raw: DataFrame, predictions: DataFrame, key: str = "device_id") -> DataFrame:
    """One result row for every row of the raw unlabelled list, in which a
    key may stand several times; keys without a prediction get nulls."""
    return raw.select(key).join(predictions, key, "left")
