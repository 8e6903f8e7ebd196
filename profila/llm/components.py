"""Distributed union-find over an edge table, by rounds of contraction.

In a round every node points at the smallest of itself and its neighbours,
both ends of every edge are replaced by what they point at, and edges that
became loops are dropped.  In each component at least every second node
vanishes in a round, so a few rounds are enough; the nodes' pointers of all
rounds are then chained.  All steps are joins and aggregations on node ids;
the pointer table of a round is written to the shared folder before it is
joined, so that a hub with very many edges can be split by the engine, and
every round starts from written files.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars with the same components as the links (a[i], b[i]): (member,
    root) with root the smallest of its component, members without the root."""
    nodes, pos = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = pos[: len(a)], pos[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    member = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[member], nodes[label[member]]


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links of long ids → (node, root): every node that has a link to
    another one, with the smallest id of its component.  Null ends, loops and
    repeated links have no effect; no links give no rows."""
    edges = durable(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .where("u is not null and v is not null and u != v").distinct())
    rounds = []
    while not edges.isEmpty():
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = durable(both.groupBy("u").agg(F.min("v").alias("m"))
                     .select(F.col("u").alias("node"), F.least("u", "m").alias("to")))
        rounds.append(to)
        left = edges.join(to.select(F.col("node").alias("u"), F.col("to").alias("a")), "u")
        right = left.join(to.select(F.col("node").alias("v"), F.col("to").alias("b")), "v")
        edges = durable(right.where("a != b").select(F.greatest("a", "b").alias("u"),
                                                     F.least("a", "b").alias("v")).distinct())
    if not rounds:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = rounds[-1]
    for to in reversed(rounds[:-1]):
        later = durable(found.select(F.col("node").alias("to"), F.col("to").alias("root")))
        found = to.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("to"))
    return durable(found.select("node", F.col("to").alias("root")))
