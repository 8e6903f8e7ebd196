"""Per-device app and tag lists.

Lists are kept in long form — ``(device_id, pos, value)`` — because a
device's full event list is unbounded: the position comes from a
range-partitioned global order (``sequence.group_positions``), never from
collecting a device's events into one task.  Only lists with a proven
bound (distinct apps of a device ≤ the app catalogue; the last 50 tokens)
are ever turned into arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import group_positions


def event_app_sequence(events: DataFrame) -> DataFrame:
    """Every event's app in event order → ``(device_id, pos, app_id)``."""
    ev = events.where(F.col("device_id").isNotNull()).select("device_id", "event_id", "app_id")
    return group_positions(ev, "device_id", ["event_id", "app_id"], write=False).select("device_id", "pos", "app_id")


def distinct_app_tags(events: DataFrame) -> DataFrame:
    """D2 (+U1, O2): distinct ``(device_id, app_id, tag_list)`` triples; an app
    seen with two tag lists stays twice.  ``first_date`` is carried for A10."""
    return (events.where(F.col("device_id").isNotNull())
            .groupBy("device_id", "app_id", "tag_list")
            .agg(F.min("date").alias("first_date")))


def first_use_sequence(triples: DataFrame) -> DataFrame:
    """A10: the device's distinct (app, tag list) entries ordered by first
    date, then app, then tag list → ``(device_id, pos, app_id)``."""
    return group_positions(triples.select("device_id", "app_id", "tag_list", "first_date"),
                           "device_id", ["first_date", "app_id", "tag_list"]) \
        .select("device_id", "pos", "app_id")


def bounded_list(seq: DataFrame, group: str, value: str, pos: str = "pos", name: str = "items") -> DataFrame:
    """Array of ``value`` in ``pos`` order per group, for sequences whose
    length per group is bounded by construction."""
    return (seq.groupBy(group)
            .agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos), F.col(value)))),
                             lambda s: s[value]).alias(name)))
