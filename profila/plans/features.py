"""The shared device feature table (M19's 22 common inputs before stacks).

devices (D1, U2) ⟕ A1+F2+F3+A2 ⟕ A4+A6 ⟕ M1, all keyed by device_id.
The event log is read twice: once summed by (device, app, date), which feeds
everything but the distinct event ids, and once for those, two columns wide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.encode import kfold_target_encode
from ..operators.events import app_usage_features, device_event_aggregates, log_groups
from ..operators.folds import assign_folds
from ..operators.joins import attach
from ..session import durable

ENCODED = ["phone_brand", "device_model"]
ID_COLUMNS = ["device_id", "gender", "age", "is_train"]


def gender_folds(devs: DataFrame, k: int = 5) -> DataFrame:
    """One fold assignment per label; every gender consumer shares it."""
    return assign_folds(devs.where("is_train = 1"), "gender", k=k, n_labels_bound=2)


def device_feature_table(devs: DataFrame, events: DataFrame, folds: DataFrame | None = None,
                         encode: bool = True) -> DataFrame:
    """The de-duplicated device table feeds the fold assignment, the
    encoder's several branches and the final join, so it is written once
    (as is the fold table) instead of being re-derived, with its dedup
    shuffle, in every branch."""
    devs = durable(devs)
    groups = log_groups(events)
    aggs = device_event_aggregates(events, with_tri_day=True, groups=groups)
    usage = app_usage_features(events, groups=groups)
    parts = [aggs, usage]
    if encode:
        folds = durable(folds if folds is not None else gender_folds(devs))
        parts.append(kfold_target_encode(devs, folds, ENCODED, "gender"))
    return attach(devs, parts)
