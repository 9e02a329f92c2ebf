"""Any-of flags over everything known up to an anchor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import all_present, col, names


def history_flags(
    anchors: DataFrame,
    history: DataFrame,
    *,
    key: str | Sequence[str],
    anchor_ts: str,
    event_ts: str,
    group: str,
    groups: Sequence,
    prefix: str,
) -> DataFrame:
    """One row per (case, anchor) with an event at or before the anchor; a flag per group.

    An event of a group lies before the anchor exactly if the first one does. So the history is
    reduced to one row of first times per case, and no event is ever paired with an anchor.
    """
    keys = names(key)
    first = (
        history.where(all_present([*keys, event_ts]))
        .groupBy(*map(col, keys))
        .agg(
            F.min(col(event_ts)).alias("_first"),
            *[
                F.min(F.when(col(group) == g, col(event_ts))).alias(f"_first_{g}")
                for g in groups
            ],
        )
    )
    at = col(anchor_ts)
    return (
        anchors.select(*map(col, [*keys, anchor_ts]))
        .distinct()
        .join(first, keys)
        .where(F.col("_first") <= at)
        .select(
            *map(col, [*keys, anchor_ts]),
            *[
                F.coalesce(col(f"_first_{g}") <= at, F.lit(False)).alias(f"{prefix}_{g}")
                for g in groups
            ],
        )
    )


def pair_count(left: DataFrame, right: DataFrame, *, key: str | Sequence[str]) -> DataFrame:
    """How many rows an inner join on the key would have, without joining the rows."""
    keys = names(key)
    n_left = left.groupBy(*map(col, keys)).agg(F.count("*").alias("_left"))
    n_right = right.groupBy(*map(col, keys)).agg(F.count("*").alias("_right"))
    return n_left.join(n_right, keys).agg(
        F.coalesce(F.sum(F.col("_left") * F.col("_right")), F.lit(0)).alias("n_pairs")
    )
