"""Joins in which missing keys match, and attaching features to their anchors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import col, names


def null_safe_join(
    left: DataFrame, right: DataFrame, *, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on equal keys where null equals null; the key columns appear once."""
    keys = names(on)
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & col(k).eqNullSafe(col(f"_right_{k}"))
    return left.join(renamed, cond, how).drop(*[f"_right_{k}" for k in keys])


def attach(
    anchors: DataFrame,
    features: DataFrame,
    *,
    on: str | Sequence[str],
    keep_unmatched: bool,
    fill_false: Sequence[str] = (),
) -> DataFrame:
    """Features next to their anchor rows; anchors without features stay on request.

    Flags named in ``fill_false`` are false where there is nothing to attach.
    """
    out = anchors.join(features, names(on), "left" if keep_unmatched else "inner")
    return out.withColumns({c: F.coalesce(col(c), F.lit(False)) for c in fill_false})


def with_group_size(df: DataFrame, keys: Sequence[str], name: str = "size") -> DataFrame:
    """Each row with the number of rows that share its keys (nulls are one key).

    Counting first and joining the counts keeps a hot group out of a single window task.
    """
    sizes = df.groupBy(*map(col, keys)).agg(F.count("*").alias(name))
    return null_safe_join(df, sizes, on=keys, how="left")
