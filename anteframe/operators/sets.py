"""Unions of sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame, fill_missing: bool = False) -> DataFrame:
    """All rows by column name; with ``fill_missing`` a column absent from a source is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), frames)
