"""Long to wide: one row per anchor with a fixed set of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import col, names
from ..functions.numbers import percent


def pivot_values(
    df: DataFrame,
    *,
    index: str | Sequence[str],
    dim: str,
    value: str,
    values: Sequence,
    how: str = "one",
) -> DataFrame:
    """One column per listed dimension value, always all of them; other values are dropped.

    ``how``: ``one`` for at most one value per cell, ``mean`` for their average. A single
    aggregation with a map-side part, no second shuffle per pivot column.
    """
    agg = {"one": F.max, "mean": F.avg}[how]
    by, cell = col(dim), col(value)
    return df.groupBy(*map(col, names(index))).agg(
        *[agg(F.when(by == v, cell)).alias(str(v)) for v in values]
    )


def pivot_counts(
    df: DataFrame,
    *,
    index: str | Sequence[str],
    dim: str | Column,
    values: Sequence,
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """Row counts per listed dimension value, 0 where there are none."""
    by = col(dim) if isinstance(dim, str) else dim
    return df.groupBy(*map(col, names(index))).agg(
        *[F.count_if(by == v).alias(n) for v, n in zip(values, labels or map(str, values))]
    )


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null (in the given columns)."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in all, complete rows, lost rows and the complete share in percent."""
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | col(c).isNull()
    return df.agg(
        F.count("*").alias("n_rows"), F.count_if(~any_null).alias("n_complete")
    ).select(
        "n_rows",
        "n_complete",
        (F.col("n_rows") - F.col("n_complete")).alias("n_lost"),
        percent(F.col("n_complete"), F.col("n_rows")).alias("percent_complete"),
    )
