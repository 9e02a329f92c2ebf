"""Values relative to their reference range.

The category says which bounds a parameter has.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOTH, LOWER_ONLY, UPPER_ONLY, NONE = 0, 1, 2, 3


def range_normalised(value: Column, lower: Column, upper: Column, category: Column) -> Column:
    """Position in the range, or ratio to its one bound, or the value itself; null for a zero divisor."""

    def over(num: Column, den: Column) -> Column:
        return num / F.nullif(den, F.lit(0.0))

    return (
        F.when(category == BOTH, over(value - lower, upper - lower))
        .when(category == LOWER_ONLY, over(value, lower))
        .when(category == UPPER_ONLY, over(value, upper))
        .when(category == NONE, value)
    )


def category_fits(category: Column, lower: Column, upper: Column) -> Column:
    """True where exactly the bounds named by the category are present."""
    lo, hi = lower.isNotNull(), upper.isNotNull()
    fits = (
        F.when(category == BOTH, lo & hi)
        .when(category == LOWER_ONLY, lo & ~hi)
        .when(category == UPPER_ONLY, ~lo & hi)
        .when(category == NONE, ~lo & ~hi)
    )
    return F.coalesce(fits, F.lit(False))
