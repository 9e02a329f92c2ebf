"""Numbers out of messy text, and rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import col

# Guards the cast: Spark alone would also take "1.0d", "1f" and "nan".
PLAIN_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def lenient_decimal(text: Column, drop: str = "<>") -> Column:
    """Decimal comma or point, the characters in ``drop`` removed; anything else is null."""
    plain = F.translate(text, "," + drop, ".")
    return F.when(plain.rlike(PLAIN_DECIMAL), plain.try_cast("double"))


def reference_decimal(text: Column) -> Column:
    """A reference bound, where a bare ``0`` means "not given"."""
    return lenient_decimal(F.nullif(text, F.lit("0")), drop="")


def add_numeric_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<column>_num`` next to each text column."""
    return df.withColumns({f"{c}_num": lenient_decimal(col(c), drop="") for c in columns})


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Share in percent, half-even; null for an empty whole."""
    return F.bround(part * 100 / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def floor_bucket(x: Column, size: float, scale: float = 1) -> Column:
    """Floor (not truncation) to whole buckets of ``size``, counted in ``scale`` units."""
    return F.floor(x / F.lit(size)) * F.lit(scale)


def capped(x: Column, cap: float) -> Column:
    """``x`` below the cap, else the cap; a missing ``x`` also gives the cap."""
    return F.when(x < cap, x).otherwise(F.lit(cap).cast("double"))
