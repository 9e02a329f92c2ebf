"""Small helpers for column names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column by its literal name; dots, blanks and umlauts in it are allowed."""
    return F.col("`" + name.replace("`", "``") + "`")


def names(one_or_many: str | Sequence[str]) -> list[str]:
    return [one_or_many] if isinstance(one_or_many, str) else list(one_or_many)


def all_present(cols: Sequence[str]) -> Column:
    """True where none of the columns is null."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & col(c).isNotNull()
    return cond
