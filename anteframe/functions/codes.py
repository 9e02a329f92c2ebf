"""Code columns: merging of synonyms, null-keeping tests, sentinels, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab


def common_code(
    code: Column,
    merged: Mapping[str, Sequence[str]] = vocab.MERGED_IDS,
    mark: str | None = vocab.GLUCOSE_MARK,
    mark_code: str = vocab.GLUCOSE_ID,
) -> Column:
    """Codes containing ``mark`` become ``mark_code``, listed synonyms their common code."""
    out = code
    for target, synonyms in merged.items():
        out = F.when(code.isin(*synonyms), F.lit(target)).otherwise(out)
    return F.when(code.contains(mark), F.lit(mark_code)).otherwise(out) if mark else out


def collapsed_code(code: Column, pattern: str, target: str) -> Column:
    return F.when(matches(code, pattern), F.lit(target)).otherwise(code)


def matches(text: Column, pattern: str) -> Column:
    """Regex found anywhere; a missing text does not match."""
    return F.coalesce(text.rlike(pattern), F.lit(False))


def differs(c: Column, value: object) -> Column:
    """Not equal, where a missing value counts as different."""
    return ~c.eqNullSafe(F.lit(value))


def blank_sentinel(c: Column, sentinel: object) -> Column:
    """The sentinel means "not given"."""
    return F.nullif(c, F.lit(sentinel))


def binary_label(label: Column, negative: str = vocab.LABEL_NEGATIVE) -> Column:
    """0 for the negative label, else 1 (also for a missing one)."""
    return F.when(label.eqNullSafe(F.lit(negative)), 0).otherwise(1)


def confident_label(
    label: Column,
    confidence: Column,
    labels: Sequence[str] = (vocab.LABEL_NEGATIVE, vocab.LABEL_POSITIVE),
    least: float = vocab.MIN_CONFIDENCE,
) -> Column:
    """One of the wanted labels, given with enough confidence."""
    return label.isin(*labels) & (confidence >= least)


def as_prefix(code: Column, wildcard: str = ".x") -> Column:
    """``C91.x`` stands for everything that starts with ``C91``."""
    return F.replace(code, F.lit(wildcard), F.lit(""))
