"""Bounded samples of labelled rows to learn from, and the split that holds rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str | Column = "doc_id", parts: int = 5) -> Column:
    """True for the rows nothing is learned from; a null id counts as the empty text."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == 0


def draw(label: str, counts: dict, most: int, key: str = "doc_id") -> Column:
    """Keeps about ``most`` rows of each label, the same ones every time."""
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), min(1.0, most / n)).otherwise(share)
    return F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) < share * (1 << 30)


def label_counts(rows: DataFrame, label: str) -> dict:
    return {r[label]: r["n"] for r in rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).collect()}


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int) -> tuple[DataFrame, dict]:
    """Rows (text, label) to learn from, about ``most`` of each label, and how many there are in all.

    Only ids are counted and drawn; the drawn ones, a bounded number, are broadcast to the texts.
    """
    known = labels.where(F.col(label).isNotNull() & ~held_out()).select("doc_id", F.col(label).alias("label"))
    counts = label_counts(known, "label")
    drawn = known.where(draw("label", counts, most))
    return docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id"), counts
