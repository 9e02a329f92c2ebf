"""Longest-prefix mapping of codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import col


def longest_prefix_group(
    df: DataFrame, mapping: DataFrame, *, code: str, prefix: str, group: str, out: str
) -> DataFrame:
    """Adds the group of the longest prefix that the code starts with; null if there is none.

    Only distinct codes are matched, by equality on each of their own prefixes. The result goes
    back to the rows by an equi join on the code, which Spark broadcasts when small and splits
    when a code is hot. A prefix listed twice counts with its smallest group.
    """
    rules = mapping.groupBy(col(prefix).alias("_prefix")).agg(F.min(col(group)).alias("_group"))
    codes = df.select(col(code).alias("_code")).where(F.col("_code").isNotNull()).distinct()
    matched = (
        codes.withColumn("_len", F.explode(F.sequence(F.lit(0), F.length("_code"))))
        .withColumn("_prefix", F.substring(F.col("_code"), F.lit(1), F.col("_len")))
        .join(rules, "_prefix")
        .groupBy("_code")
        .agg(F.max_by("_group", "_len").alias(out))
    )
    return df.join(matched, col(code) == F.col("_code"), "left").drop("_code")
