"""Distinct rows, newest versions, unique groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..columns import col


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order (nulls are one key).

    Spark keeps only the first rows of each input partition before the shuffle, so many copies
    of one key do not travel.
    """
    first = W.partitionBy(*map(col, keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def keep_singletons(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that are alone in their group (nulls are one key)."""
    rest = [c for c in df.columns if c not in keys]
    # A group of one is its own first row, so a count per group is all that has to be merged.
    return (
        df.groupBy(*map(col, keys))
        .agg(F.count("*").alias("_size"), *[F.first(col(c)).alias(c) for c in rest])
        .where("_size = 1")
        .select(*map(col, df.columns))
    )


def uniqueness_violations(df: DataFrame, keys: Sequence[str], name: str = "size") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*map(col, keys)).agg(F.count("*").alias(name)).where(col(name) != 1)


def unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of ``df``; a query that meets one of several rows fails, no query runs before."""
    sizes = df.groupBy(*map(col, keys)).agg(F.count("*").alias("_size"))
    shown = F.concat_ws(", ", *[F.coalesce(col(k).cast("string"), F.lit("null")) for k in keys])
    wrong = F.raise_error(F.concat(F.lit(f"keys {list(keys)} are not unique: "), shown))
    return sizes.where(F.when(F.col("_size") > 1, wrong.cast("boolean")).otherwise(True)).drop("_size")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error naming some of the keys that occur more than once."""
    found = uniqueness_violations(df, keys).limit(5).collect()
    if found:
        raise ValueError(f"keys {list(keys)} are not unique, e.g. {[r.asDict() for r in found]}")
    return df
