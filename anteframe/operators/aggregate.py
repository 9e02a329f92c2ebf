"""Group counts, value counts, null profile, histogram, row loss."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import all_present, col
from ..functions.numbers import percent


def group_counts(
    df: DataFrame, keys: Sequence[str], *, keep_nulls: bool, name: str = "n"
) -> DataFrame:
    """Rows per key; rows with a missing key form groups of their own or are left out."""
    rows = df if keep_nulls else df.where(all_present(keys))
    return rows.groupBy(*map(col, keys)).agg(F.count("*").alias(name))


def distinct_counts(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Distinct values of a column per key (or in all, without keys); nulls do not count."""
    pairs = df.select(*map(col, [*keys, column])).distinct()
    return pairs.groupBy(*map(col, keys)).agg(F.count(col(column)).alias(name))


def single_or_null(
    df: DataFrame, keys: Sequence[str], value: str, count_name: str = "n"
) -> DataFrame:
    """Groups with exactly one present value; the value itself only if the group is one row."""
    return (
        df.groupBy(*map(col, keys))
        .agg(
            F.when(F.count("*") == 1, F.first(col(value))).alias(value),
            F.count(col(value)).alias(count_name),
        )
        .where(col(count_name) == 1)
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Each value (null included) with its count and its share of all rows."""
    counts = df.groupBy(col(column)).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: its nulls and all rows, from a single pass."""
    stats = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(columns)],
    )
    items = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"_null_{i}").alias("n_null"),
            F.col("_rows").alias("n_rows"),
        )
        for i, c in enumerate(columns)
    ]
    return stats.select(F.inline(F.array(*items)))


def row_loss(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before and after a filter, removed rows, and the kept share in percent."""
    kept = F.coalesce(keep, F.lit(False))
    return df.agg(F.count("*").alias("n_before"), F.count_if(kept).alias("n_after")).select(
        "n_before",
        "n_after",
        (F.col("n_before") - F.col("n_after")).alias("n_removed"),
        percent(F.col("n_after"), F.col("n_before")).alias("percent_kept"),
    )


def histogram(df: DataFrame, value: str, bins: int = 100) -> DataFrame:
    """Equal-width bins between minimum and maximum: ``bin``, ``lower``, ``upper``, ``n``.

    The last bin includes its upper edge. Values are compared with the edges themselves, so a
    rounding error of the division cannot put a value into the neighbouring bin. Empty bins
    are listed. The input is read once: edges and bins both come from the counts of its distinct
    values.
    """
    # -0.0 is the same value as 0.0, and no key of its own.
    v = df.select((col(value).cast("double") + F.lit(0.0)).alias("_v")).where("_v IS NOT NULL")
    v = v.groupBy("_v").agg(F.count("*").alias("_n"))
    # Always true, but so the edges need the counts too and come from the same exchange as the bins.
    ends = v.where("_n > 0").agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ends = ends.select(
        F.struct(
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )
    spark = df.sparkSession
    lo, hi = F.col("_e.lo"), F.col("_e.hi")
    step = (hi - lo) / bins

    def edge(i: Column) -> Column:
        return F.when(i == bins, hi).otherwise(i * step + lo)

    guess = F.least(F.floor((F.col("_v") - lo) / (hi - lo) * bins), F.lit(bins - 1))
    counts = (
        v.withColumn("_e", ends.scalar())
        .withColumn("_b", guess)
        .withColumn(
            "bin",
            F.when(F.col("_v") < edge(F.col("_b")), F.col("_b") - 1)
            .when(
                (F.col("_b") < bins - 1) & (F.col("_v") >= edge(F.col("_b") + 1)),
                F.col("_b") + 1,
            )
            .otherwise(F.col("_b")),
        )
        .groupBy("bin")
        .agg(F.sum("_n").alias("n"))
    )
    return (
        spark.range(bins)
        .select(F.col("id").alias("bin"), ends.scalar().alias("_e"))
        .join(counts, "bin", "left")
        .select(
            "bin",
            edge(F.col("bin")).alias("lower"),
            edge(F.col("bin") + 1).alias("upper"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )
