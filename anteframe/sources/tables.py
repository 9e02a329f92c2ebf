"""Result tables: written by all tasks in parallel, one file per task."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


def stamped(path: str, at: dt.datetime | None = None) -> str:
    """The path with ``yyyy-mm-dd_HH-MM_`` in front of its last part."""
    folder, slash, name = path.rpartition("/")
    return f"{folder}{slash}{(at or dt.datetime.now()):%Y-%m-%d_%H-%M}_{name}"


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "errorifexists") -> str:
    """Parquet, the form in which results are kept."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> str:
    """CSV files with a header in a folder, readable again by ``read_delimited``."""
    df.write.mode(mode).options(header=True, sep=sep, quote='"', escape='"').csv(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written before: parquet, or CSV if the path or its files end in ``.csv``."""
    if path.endswith(".csv"):
        return spark.read.options(header=True, quote='"', escape='"', inferSchema=True).csv(path)
    return spark.read.parquet(path)
