"""Registry of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")


def query(sql: str) -> Callable:
    """Registers a function of ``Tables`` under its own name."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        QUERIES[fn.__name__] = run
        ORACLES[fn.__name__] = sql
        return fn

    return register
