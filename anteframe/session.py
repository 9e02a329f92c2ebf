"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Naive clock times are held as TIMESTAMP under UTC, so the session zone must be UTC. ANSI mode
# makes a cell that does not fit its type an error instead of a null.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Spares a Python stack trace per column expression; wide tables have many of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Wide plans compile to many classes; a session with several of them should keep these.
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def build_session(app: str = "anteframe", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, val in {**DEFAULTS, **REQUIRED, **conf}.items():
        builder = builder.config(key, val)
    return builder.getOrCreate()


def with_required(spark: SparkSession) -> SparkSession:
    """A session somebody else made, with the settings that results depend on."""
    for key, val in REQUIRED.items():
        spark.conf.set(key, val)
    return spark
