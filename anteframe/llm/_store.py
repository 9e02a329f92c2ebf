"""Tables that cut lineage, in the folder all machines share, and joins behind a checked size."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: At most so many ids are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where unset, a local one is made if all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        found = tempfile.mkdtemp(prefix="anteframe-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read again: a lost executor costs no rework."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/anteframe-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def of_ids(rows: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """``rows`` joined ``left_semi`` or ``left_anti`` with stored ``ids``; broadcast only if few."""
    ids = ids.select(F.col(key))
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, how)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """While a table is stored, Python gets so many rows at a time: for very wide rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    yield
    spark.conf.set(key, before)


def ready(spark: SparkSession, rows: int = 1000) -> None:
    """Before Python runs in tasks: workers get this subpackage, and few rows at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    context = spark.sparkContext
    if getattr(context, "_anteframe_shipped", False):
        return
    here = Path(__file__).resolve().parent
    shipped = Path(tempfile.mkdtemp(prefix="anteframe-")) / "anteframe_llm.zip"
    with zipfile.ZipFile(shipped, "w") as out:
        for file in (here.parent / "__init__.py", *sorted(here.glob("*.py"))):
            out.write(file, file.relative_to(here.parent.parent))
    context.addPyFile(str(shipped))
    context._anteframe_shipped = True
