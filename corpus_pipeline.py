"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows the one before it has kept, and all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anteframe.llm import decontaminate, minhash, packing, quality, suffix_dedup
from anteframe.llm._store import stored

#: SQL has no counterpart of the model, the token ids or the packing; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model, threshold=0.3)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return minhash.one_of_each(docs, words=5, percent=80)


def unrepeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what they repeat of earlier ones; n_chars follows."""
    cut = suffix_dedup.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.length("text").cast(kind)).select(docs.columns)


def uncontaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which benchmark passages occur."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, each with its sequence and offset."""
    return packing.packed(docs)


STAGES = [
    ("quality", good_documents),
    ("near duplicates", distinct_documents),
    ("repeated passages", unrepeated_passages),
    ("decontamination", uncontaminated_documents),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
