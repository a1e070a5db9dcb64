"""From raw documents to packed training text: filter, deduplicate three ways, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm.exact import drop_exact_duplicates
from linkloom.llm.minhash import drop_near_duplicates
from linkloom.llm.packing import best_fit
from linkloom.llm.quality import keep_good
from linkloom.llm.queries import QUERIES as OPERATORS
from linkloom.llm.settings import small_batches
from linkloom.llm.wordrepeats import drop_repeated_words
from linkloom.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on this folder's labels, scores high enough."""
    small_batches(spark)
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    small_batches(spark)
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five-word shingles, similarity 0.8) the row with the smallest doc_id."""
    small_batches(spark)
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the twenty-word windows that also start earlier."""
    small_batches(spark)
    return drop_repeated_words(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: bin and offset."""
    small_batches(spark)
    return best_fit(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", packing),
]

#: A fitted model and best-fit packing cannot be put in SQL; tests compare with plain forms.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = OPERATORS | {"pipeline": run}
