"""A training corpus from raw documents: quality, exact copies, near copies, repeated passages, packing.

Every stage reads what its predecessor wrote and all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import entry, exact_dedup, knn_quality, minhash, packing, substring_dedup
from tidegauge.llm.common import materialize, small_batches, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the classifier doesn't reject."""
    small_batches(spark)
    labels = table(spark, sf_dir, "labels")
    model = knn_quality.model(table(spark, sf_dir, "documents"), labels)
    return knn_quality.accepted(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    small_batches(spark)
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: runs of five words, similarity 0.8."""
    small_batches(spark)
    return minhash.drop_near_duplicates(docs, k=5, percent=80)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; n_chars follows the text where there is such a column."""
    small_batches(spark)
    columns = docs.columns
    out = substring_dedup.substring_dedup(docs)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*(F.col(f"`{c}`") for c in columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences."""
    small_batches(spark)
    return packing.pack(docs, entry.tokenizer("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("minhash_dedup", near),
    ("substring_dedup", substring),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the search for a packing; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage before it returns is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
