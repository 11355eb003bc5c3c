"""The registered queries of the text operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import conversation_repair as conversations
from tidegauge.llm import exact_dedup as exact
from tidegauge.llm import hard_negatives as negatives
from tidegauge.llm import html_text as html
from tidegauge.llm import knn_quality as knn
from tidegauge.llm import line_dedup as lines
from tidegauge.llm import minhash, oracles, packing, simhash
from tidegauge.llm import piece_codec as codec
from tidegauge.llm import quality_rules as rules
from tidegauge.llm import substring_dedup as substring
from tidegauge.llm import url_filter as urls
from tidegauge.llm.common import table

#: The rules that the url query judges by.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def tokenizer(name: str) -> str:
    """The place of a vocabulary file, which all machines have installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text, n_sentences, n_removed."""
    return substring.substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_sentences", "n_removed")


def op2_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.knn_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.html_text(table(spark, sf_dir, "pages"))


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.piece_codec(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_filter(table(spark, sf_dir, "pages"), URL_RULES)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, shifted)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damage(whole), whole)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), k=3, distance=2)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
