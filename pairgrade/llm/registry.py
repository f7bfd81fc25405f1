"""Queries of the corpus operators (production parameters, whole tables), and
their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairgrade.llm.bpe import encode_decode
from pairgrade.llm.common import table
from pairgrade.llm.decontaminate import contamination
from pairgrade.llm.fingerprints import document_fingerprints
from pairgrade.llm.grace import exact_duplicates
from pairgrade.llm.lines import dedup_lines
from pairgrade.llm.near_dedup import near_duplicates
from pairgrade.llm.oracle import DECONTAMINATE, EXACT, NEGATIVES, SUBSTRING
from pairgrade.llm.quality import score_texts, train
from pairgrade.llm.quotes import SQL as QUOTES_SQL
from pairgrade.llm.quotes import linked_conversations
from pairgrade.llm.rtree import hard_negatives
from pairgrade.llm.secrets import secret_spans
from pairgrade.llm.substring import dedup_substrings
from pairgrade.llm.token_counts import token_counts
from pairgrade.llm.whitening import whitened_embeddings


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")) \
        .drop("items", "mark")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"),
                         public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                         public_tokenizers.PATTERN)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=2).drop("mark")


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).drop("mark", "kept")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, train(docs, table(spark, sf_dir, "labels")))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"))


def op9_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_conversations(table(spark, sf_dir, "conversations"))


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents")).drop("kept")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_embeddings(table(spark, sf_dir, "embeddings"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_token_counts": op2_token_counts,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_near_dedup": op4_near_dedup,
    "op5_lines": op5_lines,
    "op6_quality": op6_quality,
    "op7_secrets": op7_secrets,
    "op8_fingerprints": op8_fingerprints,
    "op9_quotes": op9_quotes,
    "op10_substring": op10_substring,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": DECONTAMINATE,
    "op9_quotes": QUOTES_SQL,
    "op10_substring": SUBSTRING,
    "op11_hard_negatives": NEGATIVES,
    "op13_exact_dedup": EXACT,
}
