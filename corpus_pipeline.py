"""The corpus pipeline: quality, line dedup, near-dedup, decontamination, tokens.

Each stage reads what the one before wrote.  Stages keep all columns of
``documents``; the last one returns the encoded documents.  Rows without an id
pass the stages that compare documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pairgrade.llm.bitmap import drop_rows
from pairgrade.llm.bpe import encode_decode
from pairgrade.llm.common import id_text, table, text_hash
from pairgrade.llm.decontaminate import contamination
from pairgrade.llm.lines import covered_lines, without_lines
from pairgrade.llm.near_dedup import near_duplicates
from pairgrade.llm.quality import keep_good, train
from pairgrade.sources.sinks import materialize

MARK = "_row_mark"
#: Matches and states that a worker keeps in the last stage, beside executors whose
#: heap the stages before have filled.
CACHE_PIECES, MAX_STATES = 250_000, 50_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more; it is trained on the
    labelled ones among them outside the held-out fifth."""
    return keep_good(docs, train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand earlier, equal or within two
    edits; a document that loses every line goes."""
    own = id_text(docs).withColumn("mark", text_hash())
    return without_lines(docs.withColumn(MARK, text_hash()), covered_lines(own), MARK)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id."""
    copies = materialize(near_duplicates(docs).where("not kept").select("doc_id", "mark"), "copies")
    return drop_rows(docs.withColumn(MARK, text_hash()), copies, MARK)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    found = contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    return drop_rows(docs.withColumn(MARK, text_hash()), materialize(found.select("doc_id", "mark"), "leaks"), MARK)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of what is left."""
    return encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                         cache_pieces=CACHE_PIECES, max_states=MAX_STATES, second=True)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", byte_bpe),
]

#: A learned model and edit distances over all lines are beyond SQL; the
#: pipeline is tested against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
