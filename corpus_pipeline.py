"""The corpus pipeline: stages over ``documents``, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lansight.llm.common import materialize, table
from lansight.llm.line_dedup import dedup_lines
from lansight.llm.mixing import MixRules, mix_documents
from lansight.llm.near_dedup import keep_one
from lansight.llm.quality_rules import keep_good
from lansight.llm.sentencepiece_codec import encode_documents
from lansight.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression and counting rules reject go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents stay only in the largest doc_id."""
    return dedup_lines(docs).drop("lines")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of words drawn to the sources' target weights: a row per drawn part of a document, which
    keeps the document's id, language and source, and comes as often as the mix takes it."""
    return mix_documents(docs, MixRules(block_words=256))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's rows as token ids, with their number and whether decoding gave the text back."""
    return encode_documents(docs, carry=("doc_id", "lang", "source")).drop("ids_sha256")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]

# Compression ratios and a tokenizer's model are outside SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), scratch_path(spark, f"pipeline-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
