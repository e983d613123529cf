"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, tokens.

Every stage works on what its predecessor kept, written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelpulse.llm.byte_bpe import encode_texts, public_vocabulary
from modelpulse.llm.decontamination import keep_uncontaminated
from modelpulse.llm.line_dedup import drop_repeated_lines
from modelpulse.llm.near_dedup import keep_one
from modelpulse.llm.quality import keep_good
from modelpulse.llm.text import documents
from modelpulse.session import scratch_path
from modelpulse.sources.tables import load


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within the perplexity bands of their language."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand in many of them; ``n_chars`` follows the text."""
    kept = drop_repeated_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, the one with the smallest id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return keep_uncontaminated(docs, load(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of the whole texts: counts and digests of the ids and of the decoded bytes."""
    return encode_texts(docs, public_vocabulary(), digests=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

# Perplexity, similarity and BPE merges are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage on the table of documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
