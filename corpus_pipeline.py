"""The corpus pipeline: stages that turn raw documents into packed training sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postlens.llm import decontaminate, langid, lines, near, packing
from postlens.session import fresh_folder


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is decided; the others go."""
    return langid.with_language(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; ``n_chars`` follows the text."""
    return lines.without_shared_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest ``doc_id``.

    SimHash fingerprints and pivot tables propose copies, 5-word similarity 0.8 decides, and shared
    shingles find the copies whose fingerprints are farther apart.
    """
    return near.without_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences that hold all tokens of the documents left."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language id", keep_known_languages),
    ("line dedup", dedup_lines),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]
# Context trees, fingerprint components and tokenizer ids have no SQL form; tests/llm compares
# the pipeline with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written below the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = fresh_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
