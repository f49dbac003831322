"""Corpus pipeline: quality, exact and near duplicates, benchmark passages, packing.

Each stage takes all that its predecessor kept, written as Parquet and read
again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import decontaminate, exact_dedup, jaccard_join, packing, quality
from arrears.llm.tables import written

TOKENIZER = "word_bpe_49k.json"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, learnt from the labels outside its held-out fifth."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    return quality.keep_good(docs, labels.where(fold != 0))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts, the one with the longest text."""
    return exact_dedup.drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by similarity, the one with the smallest id."""
    return jaccard_join.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, with their ids, and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontaminate", without_benchmark),
    ("packing", packed),
]

#: SQL cannot express the classifier and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
