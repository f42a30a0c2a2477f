"""Training corpus from the documents: clean, deduplicate, mask, mix and tokenize.

Each stage gets the documents that the stage before kept and returns documents with the
same columns; the last one adds ``piece_ids``. Columns may have any other names and types.
Null and empty texts go in the first stage. Rows without an id are never linked with
others and stay; rows that share an id are one document and stay or go together. Empty tables
give empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import minhash, mixing, pii, piece_fst, quality_rules
from tallyhouse.session import write_through


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8), that of the smallest id."""
    return minhash.drop_near_duplicates(docs, width=5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and the terms that disclose it replaced by marks."""
    return pii.sanitised(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, 0 to 2 times; null sources are one source."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the SentencePiece ids of their texts."""
    return piece_fst.with_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix", mix),
    ("tokenize", tokenize),
]

# Compression, signatures and transducers can't be said in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = write_through(docs)
    return docs
