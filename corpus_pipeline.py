"""From raw documents to packed training sequences: five stages, each by one operator of tidegauge.llm.

Every stage takes (spark, docs, sf_dir), where docs are what its predecessor kept, and returns a
DataFrame. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import common, exact_dedup, packing, pii, quality, simhash
from tidegauge.llm.queries import path_of, tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose posterior of being good is below one half."""
    return quality.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.col("source"), path_of())


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each text (white space aside)."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near copies: sets of five-word shingles with a similarity of 0.8 or more."""
    return simhash.drop_near_copies(docs, words=5, similarity=0.8)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by marks; every document stays."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: No SQL: the classifier, the fingerprints, the tagger and the packing have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.saved(stage(spark, docs, sf_dir), name)
    return docs
