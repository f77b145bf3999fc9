"""One query for each operator, over its whole table with production parameters, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import common, exact_dedup, fingerprints, langid, lmscore, packing, pii, quality, sentencepieces, simhash, tokencounts


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(common.documents(spark, sf_dir))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(common.documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokencounts.count(common.documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def path_of() -> Column:
    """The path level below a source: its part in one language."""
    return F.concat_ws("/", F.col("source"), F.col("lang"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), F.col("source"), path_of())


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(common.documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(common.documents(spark, sf_dir), common.crc_mod(F.col("doc_id"), 7) != 2)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(common.documents(spark, sf_dir), common.crc_mod(F.col("doc_id"), 4) != 2)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(common.documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"), digest=True)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(common.documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_fingerprints,
        op2_pii,
        op3_token_counts,
        op4_quality,
        op5_best_fit_packing,
        op6_lm_scoring,
        op7_language_id,
        op8_sentencepiece,
        op9_simhash,
        op10_exact_dedup,
    )
}

SQL: dict[str, str] = {
    "op10_exact_dedup": """
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS n,
                 regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
          FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)""",
}
