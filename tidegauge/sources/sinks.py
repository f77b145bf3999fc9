"""Writers of tables and reports."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_parquet(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def append(df: DataFrame, path: str, *by: str, fmt: str = "parquet") -> None:
    """Appends metadata rows with the time of ingest, by the given columns."""
    own = df if "ingest_ts" in df.columns else df.withColumn("ingest_ts", F.current_timestamp())
    own.write.format(fmt).mode("append").partitionBy(*by).save(path)


def route(manifest: DataFrame, files_path: str, aux_path: str, fmt: str = "parquet") -> None:
    """Manifest rows into the two metadata tables, with one time of ingest for all."""
    now = F.lit(datetime.now(UTC))
    times = [now.alias("ingestion_time"), now.alias("ingest_ts")]
    files = manifest.filter("table = 'files'").select(
        F.expr("uuid()").alias("file_id"),
        "dataset",
        "entity_id",
        "modality",
        F.col("s3_path").alias("file_path"),
        "file_name",
        *times,
    )
    aux = manifest.filter("table = 'aux'").select(
        F.expr("uuid()").alias("record_id"), "dataset", F.col("modality").alias("category"), F.col("s3_path").alias("source_path"), "file_name", F.col("entity_id").alias("related_entity"), *times
    )
    append(files, files_path, "entity_id", "modality", fmt=fmt)
    append(aux, aux_path, "dataset", "category", fmt=fmt)


def overwrite_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replaces only the partitions that df has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def by_participant(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").partitionBy("dataset", "participant_id").csv(path)


def report(findings: DataFrame, path: str, stage: str, status: str) -> str:
    """One JSON document {stage, status, findings: [...]} in a file below `<stage>_<status>_<time>`; returns the path.

    Findings are those of a validation: a report is small.
    """
    place = f"{path.rstrip('/')}/{stage}_{status}_{datetime.now(UTC):%Y%m%dT%H%M%S}"
    own = findings.agg(F.collect_list(F.struct("*")).alias("findings"))
    own.select(
        F.to_json(F.struct(F.lit(stage).alias("stage"), F.lit(status).alias("status"), "findings")).alias("value"),
    ).coalesce(1).write.mode("overwrite").text(place)
    return place
