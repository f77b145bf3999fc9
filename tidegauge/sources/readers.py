"""Readers: every table has a declared schema, and a table that isn't there reads as empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidegauge.functions.scalars import path_part

SCALAR = "timestamp bigint, value double"
AXES = "timestamp bigint, x double, y double, z double"
BANDS = ("delta", "lowAlpha", "highAlpha", "lowBeta", "highBeta", "lowGamma", "middleGamma", "theta")
POWERS = "timestamp bigint, " + ", ".join(f"{b} double" for b in BANDS)
SUBJECTS = "pid int, startTime bigint, endTime bigint"
FILES = "file_id string, dataset string, entity_id string, modality string, file_path string, file_name string, ingestion_time timestamp, ingest_ts timestamp"
AUX = "record_id string, dataset string, category string, source_path string, file_name string, related_entity string, ingestion_time timestamp, ingest_ts timestamp"


def table(spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet", **options: str) -> DataFrame:
    """A table, or an empty one of the schema if the path doesn't exist; without a schema that is an error."""
    reader = spark.read.format(fmt).options(**options)
    try:
        return (reader.schema(schema) if schema else reader).load(path)
    except AnalysisException as e:
        if schema and "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return table(spark, path, schema, "csv", header="true", mode="PERMISSIVE")


def inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, length, modificationTime of files, with entity and modality of their path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select(
        "path",
        "length",
        "modificationTime",
        path_part(F.col("path"), "entity").alias("entity_id"),
        path_part(F.col("path"), "modality").alias("modality"),
    )


def entities(files: DataFrame) -> DataFrame:
    return files.select("entity_id").filter("entity_id is not null").distinct()


def top_folders(files: DataFrame, root: str) -> DataFrame:
    """First path segment below a root."""
    return files.select(F.regexp_extract("path", f"{root.rstrip('/')}/([^/]+)/", 1).alias("entity_id")).filter("entity_id <> ''").distinct()


def signal(
    rows: DataFrame,
    keys: list[str],
    values: list[str],
    time: str = "timestamp",
    unit_per_s: float = 1000.0,
    start: Column | None = None,
) -> DataFrame:
    """Raw rows -> keys, t (microseconds since `start`, in seconds, or since the first time), t_s (the same in seconds), values.

    Text becomes numbers or NULL; rows without a time go.
    """
    ts = F.col(time).try_cast("double")
    own = rows.withColumn("_ts", ts / unit_per_s).withColumn("_line", F.monotonically_increasing_id()).filter("_ts is not null and not isnan(_ts)")
    first = start if start is not None else F.first("_ts").over(Window.partitionBy(*keys).orderBy("_line"))
    rel = F.col("_ts") - first
    return own.select(
        *keys,
        F.round(rel * 1_000_000).cast("long").alias("t"),
        rel.alias("t_s"),
        *[F.col(v).try_cast("double").alias(v) for v in values],
    )


def signal_files(
    spark: SparkSession,
    root: str,
    name: str,
    values: list[str],
    sessions: DataFrame,
    unit_per_s: float = 1000.0,
    time: str = "timestamp",
) -> DataFrame:
    """All CSV files of a name below a root, entity=... in their path -> entity_id, t, t_s since the session's start, values.

    sessions: entity_id, session_start_s. Entities without a session go; files without one of the columns give no rows.
    """
    columns = [time, *values]
    # a file whose header lacks a column, or has the columns in another order, is read by its own header's names
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name).text(root)
    raw = raw.select(path_part(F.col("_metadata.file_path"), "entity").alias("entity_id"), F.col("_metadata.file_path").alias("_file"), "value")
    raw = raw.withColumn(
        "_cells",
        F.transform(F.split(F.regexp_replace("value", "\r$", ""), ","), lambda x: F.trim(F.regexp_replace(x, '^\\s*"|"\\s*$', ""))),
    )
    header = raw.filter(F.array_contains("_cells", time)).groupBy("_file").agg(F.first("_cells").alias("_names"))
    rows = raw.join(header, "_file").filter("_cells <> _names")
    at = {c: F.array_position("_names", c).cast("int") for c in columns}
    for c in columns:
        rows = rows.filter(at[c] > 0)
    rows = rows.select(
        "entity_id",
        *[F.try_element_at("_cells", at[c]).alias(c) for c in columns],
    ).join(sessions.select("entity_id", "session_start_s"), "entity_id")
    return signal(rows, ["entity_id"], values, time, unit_per_s, F.col("session_start_s"))


def regular(samples: DataFrame, keys: list[str], t: str = "t") -> DataFrame:
    """Adds idx (from 0, in time order) and the rate inferred from the median positive step (1 without one)."""
    w = Window.partitionBy(*keys).orderBy(t)
    own = samples.filter(F.col(t).isNotNull()).withColumn("idx", F.row_number().over(w) - 1).withColumn("_step", F.col(t) - F.lag(t).over(w))
    rate = own.groupBy(*keys).agg(F.coalesce(1 / F.percentile(F.when(F.col("_step") > 0, F.col("_step")), F.lit(0.5)), F.lit(1.0)).alias("rate"))
    return own.drop("_step").join(rate, keys)


def subjects(spark: SparkSession, path: str) -> DataFrame:
    own = csv(spark, path, SUBJECTS)
    return own.select(
        F.format_string("e%02d", "pid").alias("entity_id"),
        (F.col("startTime") / 1000).alias("session_start_s"),
        (F.col("endTime") / 1000).alias("session_end_s"),
    )


def annotation_files(files: DataFrame) -> DataFrame:
    """Annotation files by participant: one path column for each of self, partner and external."""
    rater = F.regexp_extract("path", r"(self|partner|external)", 1)
    number = F.regexp_extract("path", r"P(\d+)", 1).try_cast("int")
    rows = files.select(F.format_string("e%02d", number).alias("entity_id"), rater.alias("rater"), "path").filter("rater <> ''")
    return rows.groupBy("entity_id").pivot("rater", ["self", "partner", "external"]).agg(F.min("path"))


def flat_names(df: DataFrame) -> DataFrame:
    """Column names without the quotes and parentheses that tuple-like names leave."""
    import re

    return df.toDF(*[re.sub(r"[()'\", ]+", "_", c).strip("_") for c in df.columns])


def feature_columns(df: DataFrame, meta: set[str]) -> list[str]:
    from pyspark.sql.types import NumericType

    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in meta]
