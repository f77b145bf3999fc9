"""Assertions over tables and inventories; each is a table of findings, empty when all is well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import scalars as S


def missing_columns(df: DataFrame, expected: list[str]) -> list[str]:
    return [c for c in expected if c not in df.columns]



def difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of one side only, with the side's name."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def too_few(df: DataFrame, key: str, least: int) -> DataFrame:
    """One row if there are fewer than `least` distinct keys."""
    return df.agg(F.count_distinct(key).alias("found")).filter(F.col("found") < least).withColumn("least", F.lit(least))


def not_canonical(df: DataFrame, key: str = "entity_id") -> DataFrame:
    return df.filter(~F.coalesce(F.col(key).rlike(r"^e\d{2}$"), F.lit(False))).select(key).distinct()


def id_audit(ids: DataFrame, key: str, pattern: str = r"^p?(\d+)$", separator: str = "_", examples: int = 10) -> DataFrame:
    """Formats of the distinct ids: how many, and the first few."""
    form = S.id_format(F.col(key), pattern, separator)
    rows = ids.select(key).distinct().withColumn("format", form)
    # the first few of each format are kept by a bounded top-k, not by collecting the group
    from pyspark.sql import Window

    top = rows.withColumn("k", F.row_number().over(Window.partitionBy("format").orderBy(key))).filter(F.col("k") <= examples)
    first = top.groupBy("format").agg(F.array_join(F.array_sort(F.collect_list(key)), ",").alias("examples"))
    return rows.groupBy("format").agg(F.count(F.lit(1)).alias("n")).join(first, "format")


def resolved(rows: DataFrame, key: str, pattern: str = r"^p?(\d+)$", separator: str = "_") -> DataFrame:
    """Rows with source_entity_id and canonical entity_id; an id of a pair gives two rows, an unknown one a NULL."""
    return rows.withColumn("source_entity_id", F.col(key)).withColumn(
        "entity_id",
        F.explode_outer(S.resolve_id(F.col("source_entity_id"), pattern, separator)),
    )


def reconcile(manifest: DataFrame, inventory: DataFrame, key: str = "path", content: Column | None = None) -> DataFrame:
    """manifest (key, size, md5) against inventory (key, size, md5): the first check that fails.

    Multipart hashes (with a dash) aren't compared. `content` is a condition on the manifest's columns that faulty
    content fulfils; it is looked at last. A NULL condition is no fault.
    """
    inv = inventory.select(F.col(key).alias("_key"), F.col("size").alias("_size"), F.lower(F.regexp_replace("md5", '"', "")).alias("_md5"))
    rows = manifest.join(inv, F.col(key) == F.col("_key"), "left")
    outcome = (
        F.when(F.col("_key").isNull(), "missing")
        .when(F.col("_size") != F.col("size"), "size_mismatch")
        .when(~F.col("_md5").contains("-") & (F.col("_md5") != F.col("md5")), "hash_mismatch")
    )
    if content is not None:
        outcome = outcome.when(content, "content")
    return rows.select(key, outcome.otherwise("ok").alias("outcome"))


def faulty(outcomes: DataFrame, key: str = "path") -> DataFrame:
    """Keys of objects that are there and fail a check: what a clean-up would delete."""
    return outcomes.filter(~F.col("outcome").isin("ok", "missing")).select(key)


def to_upload(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """Manifest rows whose path and size the inventory doesn't have."""
    return manifest.join(inventory.select("path", "size"), ["path", "size"], "left_anti")


def upload_parts(manifest: DataFrame, inventory: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """path and part of each manifest row: skipped (already there in this size), failed (among the paths of `failed`) or uploaded."""
    there = inventory.select("path", "size").distinct().withColumn("_there", F.lit(True))
    rows = manifest.join(there, ["path", "size"], "left")
    if failed is None:
        rows = rows.withColumn("_failed", F.lit(False))
    else:
        rows = rows.join(failed.select("path").distinct().withColumn("_failed", F.lit(True)), "path", "left")
    return rows.select("path", F.when(F.col("_there"), "skipped").when(F.col("_failed"), "failed").otherwise("uploaded").alias("part"))


def raw_issues(files: DataFrame, rules: DataFrame) -> DataFrame:
    """files with the issues that the rule of their dataset and modality finds; files without a rule only must exist and not be empty.

    files: dataset, modality, name, length (NULL: not there), and what was read of them, NULL where it couldn't be:
    duration_s and rate of audio, readable of others. rules: dataset, modality, kind (audio, video, mat, csv, xlsx),
    extensions (array; empty: any), min_duration_s, max_duration_s, expected_rate, min_bytes. Hidden files and those with
    other extensions than the rule's aren't collected.
    """
    rows = files.join(rules, ["dataset", "modality"], "left")  # a rule for each dataset and modality
    ends = F.exists(F.transform("extensions", F.lower), lambda e: F.lower("name").endswith(e))
    rows = rows.filter(~F.col("name").startswith(".") & F.coalesce(ends | (F.size("extensions") == 0), F.lit(True)))
    audio, video = F.col("kind") == "audio", F.col("kind") == "video"
    closed = F.when(audio, F.col("duration_s").isNull()).when(F.col("kind").isin("mat", "csv", "xlsx"), ~F.coalesce("readable", F.lit(False)))
    rules_ = [
        ("cannot_open", closed),
        ("too_short", audio & (F.col("duration_s") < F.col("min_duration_s"))),
        ("too_long", audio & (F.col("duration_s") > F.col("max_duration_s"))),
        ("other_rate", audio & (F.col("rate") != F.col("expected_rate"))),
        ("too_small", video & (F.col("length") < F.col("min_bytes"))),
    ]
    return file_issues(rows, rules_).select(*files.columns, "issues")


def missing_folders(subjects: DataFrame, files: DataFrame, modalities: list[str], subject: str = "entity_id") -> DataFrame:
    """(subject, modality) without any file."""
    every = subjects.select(subject).distinct().withColumn("modality", F.explode(F.array(*[F.lit(m) for m in modalities])))
    return every.join(files.select(subject, "modality"), [subject, "modality"], "left_anti")


def prefix_findings(inventory: DataFrame, base: str, expected: list[str]) -> DataFrame:
    """Sub-prefixes of a base: `missing` expected ones without files, and `unknown` ones with files."""
    spark = inventory.sparkSession
    found = inventory.select(F.regexp_extract("path", f"^{base.rstrip('/')}/([^/]+)/", 1).alias("prefix")).filter("prefix <> ''").distinct()
    wanted = spark.createDataFrame([(e,) for e in expected], "prefix string")
    return wanted.join(found, "prefix", "left_anti").withColumn("finding", F.lit("missing")).unionByName(
        found.join(wanted, "prefix", "left_anti").withColumn("finding", F.lit("unknown")),
    )


def file_issues(files: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """files with `issues`: names of the rules that a file breaks; a missing or empty file breaks only that one."""
    broken = F.array_compact(
        F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules])
    ) if rules else F.array().cast("array<string>")
    return files.withColumn(
        "issues",
        F.when(F.col("length").isNull(), F.array(F.lit("missing"))).when(F.col("length") == 0, F.array(F.lit("zero_byte"))).otherwise(broken),
    )


def rollup(issues: DataFrame, keys: list[str]) -> DataFrame:
    """PASS or FAIL of each key with counts."""
    bad = F.sum((F.size("issues") > 0).cast("long"))
    return issues.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files"),
        bad.alias("with_issues"),
        F.when(bad > 0, "FAIL").otherwise("PASS").alias("status"),
    )


def outcome(uploaded: int, failed: int) -> tuple[str, int]:
    """PASS 0, PARTIAL 2 or FAIL 1."""
    return ("PASS", 0) if not failed else ("PARTIAL", 2) if uploaded else ("FAIL", 1)


def gate(findings: list[tuple[str, DataFrame]]) -> list[dict]:
    """Runs checks in order and stops at the first with findings; a report row for each that ran."""
    report = []
    for name, df in findings:
        failed = not df.isEmpty()
        report.append({"check": name, "status": "FAIL" if failed else "PASS"})
        if failed:
            break
    return report


def readable(df: DataFrame) -> bool:
    """Whether a first row, or the lack of one, can be read."""
    df.limit(1).collect()
    return True
