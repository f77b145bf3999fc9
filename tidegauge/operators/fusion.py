"""Flags and labels of several modalities brought together by window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import flags as R
from tidegauge.functions.scalars import trial_window_key
from tidegauge.operators import asof


def fuse(flags: DataFrame, keys: list[str], modalities: list[str]) -> DataFrame:
    """Long flags (keys, modality, quality_flag) -> one `<modality>_flag` column each; one shuffle replaces N outer joins.

    Of several rows for one key and modality the worst flag counts; flags outside the lattice come before GOOD.
    """
    rank = F.coalesce(F.array_position(F.array(*[F.lit(q) for q in R.QUALITIES]), F.col("quality_flag")), F.lit(0))
    worst = lambda m: F.max_by("quality_flag", F.when((F.col("modality") == m) & F.col("quality_flag").isNotNull(), rank))
    return flags.groupBy(*keys).agg(*[worst(m).alias(f"{m}_flag") for m in modalities])


def channel_majority(flags: DataFrame, keys: list[str]) -> DataFrame:
    """One flag for each key by the majority of its channels' valid flags."""
    q = F.col("quality_flag")
    n = flags.groupBy(*keys).agg(
        F.sum((q == "BAD").cast("long")).alias("b"),
        F.sum((q == "NOISY").cast("long")).alias("m"),
        F.count(F.when(q.isin(*R.QUALITIES), 1)).alias("n"),
    )
    return n.select(*keys, R.majority(F.coalesce("b", F.lit(0)), F.coalesce("m", F.lit(0)), F.col("n")).alias("quality_flag"))


def trial_report(flags: DataFrame, emotions: DataFrame, modalities: list[str]) -> DataFrame:
    """Trial data: flags (entity_id, trial_id, window_id, modality, quality_flag), emotions (entity_id, trial_id, emotion)."""
    wide = fuse(flags, ["entity_id", "trial_id", "window_id"], modalities).join(emotions, ["entity_id", "trial_id"], "left")
    return wide.select(
        "entity_id",
        trial_window_key(F.col("trial_id"), F.col("window_id")).alias("window_id"),
        *[f"{m}_flag" for m in modalities],
        F.col("emotion").alias("window_emotion"),
    )


def session_report(flags: DataFrame, labels: DataFrame, modalities: list[str], width_s: float) -> DataFrame:
    """Session data: the label in force at each window's middle; start and end come from the window id."""
    wide = fuse(flags, ["entity_id", "window_id"], modalities).withColumn(
        "window_start_s",
        F.col("window_id") * width_s,
    ).withColumn("mid_s", (F.col("window_id") + 0.5) * width_s)
    out = asof.backward(wide, labels, ["entity_id"], "mid_s", "seconds", "emotion", "window_emotion")
    return out.select(
        "entity_id",
        "window_id",
        "window_start_s",
        (F.col("window_start_s") + width_s).alias("window_end_s"),
        *[f"{m}_flag" for m in modalities],
        "window_emotion",
    )


def with_trial_label(features: DataFrame, report: DataFrame, trial_shift: int = 0, window_shift: int = -1) -> DataFrame:
    """Features (entity_id, trial_id, window_id) with the report's window_emotion by the composite key of trial and window.

    Features count windows from 1, the report from 0; `trial_shift` is 1 for signals that count trials from 0. Windows
    without a report row or label go.
    """
    key = trial_window_key((F.col("trial_id") + trial_shift).cast("int"), (F.col("window_id") + window_shift).cast("int"))
    labels = report.select("entity_id", F.col("window_id").alias("_key"), "window_emotion").filter("window_emotion is not null")
    return features.withColumn("_key", key).join(labels, ["entity_id", "_key"]).drop("_key")


def with_quality(features: DataFrame, quality: DataFrame, keys: list[str], flag: str, score: Column) -> DataFrame:
    """Features joined to quality by the second in which a window starts, with the flag's score."""
    at = F.floor("window_start_s").cast("long")
    own = quality.select(*keys, F.floor("window_start_s").cast("long").alias("_at"), F.col(flag).alias("_flag"), "window_emotion")
    return features.withColumn("_at", at).join(own, [*keys, "_at"], "left").withColumn("quality", score).drop("_at", "_flag")


def nearest_label(features: DataFrame, labels: DataFrame) -> DataFrame:
    """The label whose window starts nearest to a feature window's start."""
    return asof.nearest(features, labels, ["entity_id"], "window_start_s", "window_start_s", "window_emotion", "window_emotion_near")


def in_all(rows: DataFrame, key: str, source: str) -> DataFrame:
    """Keys that every source has."""
    n = rows.select(source).distinct().count()
    return rows.groupBy(key).agg(F.count_distinct(source).alias("n")).filter(F.col("n") == n).select(key)
