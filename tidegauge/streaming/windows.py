"""Tumbling quality windows over a stream of samples: beyond the batch operators, with the same metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import flags as R


def tumbling_stats(stream: DataFrame, keys: list[str], ts: str, value: str, width: str, late: str) -> DataFrame:
    """n, amplitude, mean and std of each window; rows later than `late` behind the newest are dropped."""
    own = stream.withWatermark(ts, late).groupBy(*keys, F.window(ts, width).alias("w"))
    out = own.agg(F.count(F.lit(1)).alias("n"), (F.max(value) - F.min(value)).alias("amplitude"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    return out.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "amplitude", "mean", "std")


def tumbling_flags(stream: DataFrame, keys: list[str], ts: str, value: str, width: str, late: str, expected: float, low: float, high: float) -> DataFrame:
    """Windows with completeness and amplitude rules."""
    own = tumbling_stats(stream, keys, ts, value, width, late).withColumn("completeness", F.least(F.lit(1.0), F.col("n") / F.lit(expected)))
    rules = [*R.at_least(F.col("completeness"), 0.95, 0.8), (F.col("amplitude") < low, "BAD", "FLAT"), (F.col("amplitude") > high, "BAD", "ARTIFACT")]
    return own.select("*", *R.flags(rules))


def sessions(stream: DataFrame, keys: list[str], ts: str, gap: str, late: str) -> DataFrame:
    """Session windows: samples less than `gap` apart."""
    own = stream.withWatermark(ts, late).groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return own.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
