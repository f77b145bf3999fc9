"""Features of windows. Moments, slopes and intervals are SQL; peaks, spectra and entropy are Arrow functions of one window.

Samples are rows with keys and window_id (from timewin), t in seconds, idx and value.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators import kernels, timewin


def moments(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Mean and sample deviation of each value (acceleration axes, temperatures)."""
    return rows.groupBy(*keys).agg(*[f(v).alias(f"{v}_{n}") for v in values for n, f in (("mean", F.avg), ("std", F.stddev_samp))])


def trend(rows: DataFrame, keys: list[str], rate: float, value: str = "value", index: str = "idx") -> DataFrame:
    """Mean, sample deviation and slope per second of a regular signal."""
    return rows.groupBy(*keys).agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.regr_slope(F.col(value), F.col(index) / rate).alias("slope"),
    )


def heart_rate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of positive rates: mean, deviation, and deviation of the intervals 60000 / rate."""
    own = rows.filter("value > 0").withColumn("nn", 60000 / F.col("value"))
    return own.groupBy(*keys).agg(F.avg("value").alias("hr_mean"), F.stddev_samp("value").alias("hr_std"), F.stddev_samp("nn").alias("nn_std"))


def variability(rows: DataFrame, keys: list[str], order: str = "t", value: str = "value") -> DataFrame:
    """SDNN, RMSSD and pNN50 of intervals in milliseconds."""
    d = rows.withColumn("_d", F.col(value) - F.lag(value).over(Window.partitionBy(*keys).orderBy(order)))
    return d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp(value).alias("sdnn"), F.sqrt(F.avg(F.col("_d") * F.col("_d"))).alias("rmssd"), F.avg((F.abs("_d") > 50).cast("double")).alias("pnn50")
    )


def interval_features(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Beat intervals: variability and robust spread (median, MAD, 20th percentile)."""
    mid = rows.groupBy(*keys).agg(F.percentile("value", F.lit(0.5)).alias("median"), F.percentile("value", F.lit(0.2)).alias("p20"))
    mad = rows.join(mid, keys).groupBy(*keys).agg(F.percentile(F.abs(F.col("value") - F.col("median")), F.lit(0.5)).alias("mad"))
    return variability(rows, keys).join(mid, keys).join(mad, keys)


def hjorth(rows: DataFrame, keys: list[str], order: str, value: str = "value") -> DataFrame:
    """Mobility and complexity from population variances of the signal and its differences."""
    w = Window.partitionBy(*keys).orderBy(order)
    d1 = F.col(value) - F.lag(value).over(w)
    own = rows.withColumn("_d", d1)
    own = own.withColumn("_dd", F.col("_d") - F.lag("_d").over(w))
    v, dv, ddv = F.var_pop(value), F.var_pop("_d"), F.var_pop("_dd")
    m = F.sqrt(F.when(v > 0, dv / v))
    return own.groupBy(*keys).agg(m.alias("mobility"), (F.sqrt(F.when(dv > 0, ddv / dv)) / F.nullif(m, F.lit(0.0))).alias("complexity"))


#: Windows of a key that are handed to Python together.
TOGETHER = 256


def per_window(
    rows: DataFrame,
    keys: list[str],
    order: str,
    names: list[str],
    kernel: Callable[[np.ndarray], dict[str, float]],
    value: str = "value",
) -> DataFrame:
    """kernel of the ordered samples of each window (keys, window_id among them).

    A call of Python gets TOGETHER neighbouring windows of a key, each bounded by its width and rate.
    """
    schema = rows.select(*keys).schema
    for n in names:
        schema = schema.add(n, "double")

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["window_id", order], kind="stable")
        ids, x = block["window_id"].to_numpy(), block[value].to_numpy(np.float64)
        first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        found = [kernel(own) for own in np.split(x, first[1:])]
        return pd.DataFrame({**{k: block[k].to_numpy()[first] for k in keys}, **{n: [f.get(n, np.nan) for f in found] for n in names}})

    blocks = [*[k for k in keys if k != "window_id"], timewin.whole(F.col("window_id"), TOGETHER).alias("_block")]
    return rows.select(*keys, order, value).groupBy(*blocks).applyInPandas(run, schema)


def pulse(rows: DataFrame, keys: list[str], rate: float, order: str = "idx") -> DataFrame:
    names = ["n_peaks", "peak_amplitude", "rise_time_s", "sdnn_ms", "rmssd_ms", "pnn50"]
    return per_window(rows, keys, order, names, lambda x: kernels.pulse_features(x, rate))


def skin(rows: DataFrame, keys: list[str], rate: float, order: str = "idx") -> DataFrame:
    responses = per_window(rows, keys, order, ["scr_count", "scr_amplitude"], lambda x: kernels.response_features(x, rate))
    return trend(rows, keys, rate, index=order).join(responses, keys)


def spectra(rows: DataFrame, keys: list[str], rate: float, order: str = "idx") -> DataFrame:
    """Band powers, Hjorth parameters and approximate entropy."""
    bands = [f"power_{a:g}_{b:g}" for a, b in kernels.BANDS]

    def kernel(x: np.ndarray) -> dict[str, float]:
        mobility, complexity = kernels.hjorth(x)
        return {
            **dict(zip(bands, kernels.band_powers(x, rate), strict=True)),
            "mobility": mobility,
            "complexity": complexity,
            "entropy": kernels.approximate_entropy(x),
        }

    return per_window(rows, keys, order, [*bands, "mobility", "complexity", "entropy"], kernel)


def noise(rows: DataFrame, keys: list[str], rate: float, order: str = "t") -> DataFrame:
    return per_window(rows, keys, order, ["rNSR"], lambda x: {"rNSR": kernels.noise_ratio(x, rate)})


def second_means(rows: DataFrame, keys: list[str], values: list[str], width_s: float, count: Column) -> DataFrame:
    """Means of each second, given to the windows whose middle lies in it."""
    each = rows.withColumn("_s", F.floor("t").cast("long")).groupBy(*keys, "_s").agg(*[F.avg(v).alias(v) for v in values])
    windows = timewin.spine(rows.select(*keys).distinct(), count, 1)
    middle = F.floor((F.col("window_id") - 0.5) * width_s).cast("long")
    return windows.withColumn("_s", middle).join(each, [*keys, "_s"], "left").drop("_s")


def scalar_means(rows: DataFrame, keys: list[str], step_us: int, look_us: int, count: int, t_us: str = "t_us") -> DataFrame:
    """Mean of forward windows; empty ones have no row."""
    return timewin.forward(rows, F.col(t_us), step_us, look_us, count).groupBy(*keys, "window_id").agg(F.avg("value").alias("mean"))


def face_means(frames: DataFrame, keys: list[str], values: list[str], width_s: float) -> DataFrame:
    """Means of frames with success = 1 in windows int(t / w) + 1; the range of ids comes from all frames."""
    rows = frames.withColumn("window_id", (F.col("timestamp") / width_s).cast("long") + 1)
    ends = rows.groupBy(*keys).agg(F.min("window_id").alias("a"), F.max("window_id").alias("b"))
    dense = ends.select(*keys, F.explode(F.sequence("a", "b")).alias("window_id"))
    own = rows.filter("success = 1").groupBy(*keys, "window_id").agg(*[F.avg(v).alias(v) for v in values])
    return dense.join(own, [*keys, "window_id"], "left")


def session_slice(rows: DataFrame, keys: list[str], sessions: DataFrame, rate: float) -> DataFrame:
    """Samples of a regular grid that lie in the session by index: round((start - t0) * rate) on."""
    t0 = rows.groupBy(*keys).agg(F.min("t").alias("_t0"))
    own = rows.join(t0, keys).join(sessions, keys)
    a = F.bround((F.col("session_start_s") - F.col("_t0")) * rate).cast("long")
    b = F.bround((F.col("session_end_s") - F.col("_t0")) * rate).cast("long")
    return own.filter((F.col("idx") >= a) & (F.col("idx") < b)).withColumn(
        "idx",
        F.col("idx") - F.greatest(a, F.lit(0)),
    ).drop("_t0", "session_start_s", "session_end_s")


def external(files: DataFrame, extractor: Callable, schema: str) -> DataFrame:
    """Hook for extractors outside this library: a function of pandas batches of (path, content)."""
    return files.select("path", "content").mapInPandas(extractor, schema)
