"""Assignment of samples to time windows, in integer microseconds so that edges are exact.

Every window is half-open. Tumbling windows have width w; lookback windows end where a tumbling one ends
and reach L back; forward windows start at each step and reach L ahead. A sample that lies in several
windows is exploded into them, which costs L / w rows a sample and no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = 86_400_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def relative(ts: Column, start: str) -> Column:
    """Microseconds since a point in time."""
    return micros(ts) - F.unix_micros(F.lit(start).cast("timestamp"))



def whole(a: Column, b: int | Column) -> Column:
    """floor(a / b) of integers, exactly."""
    b = b if isinstance(b, Column) else F.lit(b)
    return ((a - F.pmod(a, b)) / b).cast("long")


def tumbling(df: DataFrame, t: Column, width: int, count: int | None = None, base: int = 0) -> DataFrame:
    """Adds window_id = floor(t / width) + base; rows outside [0, count) go."""
    out = df.withColumn("window_id", whole(t, width) + base)
    out = out.filter(F.col("window_id") >= base)
    return out if count is None else out.filter(F.col("window_id") < count + base)


def lookback(df: DataFrame, t: Column, width: int, look: int, count: int, base: int = 0, whole_only: bool = False) -> DataFrame:
    """Window k covers [(k + 1) * width - look, (k + 1) * width), samples before 0 included.

    whole_only: without the windows that reach before 0.
    """
    first = F.greatest(whole(t, width), F.lit((look - 1) // width if whole_only else 0))
    last = F.least(whole(t + look, width) - 1, F.lit(count - 1))
    out = df.withColumn("_first", first).withColumn("_last", last).filter("_first <= _last")
    return out.withColumn("_k", F.explode(F.sequence("_first", "_last"))).withColumn("window_id", F.col("_k") + base).drop("_first", "_last", "_k")


def forward(df: DataFrame, t: Column, step: int, look: int, count: int, base: int = 1) -> DataFrame:
    """Window k covers [k * step, k * step + look); ids from `base`, empty windows have no rows."""
    first = F.greatest(whole(t - look, step) + 1, F.lit(0))
    last = F.least(whole(t, step), F.lit(count - 1))
    out = df.withColumn("_first", first).withColumn("_last", last).filter("_first <= _last")
    return out.withColumn("_k", F.explode(F.sequence("_first", "_last"))).withColumn("window_id", F.col("_k") + base).drop("_first", "_last", "_k")


def by_count(df: DataFrame, keys: list[str], index: Column, size: int | Column) -> DataFrame:
    """window_id = floor(index / size) of regular samples; an incomplete last window goes."""
    from pyspark.sql import Window

    out = df.withColumn("window_id", whole(index, size)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return out.filter((F.col("window_id") + 1) * size <= F.col("_n")).drop("_n")


def spine(entities: DataFrame, count: int | Column, base: int = 0) -> DataFrame:
    """Every entity with every window id, so that empty windows have rows."""
    last = (F.lit(count) if isinstance(count, int) else count) - 1
    return entities.withColumn(
        "_k",
        F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))),
    ).withColumn("window_id", F.col("_k") + base).drop("_k")


def expected_windows(duration_s: Column, width_s: float) -> Column:
    return F.floor(duration_s / width_s + 1e-9)


def trim(flags: DataFrame, expected: Column) -> DataFrame:
    """Rows of windows beyond the expected number go."""
    return flags.filter(F.col("window_id") < expected)


def count_check(flags: DataFrame, keys: list[str], expected: Column) -> DataFrame:
    """Windows found against windows expected: ok, trimmed (too many) or too_few."""
    found = flags.groupBy(*keys).agg(F.count_distinct("window_id").alias("n_windows"), F.max(expected).alias("expected"))
    return found.withColumn(
        "outcome",
        F.when(F.col("n_windows") == F.col("expected"), "ok").when(F.col("n_windows") > F.col("expected"), "trimmed").otherwise("too_few"),
    )
