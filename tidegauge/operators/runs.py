"""Runs and differences of ordered samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def differences(df: DataFrame, keys: list[str], order: str, value: str, name: str = "diff") -> DataFrame:
    """value less the value before it; NULL for the first of a key."""
    return df.withColumn(name, F.col(value) - F.lag(value).over(Window.partitionBy(*keys).orderBy(order)))


def islands(df: DataFrame, keys: list[str], order: str, value: Column) -> DataFrame:
    """One row for each run of equal values: keys, value, run_start, run_length."""
    w = Window.partitionBy(*keys).orderBy(order)
    marked = df.withColumn("_value", value).withColumn(
        "_new",
        (~F.col("_value").eqNullSafe(F.lag("_value").over(w)) | (F.row_number().over(w) == 1)).cast("int"),
    )
    marked = marked.withColumn("_island", F.sum("_new").over(w))
    return marked.groupBy(*keys, "_island").agg(
        F.first("_value").alias("value"),
        F.min(order).alias("run_start"),
        F.count(F.lit(1)).alias("run_length"),
    ).drop("_island")


def longest_run(df: DataFrame, keys: list[str], order: str, value: Column, name: str = "run_max") -> DataFrame:
    """Length of the longest run of equal values of each key."""
    return islands(df, keys, order, value).groupBy(*keys).agg(F.max("run_length").alias(name))


def longest_true_run(df: DataFrame, keys: list[str], order: str, condition: Column, name: str = "l_max") -> DataFrame:
    """Length of the longest run in which the condition holds; 0 if it never does."""
    own = islands(df, keys, order, F.coalesce(condition, F.lit(False)))
    return own.groupBy(*keys).agg(F.max(F.when(F.col("value"), F.col("run_length")).otherwise(0)).alias(name))


def run_stats(df: DataFrame, keys: list[str], order: str, value: Column, over: int = 10) -> DataFrame:
    """longest_run, its value (the first of the longest wins) and the number of runs longer than `over`."""
    own = islands(df, keys, order, value)
    return own.groupBy(*keys).agg(
        F.max("run_length").alias("longest_run"),
        F.max_by("value", F.struct("run_length", (-F.col("run_start")).alias("first"))).alias("longest_run_value"),
        F.sum((F.col("run_length") > over).cast("long")).alias(f"n_runs_over_{over}"),
    )
