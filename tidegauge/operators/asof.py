"""As-of joins: one union, one sort within each key and a carried value, never a product of both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _merged(left: DataFrame, right: DataFrame, keys: list[str], time: str, right_time: str, value: str) -> DataFrame:
    a = left.select(
        F.struct("*").alias("_row"),
        *keys,
        F.col(time).alias("_t"),
        F.lit(None).cast(right.schema[value].dataType).alias("_v"),
        F.lit(None).cast(right.schema[right_time].dataType).alias("_vt"),
    )
    b = right.filter(F.col(value).isNotNull()).select(
        F.lit(None).cast(a.schema["_row"].dataType).alias("_row"),
        *keys,
        F.col(right_time).alias("_t"),
        F.col(value).alias("_v"),
        F.col(right_time).alias("_vt"),
    )
    return a.unionByName(b)


def backward(left: DataFrame, right: DataFrame, keys: list[str], time: str, right_time: str, value: str, name: str) -> DataFrame:
    """left with `name`: the value of the last right row of the key at or before the time."""
    w = Window.partitionBy(*keys).orderBy("_t", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    out = _merged(left, right, keys, time, right_time, value).withColumn(name, F.last("_v", ignorenulls=True).over(w))
    return out.filter("_row is not null").select("_row.*", name)


def nearest(left: DataFrame, right: DataFrame, keys: list[str], time: str, right_time: str, value: str, name: str) -> DataFrame:
    """left with `name`: the value of the right row of the key nearest in time; a tie goes to the earlier one."""
    back = Window.partitionBy(*keys).orderBy("_t", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy("_t", F.col("_row").isNull()).rowsBetween(0, Window.unboundedFollowing)
    out = _merged(left, right, keys, time, right_time, value)
    carried = F.when(F.col("_v").isNotNull(), F.struct("_v", "_vt"))
    out = out.withColumn("_b", F.last(carried, ignorenulls=True).over(back)).withColumn("_a", F.first(carried, ignorenulls=True).over(ahead))
    before, after = F.col("_t") - F.col("_b._vt"), F.col("_a._vt") - F.col("_t")
    pick = F.when(after.isNull() | (before <= after), F.col("_b._v")).otherwise(F.col("_a._v"))
    return out.filter("_row is not null").withColumn(name, pick).select("_row.*", name)
