"""Connected components of a graph held as a table of links, by alternating large-star and small-star rounds.

Every round is one aggregation and one join for each star; the smallest neighbours and the links are written
to the shared folder in between, so that both sides of a join are shuffled for it alone and adaptive execution
can split the rows of a node with many links. Nothing but two numbers a round (count and checksum) reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import common


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = common.saved(least, "least")
    return both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = common.saved(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of links (a, b); root is the smallest node reachable, its own row included."""
    now = common.saved(links.select("a", "b").filter("a <> b").distinct(), "links")
    sign = None
    while True:
        now = common.saved(_small_star(common.saved(_large_star(now).distinct(), "links")).distinct(), "links")
        last, sign = sign, tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if sign == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())
