"""Aggregations: rates, percentiles, histograms, agreement tables, moments and transitions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators import runs


def bad_rate(flags: DataFrame, keys: list[str]) -> DataFrame:
    """Windows that aren't GOOD (a missing flag isn't) and their share."""
    bad = (~F.col("quality_flag").eqNullSafe(F.lit("GOOD"))).cast("long")
    return flags.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(bad).alias("bad"), F.avg(bad).alias("bad_rate"))


def macro_rate(flags: DataFrame, entity: str, channel: str) -> DataFrame:
    """Mean and population deviation over entities of each channel's rate."""
    each = bad_rate(flags, [entity, channel])
    return each.groupBy(channel).agg(
        F.avg("bad_rate").alias("mean_rate"),
        F.stddev_pop("bad_rate").alias("std_rate"),
        F.count(F.lit(1)).alias("n_entities"),
    )


#: Bins of a pass, and values that the driver may sort.
BINS, FEW = 4096, 10_000


def percentiles(df: DataFrame, value: str, at: tuple[float, ...] = (0.5, 0.75, 0.9, 0.95, 0.99)) -> DataFrame:
    """Exact percentiles with linear interpolation, one column each, of the values that aren't NULL or NaN.

    Each percentile is narrowed down by histograms: a pass counts the values of BINS bins and goes on between the
    smallest and largest value of the one that holds the wanted rank, until it has FEW values or just one. So neither
    the values nor a sort of them meets in one task; a pass returns a bin's counts only.
    """
    spark, own = df.sparkSession, df.select(F.col(value).cast("double").alias("v")).filter("v is not null and not isnan(v)")
    whole = own.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    found: dict[int, float] = {}

    def rank(k: int) -> float:
        """The k-th value, from 0."""
        lo, hi, below, n = whole.lo, whole.hi, 0, whole.n
        while lo < hi:
            inside = own.filter(F.col("v").between(lo, hi))
            if n <= FEW:
                return sorted(r[0] for r in inside.collect())[k - below]
            step = (hi - lo) / BINS
            bin_ = F.least(F.floor((F.col("v") - lo) / step), F.lit(BINS - 1)) if step > 0 else (F.col("v") > lo).cast("long")
            for r in inside.groupBy(bin_.alias("b")).agg(
                F.count(F.lit(1)).alias("n"),
                F.min("v").alias("lo"),
                F.max("v").alias("hi"),
            ).orderBy("b").collect():
                if below + r.n > k:
                    lo, hi, n = r.lo, r.hi, r.n
                    break
                below += r.n
        return lo

    def value_of(k: int) -> float:
        if k not in found:
            found[k] = rank(k)
        return found[k]

    out = []
    for p in at:
        if not whole.n:
            out.append(None)
            continue
        place = p * (whole.n - 1)
        low = math.floor(place)
        a, b = value_of(low), value_of(min(low + 1, whole.n - 1))
        out.append(a if a == b else (low + 1 - place) * a + (place - low) * b)
    return spark.createDataFrame([tuple(out)], ", ".join(f"p{round(x * 100)} double" for x in at))


def score_stats(samples: DataFrame, keys: list[str], order: str, value: str, jumps: tuple[int, ...] = (10, 20, 30, 40)) -> DataFrame:
    """Histogram of scores 0 to 100, longest run, runs over 10 and jumps of finite values."""
    edges = ((0, 0), (1, 20), (21, 40), (41, 60), (61, 80), (81, 99), (100, 100))
    x = F.col(value)
    rows = runs.differences(samples.filter(x.isNotNull() & ~F.isnan(x)), keys, order, value)
    own = rows.groupBy(*keys).agg(
        *[F.sum(x.between(a, b).cast("long")).alias(f"n_{a}" if a == b else f"n_{a}_{b}") for a, b in edges],
        *[F.coalesce(F.sum((F.abs("diff") > j).cast("long")), F.lit(0)).alias(f"jumps_over_{j}") for j in jumps],
    )
    return own.join(runs.run_stats(rows, keys, order, x), keys)


def confusion(pairs: DataFrame, truth: str, guess: str, classes: DataFrame) -> DataFrame:
    """Counts of every (truth, guess) of the classes (column `class`), zeros included."""
    n = pairs.groupBy(truth, guess).agg(F.count(F.lit(1)).alias("n"))
    # classes are few: the square is bounded by their number
    grid = classes.select(F.col("class").alias(truth)).crossJoin(classes.select(F.col("class").alias(guess)))
    return grid.join(n, [truth, guess], "left").select(truth, guess, F.coalesce("n", F.lit(0)).alias("n"))


def class_scores(table: DataFrame, truth: str, guess: str) -> DataFrame:
    """precision, recall and f1 of each class of a confusion table, 0 where undefined, to 4 places."""
    return raw_scores(table, truth, guess).withColumns({c: F.round(c, 4) for c in ("precision", "recall", "f1")})


def raw_scores(table: DataFrame, truth: str, guess: str) -> DataFrame:
    """class_scores before rounding."""
    hit = F.sum(F.when(F.col(truth) == F.col(guess), F.col("n")).otherwise(0))
    rows = table.groupBy(F.col(truth).alias("class")).agg(hit.alias("tp"), F.sum("n").alias("support"))
    columns = table.groupBy(F.col(guess).alias("class")).agg(F.sum("n").alias("predicted"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    own = rows.join(columns, "class").withColumn("p", ratio(F.col("tp"), F.col("predicted"))).withColumn("r", ratio(F.col("tp"), F.col("support")))
    f1 = F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0)
    return own.select(
        "class",
        "tp",
        "support",
        "predicted",
        F.col("p").alias("precision"),
        F.col("r").alias("recall"),
        f1.alias("f1"),
    )


def transitions(states: DataFrame, keys: list[str], order: str, state: str, classes: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """p(to | from) over the classes with additive smoothing."""
    pairs = states.withColumn("_to", F.lead(state).over(Window.partitionBy(*keys).orderBy(order))).filter("_to is not null")
    table = confusion(pairs.select(F.col(state).alias("from_state"), F.col("_to").alias("to_state")), "from_state", "to_state", classes)
    total = F.sum(F.col("n") + smoothing).over(Window.partitionBy("from_state"))
    return table.withColumn("p", (F.col("n") + smoothing) / total)


def priors(states: DataFrame, keys: list[str], order: str, state: str, classes: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """p(first state) over the classes with additive smoothing."""
    first = states.groupBy(*keys).agg(F.min_by(state, order).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    own = classes.join(first, "class", "left").select("class", F.coalesce("n", F.lit(0)).alias("n"))
    total = own.agg(F.sum(F.col("n") + smoothing).alias("total"))
    return own.crossJoin(F.broadcast(total)).select("class", "n", ((F.col("n") + smoothing) / F.col("total")).alias("p"))  # one row


def weighted_moments(vectors: DataFrame, keys: list[str], vector: str, weight: str, dims: int) -> DataFrame:
    """Weighted mean and covariance of each key, as rows (i, j, mean_i, mean_j, cov)."""
    x = F.transform(F.slice(F.col(vector), 1, dims), lambda v: v.cast("double"))
    i = F.explode(F.sequence(F.lit(0), F.lit(dims - 1)))
    rows = vectors.select(
        *keys,
        F.col(weight).cast("double").alias("w"),
        x.alias("x"),
    ).withColumn("i", i).withColumn("j", F.explode(F.sequence(F.col("i"), F.lit(dims - 1))))
    xi, xj, w = F.col("x")[F.col("i")], F.col("x")[F.col("j")], F.col("w")
    sums = rows.groupBy(*keys, "i", "j").agg(
        F.sum(w).alias("sw"),
        F.sum(w * xi).alias("si"),
        F.sum(w * xj).alias("sj"),
        F.sum(w * xi * xj).alias("sij"),
    )
    mi, mj = F.col("si") / F.col("sw"), F.col("sj") / F.col("sw")
    return sums.select(*keys, "i", "j", mi.alias("mean_i"), mj.alias("mean_j"), (F.col("sij") / F.col("sw") - mi * mj).alias("cov"))


def quality_rollup(df: DataFrame, key: str, value: str) -> DataFrame:
    """Statistics over all rows and for each key in one pass; the row over all has a NULL key."""
    return df.rollup(key).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.percentile(value, F.lit(0.5)).alias("median"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max")
    )


def majority_vote(df: DataFrame, keys: list[str], state: str, order: str) -> DataFrame:
    """The most frequent state of each key; of equal ones the first seen."""
    n = df.groupBy(*keys, state).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
    return n.groupBy(*keys).agg(F.max_by(state, F.struct("_n", (-F.col("_first")).alias("f"))).alias(state))


def split(df: DataFrame, keys: list[str], order: str, share: float) -> DataFrame:
    """Adds `part`: the last max(1, int(n * share)), at most n - 1, rows of each key by order are test."""
    w = Window.partitionBy(*keys)
    n = F.count(F.lit(1)).over(w)
    test = F.least(F.greatest(F.lit(1), F.floor(n * share)), n - 1)
    return df.withColumn("part", F.when(F.row_number().over(w.orderBy(order)) > n - test, "test").otherwise("train"))


def stratified_split(df: DataFrame, label: str, key: str, share: float, seed: int) -> DataFrame:
    """As `split` within each label, in an order by a hash of the seed and the key."""
    return split(df.withColumn("_order", F.xxhash64(F.lit(seed), F.col(key))), [label], "_order", share).drop("_order")


def spread(df: DataFrame, values: list[str], keys: list[str] | None = None) -> DataFrame:
    """mean, population deviation, smallest and largest of each value."""
    return df.groupBy(*(keys or [])).agg(
        *[f(v).alias(f"{v}_{n}") for v in values for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))]
    )


def rate_range(flags: DataFrame, keys: list[str]) -> DataFrame:
    """Smallest, median and largest share (in per cent, to 2 places) of windows that aren't GOOD over the keys, and their number."""
    each = bad_rate(flags, keys).select(F.round(F.col("bad_rate") * 100, 2).alias("_r"))
    return each.agg(
        F.min("_r").alias("min_rate"),
        F.percentile("_r", F.lit(0.5)).alias("median_rate"),
        F.max("_r").alias("max_rate"),
        F.count(F.lit(1)).alias("n"),
    )


def eeg_report(flags: DataFrame, entity: str = "entity_id", channel: str = "channel") -> dict[str, DataFrame]:
    """Of EEG flags: percentiles of rNSR and of its z-score, shares of windows that aren't GOOD by entity and, averaged over entities, by channel."""
    numbers = lambda c, places: percentiles(flags.filter(F.col(c).isNotNull() & ~F.isnan(c)), c).select(*[F.round(f"p{p}", places).alias(f"p{p}") for p in (50, 75, 90, 95, 99)])
    each = bad_rate(flags, [entity]).select(
        entity,
        F.col("n").alias("total_windows"),
        F.col("bad").alias("non_good_windows"),
        F.round(F.col("bad_rate") * 100, 2).alias("bad_rate_pct"),
    )
    macro = macro_rate(flags, entity, channel).select(
        channel,
        "n_entities",
        F.round(F.col("mean_rate") * 100, 2).alias("bad_rate_pct"),
        F.round(F.col("std_rate") * 100, 2).alias("bad_rate_std"),
    )
    return {"rNSR": numbers("rNSR", 6), "rNSR_zscore": numbers("rNSR_zscore", 4), "entities": each, "channels": macro}


def condition_count(condition: Column, name: str) -> Column:
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0)).alias(name)
