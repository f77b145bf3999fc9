"""Queries of the operators over the shared tables, and the SQL that states what they return.

Roles: a user of `events` is an entity, its values are samples of a signal over 30 days, windows are days
and lookbacks are 3 or 7 days. Thresholds are scaled to these values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import flags as R
from tidegauge.functions import scalars as S
from tidegauge.operators import annotate, asof, audit, checks, features, fusion, ml, quality, runs, stats, timewin

DAY, DAYS = timewin.DAY, 30
PER_DAY = 1 / 86400
KEYS = ["user_id"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f"q_{f.__name__}"] = f
        if sql:
            SQL[f"q_{f.__name__}"] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def samples(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("user_id", timewin.relative(F.col("ts"), "2024-01-01").alias("t"), "value", *more)


# -- SQL pieces -----------------------------------------------------------------------------------

E = f"e AS (SELECT user_id, event_type, value, cast(round(value * 100) AS BIGINT) AS c, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS t FROM events), d AS (SELECT *, t // {DAY} AS window_id FROM e)"
SPINE = f"s AS (SELECT u.user_id, k AS window_id FROM (SELECT DISTINCT user_id FROM events) u, range({DAYS}) r(k))"
BOUNDS = "s.window_id * 86400.0::DOUBLE AS window_start_s, (s.window_id + 1) * 86400.0::DOUBLE AS window_end_s"


def looked_back(days: int) -> str:
    return f"w AS (SELECT user_id, k AS window_id, t, value, value - lag(value) OVER (PARTITION BY user_id, k ORDER BY t) AS diff, t - lag(t) OVER (PARTITION BY user_id, k ORDER BY t) AS gap FROM e, range({DAYS}) r(k) WHERE t >= (k + 1) * {DAY} - {days * DAY} AND t < (k + 1) * {DAY})"


def sql_steps(x: str, good: str, noisy: str, noisy_problem: str = "ARTIFACT", bad_problem: str = "ARTIFACT") -> list[tuple[str, str, str]]:
    return [(f"NOT ({x} {good}) AND {x} {noisy}", "NOISY", noisy_problem), (f"NOT ({x} {good}) AND NOT ({x} {noisy})", "BAD", bad_problem)]


def sql_flags(rules: list[tuple[str, str, str]]) -> str:
    any_of = lambda at, name: " OR ".join(f"coalesce({r[0]}, false)" for r in rules if r[at] == name) or "false"
    q = f"CASE WHEN {any_of(1, 'BAD')} THEN 'BAD' WHEN {any_of(1, 'NOISY')} THEN 'NOISY' ELSE 'GOOD' END AS quality_flag"
    p = f"CASE WHEN {any_of(2, 'FLAT')} THEN 'FLAT' WHEN {any_of(2, 'CLIPPING')} THEN 'CLIPPING' WHEN {any_of(2, 'ARTIFACT')} THEN 'ARTIFACT' ELSE 'NONE' END AS problem_flag"
    return f"{q}, {p}"


def sql_runs(source: str, keys: str, order: str, value: str) -> str:
    """A subquery of runs: keys, v, run_start, run_length."""
    return f"""(SELECT {keys}, any_value(v) AS v, min(o) AS run_start, count(*) AS run_length FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY o) - row_number() OVER (PARTITION BY {keys}, v ORDER BY o) AS g
        FROM (SELECT {keys}, {order} AS o, {value} AS v FROM {source})) GROUP BY {keys}, v, g)"""


# -- windows --------------------------------------------------------------------------------------


@query(f"""WITH {E} SELECT user_id, window_id, count(*) AS n, sum(c) / count(*)::DOUBLE AS mean_c, round(stddev_pop(c), 4) AS std_c,
    round(kurtosis_pop(c) + 3, 3) AS kurtosis, max(c) - min(c) AS amplitude_c, round(quantile_cont(c, 0.9), 4) AS p90_c FROM d WHERE window_id < {DAYS} GROUP BY ALL""")
def tumbling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.round(F.col("value") * 100).cast("long")
    rows = timewin.tumbling(samples(spark, sf_dir).withColumn("c", c), F.col("t"), DAY, DAYS)
    k = F.kurtosis("c") + 3
    return rows.groupBy("user_id", "window_id").agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum("c") / F.count(F.lit(1))).alias("mean_c"),
        F.round(F.stddev_pop("c"), 4).alias("std_c"),
        F.round(S.finite(k), 3).alias("kurtosis"),
        (F.max("c") - F.min("c")).alias("amplitude_c"),
        F.round(F.percentile("c", F.lit(0.9)), 4).alias("p90_c"),
    )


@query(f"WITH {E}, {SPINE} SELECT s.user_id, s.window_id, count(d.t) AS n, least(1.0::DOUBLE, count(d.t) / 3.0::DOUBLE) AS completeness FROM s LEFT JOIN d USING (user_id, window_id) GROUP BY ALL")
def spine_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir)
    n = timewin.tumbling(rows, F.col("t"), DAY, DAYS).groupBy("user_id", "window_id").agg(F.count(F.lit(1)).alias("n"))
    out = timewin.spine(rows.select("user_id").distinct(), DAYS).join(n, ["user_id", "window_id"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("completeness", F.least(F.lit(1.0), F.col("n") / 3.0))


BVP_SQL = f"""WITH {E}, {SPINE}, p AS (SELECT user_id, quantile_cont(value, 0.8) AS top FROM events GROUP BY 1),
    m AS (SELECT user_id, window_id, round(least(1.0, count(*) / 3.0), 4)::DOUBLE AS completeness, round(max(value) - min(value), 4) AS amplitude, round(stddev_pop(value), 4) AS std, round(count(*) FILTER (value >= top) / count(*)::DOUBLE, 4) AS clip_ratio, round(kurtosis_pop(value) + 3, 4) AS kurtosis FROM d JOIN p USING (user_id) GROUP BY ALL),
    l AS (SELECT user_id, window_id, max(CASE WHEN v THEN run_length ELSE 0 END) AS l_max FROM {sql_runs("d JOIN p USING (user_id)", "user_id, window_id", "t", "value >= top")} GROUP BY ALL),
    j AS (SELECT s.user_id, s.window_id, {BOUNDS}, coalesce(completeness, 0.0)::DOUBLE AS completeness, amplitude, std, clip_ratio, kurtosis, coalesce(l_max, 0) AS l_max FROM s LEFT JOIN m USING (user_id, window_id) LEFT JOIN l USING (user_id, window_id))
    SELECT *, {sql_flags([*sql_steps("completeness", ">= 0.95", ">= 0.8"), ("coalesce(amplitude, 0) < 20 AND std < 10", "BAD", "FLAT"), ("coalesce(amplitude, 0) < 20 AND coalesce(std >= 10, true)", "BAD", "ARTIFACT"), ("amplitude > 400", "BAD", "ARTIFACT"), *sql_steps("l_max", "<= 1", "<= 2", "CLIPPING", "CLIPPING"), ("kurtosis > 3.5", "NOISY", "ARTIFACT")])} FROM j"""


@query(BVP_SQL)
def quality_flags_bvp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.bvp(samples(spark, sf_dir), KEYS, quality.Windows(DAY, DAYS), 3 * PER_DAY, share=0.8, low=20, high=400, still=10)


@query(f"""WITH f AS ({BVP_SQL}) SELECT user_id % 7 AS signal_type, count(*) AS total_windows, {', '.join(f"count(*) FILTER (quality_flag = '{q}') AS {q.lower()}" for q in R.QUALITIES)},
    {', '.join(f"round(count(*) FILTER (quality_flag = '{q}') * 100 / count(*)::DOUBLE, 2) AS {q.lower()}_pct" for q in R.QUALITIES)} FROM f GROUP BY 1""")
def flag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(quality_flags_bvp(spark, sf_dir).withColumn("signal_type", F.col("user_id") % 7), ["signal_type"])


def smooth_sql(days: int, expected: int, low: float, high: float, mean: str, rules: list[tuple[str, str, str]], since: str = "") -> str:
    """`since`: a condition on the samples, and windows that reach before the start are warm-up."""
    warm = f"n IS NOT NULL AND (s.window_id + 1) < {days}" if since else "false"
    flagged = sql_flags(rules).replace("CASE WHEN", f"CASE WHEN {warm} THEN 'NOISY' WHEN", 1)
    flagged = f"{flagged[:flagged.index(', CASE WHEN')]}, CASE WHEN {warm} THEN 'NONE' WHEN{flagged[flagged.index(', CASE WHEN') + 11:]}"
    return f"""WITH {E.replace("value, cast", "floor(value) AS value, cast", 1) if mean else E}, {SPINE}, {looked_back(days).replace("WHERE", f"WHERE {since} AND" if since else "WHERE")},
    m AS (SELECT user_id, window_id, count(*) AS n, round(least(1.0, count(*) / {expected}::DOUBLE), 4)::DOUBLE AS completeness, round(avg((value NOT BETWEEN {low} AND {high})::INT), 4) AS out_ratio, {mean} CASE WHEN count(*) > 1 THEN round(stddev_pop(value), 6) END AS sigma_window, round(max(abs(diff)), 6) AS max_jump FROM w GROUP BY ALL)
    SELECT s.user_id, s.window_id, {BOUNDS}, coalesce(completeness, 0.0)::DOUBLE AS completeness, m.* EXCLUDE (user_id, window_id, n, completeness), {flagged} FROM s LEFT JOIN m USING (user_id, window_id)"""


@query(smooth_sql(7, 14, 0.5, 150, "", [*sql_steps("coalesce(completeness, 0)", ">= 0.95", ">= 0.8"), ("coalesce(out_ratio, 1) >= 0.05", "BAD", "ARTIFACT"), *sql_steps("sigma_window", ">= 30", ">= 20", "NONE", "FLAT"), *sql_steps("max_jump", "<= 100", "<= 200")]))
def quality_flags_eda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.eda(samples(spark, sf_dir), KEYS, quality.Windows(DAY, DAYS, 7 * DAY), 2 * PER_DAY, 0.5, 150, still=(30, 20), jumps=(100, 200))


@query(smooth_sql(7, 14, 0.5, 150, "", [*sql_steps("coalesce(completeness, 0)", ">= 0.95", ">= 0.8"), ("coalesce(out_ratio, 1) >= 0.05", "BAD", "ARTIFACT"), *sql_steps("sigma_window", ">= 30", ">= 20", "NONE", "FLAT"), *sql_steps("max_jump", "<= 100", "<= 200")], "t >= 0"))
def warm_up_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without samples from before the start, of which there are some when time starts 10 days late."""
    return quality.eda(samples(spark, sf_dir), KEYS, quality.Windows(DAY, DAYS, 7 * DAY, pre_start=False), 2 * PER_DAY, 0.5, 150, still=(30, 20), jumps=(100, 200))


@query(smooth_sql(7, 14, 0.5, 150, "round(avg(value), 4) AS mean_temp,", [*sql_steps("coalesce(completeness, 0)", ">= 0.95", ">= 0.8"), ("coalesce(out_ratio, 1) > 0.05", "BAD", "ARTIFACT"), ("mean_temp >= 25 AND mean_temp < 40", "NOISY", "NONE"), *sql_steps("sigma_window", ">= 30", ">= 20", "NONE", "FLAT"), *sql_steps("max_jump", "<= 100", "<= 200")]))
def quality_flags_temp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.temp(samples(spark, sf_dir).withColumn("value", F.floor("value").cast("double")), KEYS, quality.Windows(DAY, DAYS, 7 * DAY), 2 * PER_DAY, 0.5, 150, warm=(25, 40), still=(30, 20), jumps=(100, 200))


@query(f"""WITH {E.replace("value, cast", "floor(value) AS value, cast", 1)}, {SPINE}, {looked_back(3)}, b AS (SELECT user_id, window_id, quality_flag AS bvp_quality_flag FROM ({BVP_SQL})),
    m AS (SELECT user_id, window_id, round(least(1.0, count(*) / 6.0), 4)::DOUBLE AS completeness, round(avg(value), 4) AS hr_mean, CASE WHEN count(*) > 1 THEN round(stddev_pop(value), 6) END AS hr_std, round(quantile_cont(diff, 0.95), 4) AS hr_ratio_up, round(quantile_cont(diff, 0.05), 4) AS hr_ratio_down, round(greatest(abs(quantile_cont(diff, 0.95)), abs(quantile_cont(diff, 0.05))), 4) AS RoC_max FROM w GROUP BY ALL)
    SELECT s.user_id, s.window_id, {BOUNDS}, coalesce(completeness, 0.0)::DOUBLE AS completeness, m.* EXCLUDE (user_id, window_id, completeness), {sql_flags([*sql_steps("coalesce(completeness, 0)", ">= 0.9", ">= 0.7"), *sql_steps("hr_mean", "BETWEEN 20 AND 80", "BETWEEN 10 AND 120", "NONE", "ARTIFACT"), *sql_steps("hr_std", ">= 20", ">= 10", "NONE", "FLAT"), *sql_steps("RoC_max", "<= 50", "<= 100", "NONE", "ARTIFACT")])}, '' AS annotation, bvp_quality_flag
    FROM s LEFT JOIN m USING (user_id, window_id) LEFT JOIN b USING (user_id, window_id)""")
def quality_flags_hr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.hr(samples(spark, sf_dir).withColumn("value", F.floor("value").cast("double")), KEYS, quality.Windows(DAY, DAYS, 3 * DAY), 2 * PER_DAY, quality_flags_bvp(spark, sf_dir), inner=(20, 80), outer=(10, 120), still=(20, 10), changes=(50, 100))


@query(f"""WITH {E}, {SPINE}, {looked_back(3)}, b AS (SELECT user_id, t, lag(t) OVER (PARTITION BY user_id ORDER BY t) AS before FROM e),
    m AS (SELECT w.user_id, window_id, count(*) AS n_ibi, round(avg((value NOT BETWEEN 1 AND 200)::INT), 4) AS out_ratio, (max(gap) + 50) // 100 / 10000::DOUBLE AS g_max_s, (first(t - before ORDER BY t) + 50) // 100 / 10000::DOUBLE AS gap_before_s FROM w JOIN b USING (user_id, t) GROUP BY ALL)
    SELECT s.user_id, s.window_id, {BOUNDS}, coalesce(n_ibi, 0) AS n_ibi, out_ratio, g_max_s, coalesce(gap_before_s, 0)::DOUBLE AS gap_before_s, {sql_flags([*sql_steps("coalesce(n_ibi, 0)", ">= 7", ">= 4"), ("out_ratio <> 0", "BAD", "ARTIFACT"), *sql_steps("g_max_s", "<= 86400", "<= 129600")])} FROM s LEFT JOIN m USING (user_id, window_id)""")
def quality_flags_ibi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ibi(samples(spark, sf_dir), KEYS, quality.Windows(DAY, DAYS, 3 * DAY), 1, 200, counts=(7, 4), gaps=(86400, 129600))


@query(f"""WITH {E.replace("value, cast", "CASE WHEN value < 4 THEN 0 WHEN value < 30 THEN 40 WHEN value < 60 THEN 60 ELSE 100 END::DOUBLE AS value, cast", 1)}, {SPINE}, {looked_back(3)},
    m AS (SELECT user_id, window_id, count(*) AS n_window, bool_or(value = 0) AS zeros, max(abs(diff)) AS max_delta, count(*) FILTER (value = 100) AS c_clip FROM w GROUP BY ALL),
    l AS (SELECT user_id, window_id, max(run_length) AS run_max FROM {sql_runs("w", "user_id, window_id", "t", "value")} GROUP BY ALL),
    j AS (SELECT s.user_id, s.window_id, {BOUNDS}, coalesce(n_window, 0) AS n_window, coalesce(zeros, false) AS zeros, max_delta, coalesce(c_clip, 0) AS c_clip, coalesce(run_max, 0) AS run_max FROM s LEFT JOIN m USING (user_id, window_id) LEFT JOIN l USING (user_id, window_id))
    SELECT *, {sql_flags([*sql_steps("n_window", ">= 5", ">= 4"), ("zeros", "BAD", "ARTIFACT"), ("max_delta > 40", "BAD", "ARTIFACT"), ("c_clip >= 5", "BAD", "CLIPPING"), ("c_clip = 4", "NOISY", "CLIPPING"), ("run_max >= 5", "BAD", "FLAT"), ("run_max = 4", "NOISY", "FLAT")])} FROM j""")
def quality_flags_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five scores are expected in three days; shares of them are rounded as in Python: 70 and 80 % are 4, 90 % is 4."""
    v = F.col("value")
    rows = samples(spark, sf_dir).withColumn("value", F.when(v < 4, 0.0).when(v < 30, 40.0).when(v < 60, 60.0).otherwise(100.0))
    return quality.attention(rows, KEYS, quality.Windows(DAY, DAYS, 3 * DAY), rate=5 / 3 * PER_DAY)


@query(f"""WITH {E}, {SPINE}, a AS (SELECT user_id, window_id, t, (c % 257 - 128)::DOUBLE AS x, (c % 101)::DOUBLE AS y, (c % 53)::DOUBLE AS z FROM d),
    b AS (SELECT *, greatest(abs(x), abs(y), abs(z)) AS most FROM a),
    m AS (SELECT user_id, window_id, round(least(1.0, count(*) / 2.0), 4)::DOUBLE AS completeness, round(avg((most > 120)::INT), 4) AS out_ratio, round(avg((most >= 45)::INT), 4) AS clip_ratio, stddev_pop(x) < 20 AND stddev_pop(y) < 20 AND stddev_pop(z) < 20 AND abs(avg(sqrt(x * x + y * y + z * z)) - 64) > 10 AS still, round(avg(sqrt(x * x + y * y + z * z)), 4) AS M FROM b GROUP BY ALL),
    l AS (SELECT user_id, window_id, max(CASE WHEN v THEN run_length ELSE 0 END) AS l_max FROM {sql_runs("b", "user_id, window_id", "t", "most >= 45")} GROUP BY ALL)
    SELECT s.user_id, s.window_id, {BOUNDS}, coalesce(completeness, 0.0)::DOUBLE AS completeness, out_ratio, clip_ratio, coalesce(l_max, 0) AS l_max, coalesce(still, true) AS FLAT, M, M AS M_mean, {sql_flags([*sql_steps("coalesce(completeness, 0)", ">= 0.95", ">= 0.8"), ("coalesce(out_ratio, 1) <> 0", "BAD", "ARTIFACT"), *sql_steps("l_max", "<= 1", "<= 2", "CLIPPING", "CLIPPING"), ("still", "BAD", "FLAT")])} FROM s LEFT JOIN m USING (user_id, window_id) LEFT JOIN l USING (user_id, window_id)""")
def quality_flags_acc(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.round(F.col("value") * 100).cast("long")
    rows = samples(spark, sf_dir).select("user_id", "t", (c % 257 - 128).cast("double").alias("x"), (c % 101).cast("double").alias("y"), (c % 53).cast("double").alias("z"))
    return quality.acc(rows, KEYS, quality.Windows(DAY, DAYS), 2 * PER_DAY, limit=120, clip=45, still=20)


@query(f"""WITH {E}, x AS (SELECT user_id, t - {2 * DAY} AS t, (c % 50)::DOUBLE AS low, (c % 7)::DOUBLE AS high FROM e), s AS (SELECT user_id, k AS window_id FROM (SELECT DISTINCT user_id FROM e), range(28) r(k)),
    a AS (SELECT *, t // {DAY} AS window_id FROM x WHERE t >= 0), f AS (SELECT user_id, arg_max(low + high, t) AS p0 FROM x WHERE t < 0 GROUP BY 1),
    m AS (SELECT user_id, window_id, count(*) AS n, bool_or(low = 0 OR high = 0) AS zero, stddev_pop(low) = 0 OR stddev_pop(high) = 0 AS still, avg(low + high) AS p, arg_max(low, t) AS ll, arg_max(high, t) AS lh FROM a GROUP BY ALL),
    j AS (SELECT s.*, n, zero, still, p, ll, lh, CASE WHEN s.window_id = 0 THEN p0 ELSE lag(p) OVER o END AS p1, lag(ll) OVER o AS l1, lag(lh) OVER o AS h1, lag(ll, 2) OVER o AS l2, lag(lh, 2) OVER o AS h2 FROM s LEFT JOIN m USING (user_id, window_id) LEFT JOIN f USING (user_id) WINDOW o AS (PARTITION BY s.user_id ORDER BY s.window_id)),
    k AS (SELECT user_id, window_id AS day, zero, CASE WHEN n >= 2 THEN still WHEN l1 IS NOT NULL AND l2 IS NOT NULL THEN coalesce((ll = l1 AND l1 = l2) OR (lh = h1 AND h1 = h2), false) ELSE false END AS flat, CASE WHEN p1 > 0 THEN p / p1 END AS ratio, p, n FROM j),
    o AS (SELECT k.*, w.window_id FROM (SELECT range AS window_id FROM range(56)) w JOIN k ON k.day = (w.window_id * 43200 + 21600) // 86400)
    SELECT s.user_id, s.window_id, s.window_id * 43200.0::DOUBLE AS window_start_s, (s.window_id + 1) * 43200.0::DOUBLE AS window_end_s, coalesce(zero, false) AS zero, flat, coalesce(ratio > 2, false) AS spike, round(p, 4) AS power, round(ratio, 4) AS power_ratio, {sql_flags([("zero", "BAD", "ARTIFACT"), ("flat", "BAD", "FLAT"), ("ratio > 2", "NOISY", "ARTIFACT"), ("n IS NULL", "BAD", "ARTIFACT")])} FROM o s""")
def power_spike(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time starts after two days; metrics are of days, windows of half a day."""
    c = F.round(F.col("value") * 100).cast("long")
    rows = samples(spark, sf_dir).select("user_id", (F.col("t") - 2 * DAY).alias("t"), (c % 50).cast("double").alias("low"), (c % 7).cast("double").alias("high"))
    return quality.brainwave(rows, KEYS, quality.Windows(DAY // 2, 56), ["low", "high"], least=DAY)


@query(f"""WITH {E}, a AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY t) - 1 AS idx, CASE WHEN user_id % 9 = 0 THEN c % 2 * 0.00000001::DOUBLE WHEN user_id % 3 = 0 THEN (c % 160 - 80) / 100.0::DOUBLE ELSE (c % 200 - 100) / 100.0::DOUBLE END AS value, count(*) OVER (PARTITION BY user_id) AS n FROM e),
    b AS (SELECT *, idx // 8 AS window_id FROM a WHERE (idx // 8 + 1) * 8 <= n),
    m AS (SELECT user_id, window_id, sqrt(avg(value * value)) AS rms, round(avg((abs(value) < 1e-6)::INT), 6) AS zero_ratio, round(avg((abs(value) >= 0.9)::INT), 6) AS clip_ratio FROM b GROUP BY ALL),
    q AS (SELECT *, round(CASE WHEN rms > 1e-12 THEN 20 * log10(rms) ELSE -120 END, 4) AS rms_db FROM m),
    l AS (SELECT user_id, window_id, max(CASE WHEN v THEN run_length ELSE 0 END) AS clip_run_max FROM {sql_runs("b", "user_id, window_id", "idx", "abs(value) >= 0.9")} GROUP BY ALL),
    f AS (SELECT user_id, greatest(quantile_cont(rms, 0.1), 1e-12) AS floor FROM m GROUP BY 1)
    SELECT user_id, window_id, window_id * 8.0::DOUBLE AS window_start_s, (window_id + 1) * 8.0::DOUBLE AS window_end_s, rms_db, zero_ratio, clip_ratio, clip_run_max, {sql_flags([("rms_db < -60 OR zero_ratio > 0.5", "BAD", "FLAT"), ("clip_ratio > 0.001 OR clip_run_max >= 3", "BAD", "CLIPPING")])}, round(CASE WHEN rms > 1e-12 THEN 20 * log10(rms / floor) ELSE -120 END, 4) AS snr_db FROM q JOIN l USING (user_id, window_id) JOIN f USING (user_id)""")
def audio_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    c = F.round(F.col("value") * 100).cast("long")
    rows = samples(spark, sf_dir).select("user_id", (F.row_number().over(Window.partitionBy("user_id").orderBy("t")) - 1).alias("idx"), F.when(F.col("user_id") % 9 == 0, c % 2 * 0.00000001).when(F.col("user_id") % 3 == 0, (c % 160 - 80) / 100.0).otherwise((c % 200 - 100) / 100.0).alias("value"))
    return quality.audio(rows, KEYS, 1.0, 8.0, clip=0.9)


@query(f"""WITH {E}, a AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY t) - 1 AS frame, c FROM e), n AS (SELECT user_id, greatest(6, max(frame) // 15 + 1) AS n FROM a GROUP BY 1), s AS (SELECT user_id, unnest(range(n)) AS window_id FROM n),
    m AS (SELECT user_id, frame // 15 AS window_id, avg(c % 300) AS blur, avg((c % 100) / 200.0::DOUBLE) AS clipping, avg((c % 4 > 0)::INT) AS face FROM a GROUP BY ALL)
    SELECT s.user_id, s.window_id, s.window_id * 1.0::DOUBLE AS window_start_s, (s.window_id + 1) * 1.0::DOUBLE AS window_end_s, round(blur, 4) AS window_blur, round(clipping, 6) AS window_clipping, round(face, 4) AS face_detection_rate,
      CASE WHEN blur IS NULL OR blur < 120 OR clipping >= 0.27 OR face < 0.5 THEN 'BAD' WHEN blur < 150 OR clipping >= 0.25 OR face < 0.78 THEN 'NOISY' ELSE 'GOOD' END AS quality_flag,
      CASE WHEN clipping >= 0.27 THEN 'CLIPPING' WHEN blur IS NULL OR blur < 120 OR face < 0.5 THEN 'ARTIFACT' ELSE 'NONE' END AS problem_flag
    FROM s LEFT JOIN m USING (user_id, window_id)""")
def video_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    c = F.round(F.col("value") * 100).cast("long")
    rows = samples(spark, sf_dir).select(
        "user_id", (F.row_number().over(Window.partitionBy("user_id").orderBy("t")) - 1).alias("frame"), (c % 300).alias("lap_var"), ((c % 100) / 200.0).alias("clipped_ratio"), (c % 4 > 0).cast("int").alias("face")
    )
    return quality.video(rows, KEYS, 15, 1.0, 6, blur=(150, 120), clipped=(0.25, 0.27), whole=True)


@query(f"WITH {E} SELECT user_id, k AS window_id, count(*) AS n, sum(c) / count(*)::DOUBLE AS mean_c FROM e, range({DAYS}) r(k) WHERE t >= (k + 1) * {DAY} - {7 * DAY} AND t < (k + 1) * {DAY} GROUP BY ALL")
def lookback_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = timewin.lookback(samples(spark, sf_dir), F.col("t"), DAY, 7 * DAY, DAYS)
    return rows.groupBy("user_id", "window_id").agg(F.count(F.lit(1)).alias("n"), (F.sum(F.round(F.col("value") * 100).cast("long")) / F.count(F.lit(1))).alias("mean_c"))


@query(f"WITH {E} SELECT user_id, k + 1 AS window_id, count(*) AS n, sum(c) / count(*)::DOUBLE AS mean_c FROM e, range({DAYS}) r(k) WHERE t >= k * {DAY} AND t < k * {DAY} + {3 * DAY} GROUP BY ALL")
def forward_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = timewin.forward(samples(spark, sf_dir), F.col("t"), DAY, 3 * DAY, DAYS)
    return rows.groupBy("user_id", "window_id").agg(F.count(F.lit(1)).alias("n"), (F.sum(F.round(F.col("value") * 100).cast("long")) / F.count(F.lit(1))).alias("mean_c"))


@query(f"""WITH f AS ({BVP_SQL}), x AS (SELECT user_id, 20 + user_id % 15 AS expected FROM (SELECT DISTINCT user_id FROM f)) SELECT user_id, count(DISTINCT window_id) AS n_windows, any_value(expected) AS expected,
    CASE WHEN count(DISTINCT window_id) = any_value(expected) THEN 'ok' WHEN count(DISTINCT window_id) > any_value(expected) THEN 'trimmed' ELSE 'too_few' END AS outcome FROM f JOIN x USING (user_id) GROUP BY 1""")
def window_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timewin.count_check(quality_flags_bvp(spark, sf_dir), KEYS, 20 + F.col("user_id") % 15)


# -- runs, percentiles, agreement -----------------------------------------------------------------


@query(f"WITH {E} SELECT user_id, max(run_length) AS run_max FROM {sql_runs('e', 'user_id', 't', 'event_type')} GROUP BY 1")
def longest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.longest_run(samples(spark, sf_dir, "event_type"), KEYS, "t", F.col("event_type"))


@query(f"""WITH {E}, r AS (SELECT * FROM {sql_runs('e', 'user_id', 't', 'event_type')}) SELECT user_id, max(run_length) AS longest_run, first(v ORDER BY run_length DESC, run_start) AS longest_run_value, count(*) FILTER (run_length > 2) AS n_runs_over_2 FROM r GROUP BY 1""")
def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_stats(samples(spark, sf_dir, "event_type"), KEYS, "t", F.col("event_type"), over=2)


@query(f"WITH {E}, p AS (SELECT user_id, quantile_cont(value, 0.9) AS top FROM e GROUP BY 1) SELECT user_id, max(CASE WHEN v THEN run_length ELSE 0 END) AS l_max FROM {sql_runs('e JOIN p USING (user_id)', 'user_id', 't', 'value >= top')} GROUP BY 1")
def clip_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir)
    top = rows.groupBy("user_id").agg(F.percentile("value", F.lit(0.9)).alias("top"))
    return runs.longest_true_run(rows.join(top, "user_id"), KEYS, "t", F.col("value") >= F.col("top"))


@query(f"""WITH {E}, a AS (SELECT user_id, t, least(100, c // 100) AS v, least(100, c // 100) - lag(least(100, c // 100)) OVER (PARTITION BY user_id ORDER BY t) AS diff FROM e), r AS (SELECT * FROM {sql_runs('a', 'user_id', 't', 'v')}),
    h AS (SELECT user_id, {', '.join(f"count(*) FILTER (v BETWEEN {a} AND {b}) AS n_{a}" + (f"_{b}" if a != b else "") for a, b in ((0, 0), (1, 20), (21, 40), (41, 60), (61, 80), (81, 99), (100, 100)))}, {', '.join(f"count(*) FILTER (abs(diff) > {j}) AS jumps_over_{j}" for j in (10, 20, 30, 40))} FROM a GROUP BY 1)
    SELECT h.*, longest_run, longest_run_value, n_runs_over_10 FROM h JOIN (SELECT user_id, max(run_length) AS longest_run, first(v ORDER BY run_length DESC, run_start) AS longest_run_value, count(*) FILTER (run_length > 10) AS n_runs_over_10 FROM r GROUP BY 1) USING (user_id)""")
def jumps_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir).withColumn("value", F.least(F.lit(100), F.floor(F.round(F.col("value") * 100) / 100)).cast("long"))
    return stats.score_stats(rows, KEYS, "t", "value")


@query("""WITH m AS (SELECT event_type, quantile_cont(value, 0.5) AS mid, count(*) AS n FROM events GROUP BY 1), x AS (SELECT event_id, event_type, value, mid, n FROM events JOIN m USING (event_type)), a AS (SELECT event_type, quantile_cont(abs(value - mid), 0.5) AS mad FROM x GROUP BY 1)
    SELECT event_id, event_type, round(CASE WHEN n >= 2 AND mad > 0 THEN (value - mid) / (1.4826 * mad) END, 6) AS z FROM x JOIN a USING (event_type)""")
def robust_z(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return quality.robust_z(rows, ["event_type"], "value", "z").select("event_id", "event_type", F.round("z", 6).alias("z"))


@query("SELECT " + ", ".join(f"round(quantile_cont(value, {p}), 6) AS p{round(p * 100)}" for p in (0.5, 0.75, 0.9, 0.95, 0.99)) + " FROM events")
def percentiles_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = stats.percentiles(table(spark, sf_dir, "events"), "value")
    return p.select(*[F.round(c, 6).alias(c) for c in p.columns])


@query("""WITH r AS (SELECT user_id, event_type, avg((value > 60)::INT) AS rate FROM events GROUP BY ALL) SELECT event_type, round(avg(rate), 9) AS mean_rate, round(stddev_pop(rate), 9) AS std_rate, count(*) AS n_entities FROM r GROUP BY 1""")
def macro_avg_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.when(F.col("value") > 60, "BAD").otherwise("GOOD").alias("quality_flag"))
    return stats.macro_rate(rows, "user_id", "event_type").withColumns({c: F.round(c, 9) for c in ("mean_rate", "std_rate")})


@query("""WITH v AS (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS b, count(*) FILTER (l_returnflag = 'A') AS m, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT l_orderkey, CASE WHEN b > n / 2.0 THEN 'BAD' WHEN b + m > n / 2.0 THEN 'NOISY' ELSE 'GOOD' END AS quality_flag FROM v""")
def majority_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") == "R", "BAD").when(F.col("l_returnflag") == "A", "NOISY").otherwise("GOOD")
    return fusion.channel_majority(table(spark, sf_dir, "lineitem").select("l_orderkey", flag.alias("quality_flag")), ["l_orderkey"])


@query("""SELECT user_id, first(event_type ORDER BY n DESC, f) AS event_type FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY ALL) GROUP BY 1""")
def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.majority_vote(table(spark, sf_dir, "events"), KEYS, "event_type", "event_id")


@query("""SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max FROM events GROUP BY ROLLUP (event_type)""")
def rollup_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.quality_rollup(table(spark, sf_dir, "events"), "event_type", "value")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "median", "std")})


TRANSITIONS = """WITH p AS (SELECT event_type AS a, lead(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events), k AS (SELECT DISTINCT event_type AS s FROM events),
    c AS (SELECT x.s AS from_state, y.s AS to_state, count(p.a) AS n FROM k x CROSS JOIN k y LEFT JOIN p ON p.a = x.s AND p.b = y.s GROUP BY ALL) SELECT *, (n + 1.0::DOUBLE) / sum(n + 1.0::DOUBLE) OVER (PARTITION BY from_state) AS p FROM c"""


@query(TRANSITIONS)
def transition_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return stats.transitions(e, KEYS, "event_id", "event_type", e.select(F.col("event_type").alias("class")).distinct())


@query("""WITH f AS (SELECT arg_min(event_type, event_id) AS class FROM events GROUP BY user_id), k AS (SELECT DISTINCT event_type AS class FROM events), c AS (SELECT k.class, count(f.class) AS n FROM k LEFT JOIN f USING (class) GROUP BY 1) SELECT class, n, (n + 1.0::DOUBLE) / sum(n + 1.0::DOUBLE) OVER () AS p FROM c""")
def prior_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return stats.priors(e, KEYS, "event_id", "event_type", e.select(F.col("event_type").alias("class")).distinct())


@query("""WITH c AS (SELECT q.v AS quality, t.v AS toxic, (SELECT count(*) FROM labels WHERE quality = q.v AND toxic = t.v) AS n FROM (VALUES (0), (1)) q(v), (VALUES (0), (1)) t(v)),
    m AS (SELECT k.v AS class, (SELECT sum(n) FROM c WHERE quality = k.v AND toxic = k.v)::BIGINT AS tp, (SELECT sum(n) FROM c WHERE quality = k.v)::BIGINT AS support, (SELECT sum(n) FROM c WHERE toxic = k.v)::BIGINT AS predicted FROM (VALUES (0), (1)) k(v)),
    s AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted::DOUBLE ELSE 0 END AS p, CASE WHEN support > 0 THEN tp / support::DOUBLE ELSE 0 END AS r FROM m)
    SELECT class, tp, support, predicted, round(p, 4) AS precision, round(r, 4) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 4) AS f1 FROM s""")
def confusion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").filter("quality is not null and toxic is not null")
    classes = spark.createDataFrame([(0,), (1,)], "class int")
    return stats.class_scores(stats.confusion(rows, "quality", "toxic", classes), "quality", "toxic")


@query("""WITH s AS (SELECT event_id, [c % 7, c // 7 % 7, CASE WHEN c % 5 > 0 THEN c // 49 % 7 END] AS r FROM (SELECT event_id, cast(round(value * 100) AS BIGINT) AS c FROM events))
    SELECT event_id, CASE WHEN (SELECT count(*) FROM range(1, 4) i(a), range(1, 4) j(b) WHERE a < b AND abs(r[a] - r[b]) <= 1) > 0 THEN 'AGREE' ELSE 'DISAGREE' END AS agreement FROM s""")
def rater_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.round(F.col("value") * 100).cast("long")
    own = [c % 7, F.floor(c / 7) % 7, F.when(c % 5 > 0, F.floor(c / 49) % 7)]
    return table(spark, sf_dir, "events").select("event_id", F.when(S.raters_agree(*own), "AGREE").otherwise("DISAGREE").alias("agreement"))


CLASSES = "(VALUES ('Anger', NULL, -1, 1, NULL), ('Happiness', 1, NULL, 1, NULL), ('Calm', -1, NULL, NULL, -1), ('Sadness', NULL, -1, NULL, -1), ('Neutral', NULL, NULL, NULL, NULL)) b(emotion_class, vl, vh, al, ah)"


@query(f"""WITH e AS (SELECT event_id, cast(round(value * 100) AS BIGINT) AS c FROM events),
    t AS (SELECT event_id, ['Anger', 'Happiness', 'Calm', 'Sadness', 'Neutral'][event_id % 5 + 1] AS emotion_class, event_id % 11 > 0 AS rated, CASE WHEN c % 13 > 0 THEN c % 9 - 4 END AS vp, c // 9 % 9 - 4 AS ap, c // 81 % 9 - 4 AS ve, (c + event_id) % 9 - 4 AS ae FROM e),
    r AS (SELECT event_id, emotion_class, rated, CASE WHEN rated THEN vp END::DOUBLE AS vp, CASE WHEN rated THEN ap END::DOUBLE AS ap, CASE WHEN rated THEN ve END::DOUBLE AS ve, CASE WHEN rated THEN ae END::DOUBLE AS ae FROM t),
    f AS (SELECT r.*, coalesce(vp = 0 OR vp < vl OR vp > vh, false) AS v_off, coalesce(ap = 0 OR ap < al OR ap > ah, false) AS a_off, coalesce(abs(vp - ve) >= 3, false) AS v_apart, coalesce(abs(ap - ae) >= 3, false) AS a_apart, (vp + ve) / 2 AS v, (ap + ae) / 2 AS a FROM r JOIN {CLASSES} USING (emotion_class)),
    g AS (SELECT *, CASE WHEN v >= 0 AND a >= 0 THEN 'Happiness' WHEN v <= 0 AND a >= 0 THEN 'Anger' WHEN v >= 0 AND a <= 0 THEN 'Calm' WHEN v <= 0 AND a <= 0 THEN 'Sadness' END AS emotion FROM f)
    SELECT event_id, emotion_class, vp AS valence_participant, ap AS arousal_participant, ve AS valence_experimenter, ae AS arousal_experimenter,
      CASE WHEN rated THEN CASE WHEN v_off THEN 'MISALIGNED' ELSE 'ALIGNED' END END AS valence_class_alignment, CASE WHEN rated THEN CASE WHEN a_off THEN 'MISALIGNED' ELSE 'ALIGNED' END END AS arousal_class_alignment,
      CASE WHEN NOT rated THEN NULL WHEN v_off AND a_off THEN 'BAD' WHEN v_off OR a_off THEN 'NOISY' WHEN v_apart AND a_apart THEN 'NOISY' WHEN v_apart OR a_apart THEN 'ACCEPTABLE' ELSE 'GOOD' END AS quality_flag,
      v AS avg_valence, a AS avg_arousal, emotion AS valence_arousal_emotion, CASE WHEN rated THEN CASE WHEN emotion = emotion_class THEN 'ALIGNED' ELSE 'MISALIGNED' END END AS emotion_class_alignment FROM g""")
def trial_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event is a trial of a subject of its own; every eleventh has no scores, and some scores are missing."""
    c = F.round(F.col("value") * 100).cast("long")
    part = lambda n: F.floor(c / n) % 9 - 4
    e = table(spark, sf_dir, "events").select(
        "event_id",
        F.element_at(F.array(*[F.lit(x) for x in ("Anger", "Happiness", "Calm", "Sadness", "Neutral")]), (F.col("event_id") % 5 + 1).cast("int")).alias("emotion_class"),
        F.when(c % 13 > 0, part(1)).cast("double").alias("valence_participant"),
        part(9).cast("double").alias("arousal_participant"),
        part(81).cast("double").alias("valence_experimenter"),
        ((c + F.col("event_id")) % 9 - 4).cast("double").alias("arousal_experimenter"),
    )
    trials = e.select(F.col("event_id").alias("subject"), F.lit(1).alias("trial_id"), "emotion_class", F.lit(1).alias("k"))
    scores = e.filter("event_id % 11 > 0").withColumnRenamed("event_id", "subject").withColumn("k", F.lit(1))
    bounds = [("Anger", None, -1, 1, None), ("Happiness", 1, None, 1, None), ("Calm", -1, None, None, -1), ("Sadness", None, -1, None, -1), ("Neutral", None, None, None, None)]
    thresholds = spark.createDataFrame(bounds, "emotion_class string, valence_low int, valence_high int, arousal_low int, arousal_high int")
    return annotate.trial_annotations(trials, scores, thresholds).withColumnRenamed("subject", "event_id").drop("trial_id", "k")


RATED = ("arousal", "valence", "cheerful", "happy", "angry", "nervous", "sad")


def _session_sql() -> str:
    of = lambda c: f"[self.{c}, partner.{c}, external.{c}]"
    agree = lambda c: f"(abs(self.{c} - partner.{c}) <= 1 OR abs(self.{c} - external.{c}) <= 1 OR abs(partner.{c} - external.{c}) <= 1)"
    score = {c: f"(c // {7**k if k < 4 else 3 * k} + {k} * (event_id % 3)) % " + ("5 + 1" if k < 2 else "(CASE WHEN user_id % 4 = 0 THEN 2 ELSE 5 END) + 1") for k, c in enumerate(RATED)}
    feelings = RATED[2:]
    return f"""WITH e AS (SELECT event_id, user_id, ts, cast(round(value * 100) AS BIGINT) AS c FROM events WHERE user_id % 6 > 0 OR event_id % 3 < 2),
    r AS (SELECT user_id, event_id % 3 AS who, c, {", ".join(f"CASE WHEN (c + {k}) % 8 > 0 THEN {x} END::DOUBLE AS {n}" for k, (n, x) in enumerate(score.items()))}, c % 2 = 0 AS boredom, c % 3 = 0 AS delight,
      row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY event_id DESC) AS back FROM e),
    n AS (SELECT user_id, min(c) AS n, count(*) AS raters FROM (SELECT user_id, who, count(*) AS c FROM r GROUP BY ALL) GROUP BY 1),
    w AS (SELECT user_id, n - self.back AS position, self, partner, external FROM n JOIN r self USING (user_id) JOIN r partner USING (user_id, back) JOIN r external USING (user_id, back) WHERE raters = 3 AND back <= n AND self.who = 0 AND partner.who = 1 AND external.who = 2),
    g AS (SELECT user_id, position * 5 AS seconds, {", ".join(f"coalesce({agree(c)}, false) AS {c}_ok" for c in RATED)}, (self.boredom::INT + partner.boredom::INT + external.boredom::INT >= 2 OR self.delight::INT + partner.delight::INT + external.delight::INT >= 2) AS check_ok,
      {", ".join(f"coalesce(list_sum({of(c)}), 0)::DOUBLE AS {c}_sum" for c in feelings)}, list_avg({of("valence")}) AS v, list_avg({of("arousal")}) AS a FROM w),
    h AS (SELECT *, {" + ".join(f"(NOT {c}_ok)::INT" for c in (*RATED, "check"))} AS off, greatest({", ".join(f"{c}_sum" for c in feelings)}) AS top,
      CASE WHEN v >= 3 AND a >= 3 THEN 'Happiness' WHEN v <= 3 AND a >= 3 THEN 'Anger' WHEN v >= 3 AND a <= 3 THEN 'Calm' WHEN v <= 3 AND a <= 3 THEN 'Sadness' END AS emotion FROM g),
    d AS (SELECT *, concat_ws(', ', CASE WHEN top <= 4 THEN 'Neutral' END, CASE WHEN top <= 6 AND (happy_sum = top OR sad_sum = top) THEN 'Calm' END, CASE WHEN cheerful_sum = top OR happy_sum = top THEN 'Happiness' END, CASE WHEN angry_sum = top THEN 'Anger' END, CASE WHEN nervous_sum = top OR sad_sum = top THEN 'Sadness' END) AS dominant FROM h)
    SELECT user_id, seconds, {", ".join(f"CASE WHEN {c}_ok THEN 'AGREE' ELSE 'DISAGREE' END AS {'check_0' if c == 'check' else c}_agree" for c in (*RATED, "check"))},
      CASE WHEN off >= 5 THEN 'BAD' WHEN off >= 3 OR (NOT arousal_ok AND NOT valence_ok) THEN 'NOISY' WHEN NOT arousal_ok OR NOT valence_ok THEN 'ACCEPTABLE' ELSE 'GOOD' END AS quality_flag,
      dominant AS dominant_emotion, top AS dominant_emotion_value, round(v, 9) AS avg_valence, round(a, 9) AS avg_arousal, emotion AS valence_arousal_emotion, CASE WHEN list_contains(string_split(dominant, ', '), emotion) THEN 'ALIGNED' ELSE 'MISALIGNED' END AS emotion_class_alignment FROM d"""


@query(_session_sql())
def session_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three raters of a user by event_id; some have no third one, and some scores are missing."""
    c = F.round(F.col("value") * 100).cast("long")
    who = F.col("event_id") % 3
    most = F.when(F.col("user_id") % 4 == 0, 2).otherwise(5)  # low feelings of some
    score = lambda k: (F.floor(c / (7**k if k < 4 else 3 * k)) + k * who) % (5 if k < 2 else most) + 1
    rows = table(spark, sf_dir, "events").filter("user_id % 6 > 0 or event_id % 3 < 2")
    rows = rows.select(
        "user_id",
        F.element_at(F.array(F.lit("self"), F.lit("partner"), F.lit("external")), (who + 1).cast("int")).alias("rater"),
        F.col("event_id").alias("row"),
        *[F.when((c + k) % 8 > 0, score(k)).cast("double").alias(n) for k, n in enumerate(RATED)],
        F.when(c % 2 == 0, "x").alias("boredom"),
        F.when(c % 3 == 0, " X").otherwise("no").alias("delight"),
    )
    out = annotate.session_annotations(rows, KEYS, list(RATED), [["boredom", "delight"]])
    return out.withColumn("avg_valence", F.round("avg_valence", 9)).withColumn("avg_arousal", F.round("avg_arousal", 9))


@query("""SELECT c_custkey, CASE WHEN x >= 0 AND y >= 0 THEN 'Happiness' WHEN x <= 0 AND y >= 0 THEN 'Anger' WHEN x >= 0 AND y <= 0 THEN 'Calm' ELSE 'Sadness' END AS emotion FROM (SELECT c_custkey, c_acctbal - 3 AS x, c_nationkey % 5 - 3 AS y FROM customer)""")
def quadrant_emotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", S.quadrant(F.col("c_acctbal"), F.col("c_nationkey") % 5, 3.0).alias("emotion"))


# -- joins, fusion, identifiers, missing data -----------------------------------------------------


@query("""SELECT v.event_id, v.user_id, p.value AS last_purchase FROM (SELECT * FROM events WHERE event_type = 'view') v ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON v.user_id = p.user_id AND v.ts >= p.ts""")
def asof_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("t", timewin.micros(F.col("ts")))
    left, right = rows.filter("event_type = 'view'").select("event_id", "user_id", "t"), rows.filter("event_type = 'purchase'").select("user_id", "t", "value")
    return asof.backward(left, right, KEYS, "t", "t", "value", "last_purchase").drop("t")


@query("""WITH v AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'), p AS (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase'),
    b AS (SELECT v.event_id, v.user_id, v.ts, p.ts AS bt, p.value AS bv FROM v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts >= p.ts), f AS (SELECT v.event_id, p.ts AS ft, p.value AS fv FROM v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts <= p.ts)
    SELECT event_id, user_id, CASE WHEN ft IS NULL THEN bv WHEN bt IS NULL THEN fv WHEN epoch_us(ts) - epoch_us(bt) <= epoch_us(ft) - epoch_us(ts) THEN bv ELSE fv END AS near_purchase FROM b JOIN f USING (event_id)""")
def asof_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("t", timewin.micros(F.col("ts")))
    left, right = rows.filter("event_type = 'view'").select("event_id", "user_id", "t"), rows.filter("event_type = 'purchase'").select("user_id", "t", "value")
    return asof.nearest(left, right, KEYS, "t", "t", "value", "near_purchase").drop("t")


TYPES = ("view", "click", "purchase")
WORST = "CASE WHEN bool_or(f = 'BAD') FILTER (event_type = '{m}') THEN 'BAD' WHEN bool_or(f = 'NOISY') FILTER (event_type = '{m}') THEN 'NOISY' WHEN bool_or(f = 'GOOD') FILTER (event_type = '{m}') THEN 'GOOD' END AS {m}_flag"
FLAG_SQL = "CASE WHEN value > 120 THEN 'BAD' WHEN value > 60 THEN 'NOISY' ELSE 'GOOD' END"


def typed_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("value") > 120, "BAD").when(F.col("value") > 60, "NOISY").otherwise("GOOD")
    rows = timewin.tumbling(samples(spark, sf_dir, "event_type").withColumn("quality_flag", flag), F.col("t"), DAY, DAYS)
    return rows.groupBy("user_id", "window_id", F.col("event_type").alias("modality")).agg(F.collect_set("quality_flag").alias("f")).select("user_id", "window_id", "modality", F.explode("f").alias("quality_flag"))


@query(f"WITH {E}, g AS (SELECT *, {FLAG_SQL} AS f FROM d WHERE window_id < {DAYS}) SELECT user_id, window_id, " + ", ".join(WORST.format(m=m) for m in TYPES) + " FROM g GROUP BY ALL")
def pivot_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion.fuse(typed_flags(spark, sf_dir), ["user_id", "window_id"], list(TYPES))


@query(f"""WITH {E}, g AS (SELECT *, {FLAG_SQL} AS f FROM d WHERE window_id < {DAYS}), w AS (SELECT user_id AS entity_id, window_id, {', '.join(WORST.format(m=m) for m in TYPES)} FROM g GROUP BY ALL), l AS (SELECT user_id AS entity_id, t / 1000000 AS seconds, event_type AS emotion FROM e WHERE event_type IN ('error', 'signup'))
    SELECT w.entity_id, window_id, window_id * 86400.0::DOUBLE AS window_start_s, window_id * 86400.0::DOUBLE + 86400.0::DOUBLE AS window_end_s, {', '.join(f"{m}_flag" for m in TYPES)}, l.emotion AS window_emotion FROM w ASOF LEFT JOIN l ON w.entity_id = l.entity_id AND (window_id + 0.5::DOUBLE) * 86400 >= l.seconds""")
def session_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = samples(spark, sf_dir, "event_type").filter("event_type in ('error', 'signup')").select(F.col("user_id").alias("entity_id"), (F.col("t") / 1000000).alias("seconds"), F.col("event_type").alias("emotion"))
    return fusion.session_report(typed_flags(spark, sf_dir).withColumnRenamed("user_id", "entity_id"), labels, list(TYPES), 86400.0)


@query("SELECT doc_id, source AS source_entity_id, printf('e%02d', cast(substr(source, 4) AS INT)) AS entity_id FROM documents")
def id_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.resolved(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", r"^src(\d+)$").select("doc_id", "source_entity_id", "entity_id")


@query("""WITH i AS (SELECT DISTINCT CASE WHEN r = 0 THEN source WHEN r = 1 THEN 'e0' || (n % 10) WHEN r = 2 THEN source || '_' || replace(source, 'src', 'SRC') ELSE 'x' || n END AS id, r FROM (SELECT source, cast(substr(source, 4) AS INT) AS n, cast(substr(source, 4) AS INT) % 4 AS r FROM documents))
    SELECT CASE r WHEN 0 THEN 'single' WHEN 1 THEN 'canonical' WHEN 2 THEN 'dyadic' ELSE 'unknown' END AS format, count(*) AS n, array_to_string(list_slice(list_sort(list(id)), 1, 10), ',') AS examples FROM i GROUP BY 1""")
def id_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.substring("source", 4, 9).cast("int")
    own = F.when(n % 4 == 0, F.col("source")).when(n % 4 == 1, F.concat(F.lit("e0"), n % 10)).when(n % 4 == 2, F.concat_ws("_", "source", F.regexp_replace("source", "src", "SRC"))).otherwise(F.concat(F.lit("x"), n))
    return checks.id_audit(table(spark, sf_dir, "documents").select(own.alias("id")), "id", r"^src(\d+)$")


@query("""SELECT n_nationkey, raw, printf('e%02d', cast(substr(u.x, 2) AS INT)) AS entity_id FROM (SELECT n_nationkey, 'p' || n_nationkey || '_P' || n_regionkey AS raw FROM nation), unnest(string_split(raw, '_')) u(x)""")
def dyadic_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("p"), "n_nationkey", F.lit("_P"), "n_regionkey")
    return checks.resolved(table(spark, sf_dir, "nation").select("n_nationkey", raw.alias("raw")), "raw").select("n_nationkey", "raw", "entity_id")


@query("""WITH m AS (SELECT doc_id AS path, strlen(text) AS size, md5(text) AS md5 FROM documents), i AS (SELECT doc_id AS path, strlen(text) + (doc_id % 5 = 0)::INT AS size, CASE WHEN doc_id % 7 = 0 THEN 'ab-2' WHEN doc_id % 3 = 0 THEN 'x' ELSE md5(text) END AS md5 FROM documents WHERE doc_id % 11 > 0)
    SELECT m.path, CASE WHEN i.path IS NULL THEN 'missing' WHEN i.size <> m.size THEN 'size_mismatch' WHEN i.md5 NOT LIKE '%-%' AND i.md5 <> m.md5 THEN 'hash_mismatch' ELSE 'ok' END AS outcome FROM m LEFT JOIN i USING (path)""")
def manifest_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    size, md5 = F.octet_length("text"), F.md5(F.col("text").cast("binary"))
    manifest = d.select(F.col("doc_id").alias("path"), size.alias("size"), md5.alias("md5"))
    other = F.when(F.col("doc_id") % 7 == 0, "ab-2").when(F.col("doc_id") % 3 == 0, "x").otherwise(md5)
    return checks.reconcile(manifest, d.filter(F.col("doc_id") % 11 > 0).select(F.col("doc_id").alias("path"), (size + (F.col("doc_id") % 5 == 0).cast("int")).alias("size"), other.alias("md5")))


@query("""WITH x AS (SELECT c_custkey, k AS month FROM customer, range(1, 13) r(k)), a AS (SELECT o_custkey AS c_custkey, month(o_orderdate) AS month, count(*) AS actual, count(*) FILTER (o_orderstatus = 'P') AS zeros FROM orders GROUP BY ALL),
    j AS (SELECT c_custkey, month, coalesce(actual, 0) AS actual, coalesce(zeros, 0) AS bad, CASE WHEN coalesce(actual, 0) = 0 THEN 'total_missing' WHEN coalesce(actual, 0) < 1 OR coalesce(zeros, 0) > 0 THEN 'partial_missing' ELSE 'complete' END AS status FROM x LEFT JOIN a USING (c_custkey, month)),
    w AS (SELECT *, CASE WHEN status = 'total_missing' THEN 0 ELSE 2 END AS expected FROM j), m AS (SELECT *, greatest(expected - actual, 0) AS missing FROM w)
    SELECT c_custkey, month, expected, actual, missing, CASE WHEN expected > 0 THEN round(missing * 100 / expected::DOUBLE, 4) ELSE 0.0::DOUBLE END AS missing_pct, status, CASE WHEN status = 'total_missing' THEN c_custkey % 3 = 0 ELSE status = 'complete' END AS known,
      CASE WHEN actual > 0 THEN round(bad * 100 / actual::DOUBLE, 4) ELSE 0.0::DOUBLE END AS zero_or_null_pct, missing + bad AS effective_missing, CASE WHEN expected > 0 THEN round((missing + bad) * 100 / expected::DOUBLE, 4) ELSE 0.0::DOUBLE END AS effective_missing_pct FROM m""")
def missing_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    expected = c.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12)))).withColumn("expected", F.lit(2))
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"), F.month("o_orderdate").alias("month"))
    actual = o.agg(F.count(F.lit(1)).alias("actual"), F.sum((F.col("o_orderstatus") == "P").cast("long")).alias("zeros"), F.lit(0).alias("nulls"))
    known = expected.filter(F.col("c_custkey") % 3 == 0)
    return audit.missingness(expected, actual, ["c_custkey", "month"], known)


@query(f"""WITH {E}, g AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS step FROM (SELECT user_id, value, t / 1000000 AS t FROM e))
    SELECT user_id, count(*) AS actual, count(*) FILTER (value < 1) AS low, min(t) AS first_t, max(t) AS last_t, round(1 / quantile_cont(step, 0.5) FILTER (step > 0), 12) AS sample_rate_hz FROM g GROUP BY 1""")
def sample_rate_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir).withColumn("t", F.col("t") / 1000000).withColumn("value", F.when(F.col("value") < 1, 0.0).otherwise(F.col("value")))
    return audit.signal_scan(rows, KEYS, zero_check=True).select("user_id", "actual", F.col("zeros").alias("low"), "first_t", "last_t", F.round("sample_rate_hz", 12).alias("sample_rate_hz"))


@query(f"""WITH {E}, a AS (SELECT user_id, arg_min(t / 1000000, t) AS start_s, arg_max(t / 1000000, t) AS end_s FROM e GROUP BY 1) SELECT user_id, start_s, end_s, end_s - start_s AS duration_s, start_s - user_id AS start_offset_s, end_s - 2592000.0::DOUBLE AS end_offset_s FROM a""")
def time_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir).withColumn("row", F.col("t")).withColumn("t", F.col("t") / 1000000)
    sessions = rows.select("user_id").distinct().select("user_id", F.col("user_id").cast("double").alias("session_start_s"), F.lit(2592000.0).alias("session_end_s"))
    return audit.timing(rows, KEYS, sessions, KEYS)


@query("SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')")
def anti_known_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    skipped = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return audit.without_skipped(table(spark, sf_dir, "customer").select("c_custkey"), skipped, ["c_custkey"])


@query("""(SELECT c_nationkey AS nation, 'left' AS side FROM customer WHERE c_nationkey % 3 > 0 EXCEPT SELECT s_nationkey, 'left' FROM supplier WHERE s_nationkey % 4 > 0) UNION ALL (SELECT s_nationkey, 'right' FROM supplier WHERE s_nationkey % 4 > 0 EXCEPT SELECT c_nationkey, 'right' FROM customer WHERE c_nationkey % 3 > 0)""")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").filter("c_nationkey % 3 > 0").select(F.col("c_nationkey").alias("nation"))
    return checks.difference(a, table(spark, sf_dir, "supplier").filter("s_nationkey % 4 > 0").select(F.col("s_nationkey").alias("nation")), "nation")


@query("SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_nationkey % 2 = 0")
def intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).intersect(table(spark, sf_dir, "supplier").filter("s_nationkey % 2 = 0").select("s_nationkey"))


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).union(table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


ALIGN = "WITH a AS (SELECT conv_id, role, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn {o}) AS k FROM conversations), n AS (SELECT conv_id, min(c) AS n FROM (SELECT conv_id, role, count(*) AS c FROM conversations GROUP BY ALL) GROUP BY 1) SELECT conv_id, role, turn, {p} AS position FROM a JOIN n USING (conv_id) WHERE k <= n"


@query(ALIGN.format(o="DESC", p="n - k"))
def tail_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.tail_aligned(table(spark, sf_dir, "conversations").select("conv_id", "role", "turn"), ["conv_id"], "role", "turn")


@query(ALIGN.format(o="", p="k - 1"))
def head_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.head_aligned(table(spark, sf_dir, "conversations").select("conv_id", "role", "turn"), ["conv_id"], "role", "turn")


# -- features and models --------------------------------------------------------------------------


@query(f"""WITH {E}, g AS (SELECT *, value - lag(value) OVER (PARTITION BY user_id ORDER BY t) AS dd FROM e) SELECT user_id, count(*) AS n, round(stddev_samp(value), 6) AS sdnn, round(sqrt(avg(dd * dd)), 6) AS rmssd, round(avg((abs(dd) > 50)::INT), 9) AS pnn50 FROM g GROUP BY 1""")
def hrv(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.variability(samples(spark, sf_dir), KEYS)
    return out.withColumns({"sdnn": F.round("sdnn", 6), "rmssd": F.round("rmssd", 6), "pnn50": F.round("pnn50", 9)})


@query(f"""WITH {E}, g AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY t) - 1 AS idx FROM e) SELECT user_id, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(regr_slope(value, idx / 4.0::DOUBLE), 6) AS slope FROM g GROUP BY 1""")
def slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    rows = samples(spark, sf_dir).withColumn("idx", F.row_number().over(Window.partitionBy("user_id").orderBy("t")) - 1)
    return features.trend(rows, KEYS, 4.0).withColumns({c: F.round(c, 6) for c in ("mean", "std", "slope")})


@query(f"""WITH {E}, a AS (SELECT *, value - lag(value) OVER (PARTITION BY user_id ORDER BY t) AS dx FROM e), b AS (SELECT *, dx - lag(dx) OVER (PARTITION BY user_id ORDER BY t) AS ddx FROM a)
    SELECT user_id, round(sqrt(var_pop(dx) / var_pop(value)), 6) AS mobility, round(sqrt(var_pop(ddx) / var_pop(dx)) / sqrt(var_pop(dx) / var_pop(value)), 6) AS complexity FROM b GROUP BY 1""")
def hjorth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.hjorth(samples(spark, sf_dir), KEYS, "t").withColumns({c: F.round(c, 6) for c in ("mobility", "complexity")})


@query("""WITH x AS (SELECT vec_id, unnest(range(64)) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings), m AS (SELECT pos, avg(x) AS m, stddev_pop(x) AS s FROM x GROUP BY 1) SELECT vec_id, pos::INT AS pos, round((x - m) / s, 6) AS z FROM x JOIN m USING (pos)""")
def impute_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml.scaled_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding").withColumn("z", F.round("z", 6))


@query("""WITH x AS (SELECT label, (1 + vec_id % 4)::DOUBLE AS w, embedding AS v FROM embeddings), p AS (SELECT i, j FROM range(3) a(i), range(3) b(j) WHERE i <= j),
    s AS (SELECT label, i, j, sum(w) AS sw, sum(w * v[i + 1]::DOUBLE) AS si, sum(w * v[j + 1]::DOUBLE) AS sj, sum(w * v[i + 1]::DOUBLE * v[j + 1]::DOUBLE) AS sij FROM x, p GROUP BY ALL)
    SELECT label, i::INT AS i, j::INT AS j, round(si / sw, 8) AS mean_i, round(sj / sw, 8) AS mean_j, round(sij / sw - si / sw * (sj / sw), 8) AS cov FROM s""")
def weighted_mean_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn("w", 1 + F.col("vec_id") % 4)
    return stats.weighted_moments(rows, ["label"], "embedding", "w", 3).withColumns({c: F.round(c, 8) for c in ("mean_i", "mean_j", "cov")})


@query("""WITH m AS (SELECT label, vec_id % 6 AS e, """ + ", ".join(f"avg(embedding[{k}]::DOUBLE) AS x{k}" for k in (1, 2, 3)) + """ FROM embeddings GROUP BY ALL), p AS (SELECT label * 6 + e AS id, label % 3 AS c, [x1, x2, x3] AS x FROM m),
    d AS (SELECT a.id, a.c AS ca, b.c AS cb, avg(list_distance(a.x, b.x)) AS d FROM p a JOIN p b ON a.id <> b.id GROUP BY ALL), o AS (SELECT id, max(d) FILTER (ca = cb) AS i, min(d) FILTER (ca <> cb) AS o FROM d GROUP BY 1) SELECT round(avg((o - i) / greatest(o, i)), 6) AS silhouette FROM o""")
def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    means = e.groupBy("label", (F.col("vec_id") % 6).alias("e")).agg(F.array(*[F.avg(F.col("embedding")[k].cast("double")) for k in range(3)]).alias("x"))
    return ml.silhouette(means.select((F.col("label") * 6 + F.col("e")).alias("id"), "x", (F.col("label") % 3).alias("c")), "id", "x", "c").select(F.round("silhouette", 6).alias("silhouette"))


@query("""SELECT label, """ + ", ".join(f"round(coalesce(avg(embedding[{v}]::DOUBLE) FILTER (vec_id % 3 = {m}), 0), 8) AS m{m}_lda_{v}" for m in (0, 1, 5) for v in (1, 2, 3)) + " FROM embeddings GROUP BY 1")
def entity_means_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("label", F.concat(F.lit("m"), F.col("vec_id") % 3).alias("m"), *[F.col("embedding")[k].cast("double").alias(f"lda_{k + 1}") for k in range(3)])
    out = ml.entity_means(rows, "label", "m", ["lda_1", "lda_2", "lda_3"], ["m0", "m1", "m5"])
    return out.select("label", *[F.round(c, 8).alias(c) for c in out.columns if c != "label"])


@query("""WITH a AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT event_id, user_id, CASE WHEN r > n - least(greatest(1, cast(floor(n * 0.2::DOUBLE) AS BIGINT)), n - 1) THEN 'test' ELSE 'train' END AS part FROM a""")
def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.split(table(spark, sf_dir, "events").select("event_id", "user_id"), KEYS, "event_id", 0.2)


def windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    rows = samples(spark, sf_dir).withColumn("idx", F.row_number().over(Window.partitionBy("user_id").orderBy("t")) - 1)
    return timewin.by_count(rows, KEYS, F.col("idx"), 32)


@query()
def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.pulse(windowed(spark, sf_dir), ["user_id", "window_id"], 8.0)


@query()
def skin_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.skin(windowed(spark, sf_dir), ["user_id", "window_id"], 4.0)


@query()
def band_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.spectra(windowed(spark, sf_dir), ["user_id", "window_id"], 256.0)


@query()
def eeg_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = windowed(spark, sf_dir).select(F.lit("e01").alias("entity_id"), (F.col("user_id") % 5).alias("trial"), F.col("user_id").alias("channel"), F.col("idx").alias("t"), "value")
    part = ["entity_id", "trial", "channel", "window_id"]
    noise = features.noise(rows.withColumn("window_id", timewin.whole(F.col("t"), 32)), part, 512.0)
    return quality.eeg(rows, ["entity_id"], 32.0, 1.0, noise)


def vectors(spark: SparkSession, sf_dir: str, dims: int = 64) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", (F.col("vec_id") % 4).alias("entity"), *[F.col("embedding")[k].cast("double").alias(f"x{k}") for k in range(dims)])


@query()
def lda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml.lda(vectors(spark, sf_dir), ["entity"], "label", [f"x{k}" for k in range(64)], ["vec_id"])


@query()
def pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"x{k}" for k in range(64)]
    rows = vectors(spark, sf_dir)
    scaled = ml.scale(ml.impute(rows, rows, names), rows, names)
    return ml.pca(scaled, scaled, names).select("vec_id", "pc")


@query()
def kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = vectors(spark, sf_dir).groupBy((F.col("label") * 4 + F.col("entity")).alias("id")).agg(*[F.avg(f"x{k}").alias(f"x{k}") for k in range(64)])
    return ml.kmeans(means, "id", [f"x{k}" for k in range(64)], range(2, 42))[0]


@query()
def hmm_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = samples(spark, sf_dir, "event_type")
    rows = ml.dense_labels(e, "event_type", "state").select(
        (F.col("user_id") % 4).alias("entity"), F.col("user_id").alias("sequence"), "t", "state", F.array(F.col("value"), F.log1p("value")).alias("x"), F.lit(0.8).alias("q"), F.when(F.col("user_id") % 5 == 0, "test").otherwise("train").alias("part")
    )
    return ml.hmm(rows, "entity", "sequence", "t", "state", ["x"], ["q"])


from tidegauge.plans import layer_queries as _layer_queries  # noqa: E402, F401  (registers its queries here)
