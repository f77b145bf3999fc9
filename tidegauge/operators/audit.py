"""What is missing: expected against actual files and samples, and the timing of signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.scalars import finite, status


def known_absent(availability: DataFrame, key: str = "pid") -> DataFrame:
    """(key, signal) of the cells of a wide availability matrix that say FALSE."""
    signals = [c for c in availability.columns if c != key]
    long = availability.select(key, *[F.col(c).cast("string").alias(c) for c in signals]).unpivot([key], signals, "signal", "available")
    return long.filter(F.upper(F.trim("available")) == "FALSE").select(key, "signal")


def known_missing(participants: DataFrame, participant_list: str, signal_list: str) -> DataFrame:
    """Every participant of a row's list with every signal of its list."""
    one = participants.select(F.explode(participant_list).alias("participant"), signal_list)
    return one.select("participant", F.explode(signal_list).alias("signal")).distinct()


def signal_scan(samples: DataFrame, keys: list[str], declared: Column | None = None, zero_check: bool = False) -> DataFrame:
    """Counts of samples, zeros and nulls, first and last time (seconds `t`) and rate: declared, or 1 / median positive step."""
    w = Window.partitionBy(*keys).orderBy("t")
    rows = samples.withColumn("_step", F.col("t") - F.lag("t").over(w)).withColumn("_x", finite(F.col("value")))
    step = F.percentile(F.when(F.col("_step") > 0, F.col("_step")), F.lit(0.5))
    rate = F.coalesce(1 / step, F.lit(1.0))
    own = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("actual"),
        (F.sum((F.col("_x") == 0).cast("long")) if zero_check else F.lit(0).cast("long")).alias("zeros"),
        F.sum(F.col("_x").isNull().cast("long")).alias("nulls"),
        F.min("t").alias("first_t"),
        F.max("t").alias("last_t"),
        rate.alias("_rate"),
    )
    return own.withColumn(
        "sample_rate_hz",
        F.coalesce(F.nullif(declared, F.lit(0.0)), "_rate") if declared is not None else F.col("_rate"),
    ).drop("_rate")


def miss_columns(rows: DataFrame, keys: list[str], more: list[str] | None = None) -> DataFrame:
    """Status and shares of rows (keys, expected, actual, bad, known, too_small and `more` columns, which stay).

    expected may be NULL (not known); actual is NULL or 0 without a usable file; bad: zero or null samples. A key
    without a file is total_missing and shows 0 expected; one whose file is too small shows all as missing.
    """
    n = F.when(F.col("too_small"), 0).otherwise(F.coalesce("actual", F.lit(0)))
    bad = F.when(n > 0, F.coalesce("bad", F.lit(0))).otherwise(0)
    state = F.when(F.col("too_small"), "size_anomaly").otherwise(status(n, F.col("expected"), bad))
    want = F.when(state == "total_missing", 0).otherwise(F.coalesce("expected", F.lit(0)))
    rows = rows.withColumns({"status": state, "_want": want, "_n": n, "_bad": bad}).withColumn(
        "_miss",
        F.when(F.col("_want") > 0, F.greatest(F.col("_want") - F.col("_n"), F.lit(0))).otherwise(0),
    )
    share = lambda a, b: F.when(b > 0, F.round(a * 100 / b, 4)).otherwise(0.0)
    lost = F.col("_miss") + F.col("_bad")
    return rows.select(
        *keys,
        *(more or []),
        F.col("_want").alias("expected"),
        F.col("_n").alias("actual"),
        F.col("_miss").alias("missing"),
        share(F.col("_miss"), F.col("_want")).alias("missing_pct"),
        "status",
        (F.col("known") | (F.col("status") == "complete")).alias("known"),
        share(F.col("_bad"), F.col("_n")).alias("zero_or_null_pct"),
        lost.alias("effective_missing"),
        share(lost, F.col("_want")).alias("effective_missing_pct"),
    )


def missingness(expected: DataFrame, actual: DataFrame, keys: list[str], known: DataFrame | None = None) -> DataFrame:
    """miss_columns of each expected key. expected: keys and `expected` samples; actual: keys, actual, zeros, nulls; known: keys known to be absent.

    A file that is there overrides what was known about its absence.
    """
    rows = expected.join(actual, keys, "left")
    if known is not None:
        rows = rows.join(known.select(*keys).distinct().withColumn("_known", F.lit(True)), keys, "left")
    else:
        rows = rows.withColumn("_known", F.lit(False))
    there = F.coalesce("actual", F.lit(0)) > 0
    rows = rows.withColumns(
        {
            "bad": F.coalesce("zeros", F.lit(0)) + F.coalesce("nulls", F.lit(0)),
            "too_small": F.lit(False),
            "known": F.coalesce("_known", F.lit(False)) & ~there,
        },
    )
    return miss_columns(rows, keys)


def session_missingness(participants: DataFrame, signals: DataFrame, sessions: DataFrame, found: DataFrame, absent: DataFrame) -> DataFrame:
    """The audit of session data: a row for each participant, also those only known as absent, and signal.

    participants: entity_id. signals: signal_type, device, modality, declared_hz. sessions: entity_id,
    session_start_s, session_end_s. found: entity_id, signal_type, sample_rate_hz, actual, zeros, nulls of readable
    files. absent: entity_id, signal_type. Samples are expected for the session's duration at the file's rate.
    """
    keys = ["entity_id", "signal_type"]
    spine = participants.select("entity_id").union(absent.select("entity_id")).distinct().join(signals)  # signals: a few rows of settings
    rows = spine.join(
        sessions.select("entity_id", (F.col("session_end_s") - F.col("session_start_s")).alias("_s")),
        "entity_id",
        "left",
    ).join(found, keys, "left")
    rows = rows.join(absent.select(*keys).distinct().withColumn("_absent", F.lit(True)), keys, "left")
    there = F.col("actual").isNotNull()
    rows = rows.withColumns(
        {
            "unit_id": F.col("entity_id"),
            "sample_rate_hz": F.when(there, F.col("sample_rate_hz")).otherwise(F.coalesce("declared_hz", F.lit(0.0))),
            "expected": F.when(there, F.bround(F.col("_s") * F.col("sample_rate_hz")).cast("long")),
            "bad": F.coalesce("zeros", F.lit(0)) + F.coalesce("nulls", F.lit(0)),
            "too_small": F.lit(False),
            "known": F.coalesce("_absent", F.lit(False)) & ~there,
        }
    )
    return miss_columns(rows, ["entity_id", "unit_id", "signal_type"], ["device", "modality", "sample_rate_hz"])


def trial_missingness(entities: DataFrame, signals: DataFrame, found: DataFrame, known: DataFrame) -> DataFrame:
    """The audit of trial data: a row for each entity, signal and expected trial.

    signals: signal_type, device, modality, first, step, many and digits of the trial ids, duration_s or expected
    samples, min_bytes. found: entity_id, signal_type, unit_id, sample_rate_hz, actual, length (bytes). known:
    entity_id, signal_type known to be missing. A file below min_bytes is a size anomaly.
    """
    keys = ["entity_id", "signal_type", "unit_id"]
    units = signals.withColumn(
        "_k",
        F.explode(F.sequence(F.lit(0), F.col("many") - 1)),
    ).withColumn("_number", F.col("first") + F.col("_k") * F.col("step"))
    units = units.withColumn("unit_id", F.lpad(F.col("_number").cast("string"), F.greatest("digits", F.length(F.col("_number").cast("string"))), "0"))
    spine = entities.select("entity_id").distinct().join(units)  # units: the trials of a few signals
    rows = spine.join(found, keys, "left").join(
        known.select("entity_id", "signal_type").distinct().withColumn("_known", F.lit(True)),
        ["entity_id", "signal_type"],
        "left",
    )
    small = F.coalesce(F.col("length") < F.col("min_bytes"), F.lit(False))
    rows = rows.withColumns(
        {
            "expected": F.coalesce(
                F.col("expected"),
                F.when(F.col("actual").isNotNull(), F.bround(F.col("duration_s") * F.col("sample_rate_hz")).cast("long")),
            ),
            "bad": F.lit(0),
            "too_small": small,
            "known": F.coalesce("_known", F.lit(False)),
        }
    )
    return miss_columns(rows, keys, ["device", "modality", "sample_rate_hz"])


def rates_and_skips(report: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sample rates by key, keys to skip) of a missingness report."""
    keys = ["participant_id", "unit_id", "signal_type"]
    return report.filter("sample_rate_hz is not null").select(*keys, "sample_rate_hz"), report.filter("status = 'total_missing'").select(*keys)


def without_skipped(samples: DataFrame, skipped: DataFrame, keys: list[str]) -> DataFrame:
    return samples.join(skipped.select(*keys), keys, "left_anti")


def with_rates(samples: DataFrame, rates: DataFrame, keys: list[str], declared: float) -> DataFrame:
    """Adds rate: the report's, or the declared one where it is missing or 0."""
    return samples.join(rates.select(*keys, "sample_rate_hz"), keys, "left").withColumn(
        "rate",
        F.coalesce(F.nullif("sample_rate_hz", F.lit(0.0)), F.lit(declared)),
    ).drop("sample_rate_hz")


def timing(samples: DataFrame, keys: list[str], sessions: DataFrame, session_keys: list[str]) -> DataFrame:
    """First and last time in file order (`row`), duration, and offsets from the session's start and end (seconds)."""
    own = samples.filter("t is not null").groupBy(*keys).agg(F.min_by("t", "row").alias("start_s"), F.max_by("t", "row").alias("end_s"))
    rows = own.join(sessions.select(*session_keys, "session_start_s", "session_end_s"), session_keys, "left")
    return rows.select(
        *keys, "start_s", "end_s", (F.col("end_s") - F.col("start_s")).alias("duration_s"), (
            F.col("start_s") - F.col("session_start_s")
        ).alias("start_offset_s"), (F.col("end_s") - F.col("session_end_s")).alias("end_offset_s")
    )


def in_session(samples: DataFrame, sessions: DataFrame, keys: list[str]) -> DataFrame:
    """Samples between session_start_s and session_end_s, both included."""
    return samples.join(sessions, keys).filter(
        F.col("t").between(F.col("session_start_s"), F.col("session_end_s")),
    ).drop("session_start_s", "session_end_s")


def media_timing(headers: DataFrame, keys: list[str]) -> DataFrame:
    """Timing rows of media files (keys, duration_s): they start with their unit; unreadable ones have none."""
    return headers.filter("duration_s is not null").select(
        *keys,
        F.lit(0.0).alias("start_rel_s"),
        F.col("duration_s").alias("end_rel_s"),
        "duration_s",
    )


def instance_timing(arrays: DataFrame, keys: list[str], rate: float, time_axis: int = 0, instance_axis: int = 2) -> DataFrame:
    """Timing rows of array files (keys, shape): one for each instance, named by its number.

    Three axes are read by their place, two are one instance along the longer one; fewer give no rows.
    """
    n = F.size("shape")
    points = F.when(n == 3, F.col("shape")[time_axis]).when(n == 2, F.array_max("shape"))
    many = F.when(n == 3, F.col("shape")[instance_axis]).when(n == 2, 1)
    rows = arrays.withColumns({"_points": points, "_many": many}).filter("_many > 0")
    duration = F.col("_points") / rate
    return rows.select(*keys, duration.alias("duration_s"), F.explode(F.sequence(F.lit(0), (F.col("_many") - 1).cast("int"))).alias("_k")).select(
        *keys, F.format_string("%03d", "_k").alias("unit_id"), F.lit(0.0).alias("start_rel_s"), F.col("duration_s").alias("end_rel_s"), "duration_s"
    )


def status_counts(report: DataFrame, keys: list[str]) -> DataFrame:
    return report.groupBy(*keys, "status").agg(F.count(F.lit(1)).alias("n"))


def chosen_entities(df: DataFrame, key: str = "entity_id", start_from: str | None = None, first: int | None = None) -> DataFrame:
    """Rows of the entities from `start_from` on, of these the first few if `first` is given (a test mode)."""
    out = df if start_from is None else df.filter(F.col(key) >= start_from)
    if first is None:
        return out
    return out.join(out.select(key).distinct().orderBy(key).limit(first), key, "left_semi")
