"""Whole stages: all signals of a dataset at once, from samples or files to tables of flags, reports and features."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators import audit, checks, features, fusion, ml, quality, stats, timewin
from tidegauge.operators.quality import SECOND, Windows
from tidegauge.session import Config
from tidegauge.sources import readers

ID = ["entity_id"]


@dataclass(frozen=True)
class Signal:
    """How one kind of signal is flagged: its operator, declared rate, lookback in seconds and modality."""

    build: Callable[..., DataFrame]
    rate: float | None = None
    look_s: float | None = None
    modality: str = "physio"
    options: dict = field(default_factory=dict)


#: Declared rates and lookbacks.
SIGNALS: dict[str, Signal] = {
    "E4_ACC": Signal(quality.acc, 32),
    "E4_BVP": Signal(quality.bvp, 64),
    "E4_EDA": Signal(quality.eda, 4, 30),
    "E4_HR": Signal(quality.hr, 1, 10),
    "Polar_HR": Signal(quality.hr, 1, 10),
    "E4_IBI": Signal(quality.ibi, None, 10),
    "E4_TEMP": Signal(quality.temp, 4, 30),
    "Attention": Signal(quality.attention, None, 10, "eeg"),
    "Meditation": Signal(quality.attention, None, 10, "eeg"),
    "BrainWave": Signal(quality.brainwave, None, None, "eeg", {"bands": list(readers.BANDS)}),
}


def signal_flags(
    samples: dict[str, DataFrame],
    width_s: float,
    count: int,
    skipped: DataFrame | None = None,
    signals: dict[str, Signal] = SIGNALS,
    only: set[str] | None = None,
    config: Config | None = None,
    first: int | None = None,
) -> dict[str, DataFrame]:
    """Flags of each signal for all entities in one plan each.

    samples: signal -> (entity_id, t in microseconds, value, x, y, z or bands); skipped: entity_id, signal_type that
    are known to be missing. Heart rate gets the BVP flag of its window where both are there. A configuration gives
    the signals, the first entity and thresholds by signal; `first` is a test mode of so many entities.
    """
    config = config or Config()
    only = only or set(config.signals) or None
    out: dict[str, DataFrame] = {}
    for name in [s for s in signals if s in samples and (only is None or s in only)]:
        s, rows = signals[name], audit.chosen_entities(samples[name], "entity_id", config.start_from, first)
        if skipped is not None:
            rows = audit.without_skipped(rows, skipped.filter(F.col("signal_type") == name), ID)
        windows = Windows(round(width_s * SECOND), count, None if s.look_s is None else round(s.look_s * SECOND))
        args = [] if s.rate is None else [s.rate]
        more = {"bvp_flags": out["E4_BVP"]} if name == "E4_HR" and "E4_BVP" in out else {}
        out[name] = s.build(rows, ID, windows, *args, **s.options, **config.thresholds.get(name, {}), **more)
    return out


def signals_from_files(spark: SparkSession, root: str, sessions: DataFrame, unit_per_s: float = 1000.0) -> dict[str, DataFrame]:
    """Samples of each signal from the CSV files below a root, one name for each signal: what signal_flags wants.

    sessions: entity_id, session_start_s. A signal without any file is left out.
    """
    names = {r[0] for r in readers.inventory(spark, root, "*.csv").select(F.regexp_extract("path", r"([^/]+)\.csv$", 1)).distinct().collect()}  # a name for each signal
    columns = {"E4_ACC": ["x", "y", "z"], "BrainWave": list(readers.BANDS)}
    return {s: readers.signal_files(spark, root, f"{s}.csv", columns.get(s, ["value"]), sessions, unit_per_s) for s in SIGNALS if s in names}


def session_audio(samples: DataFrame, sessions: DataFrame, width_s: float = 1.0, skipped: DataFrame | None = None, **limits: float) -> DataFrame:
    """Flags of audio cut to the session. samples: entity_id, file_id, idx, value, rate. sessions: entity_id, duration_s."""
    rows = samples if skipped is None else samples.join(skipped.filter("signal_type = 'audio'").select("entity_id"), "entity_id", "left_anti")
    rows = rows.join(sessions.select("entity_id", "duration_s"), "entity_id").filter(
        F.col("idx") < F.bround(F.col("duration_s") * F.col("rate")),
    ).drop("duration_s")
    return quality.audio(rows, ["entity_id", "file_id"], "rate", width_s, **limits)


def session_video(
    frames: DataFrame,
    sessions: DataFrame,
    fps: float,
    width_s: float = 1.0,
    skipped: DataFrame | None = None,
    **limits: tuple,
) -> DataFrame:
    """Flags of video for as many windows as the session has. frames: entity_id, frame, lap_var, clipped_ratio, face."""
    rows = frames if skipped is None else frames.join(skipped.filter("signal_type = 'video'").select("entity_id"), "entity_id", "left_anti")
    counts = sessions.join(rows.select("entity_id").distinct(), "entity_id", "left_semi").select(
        "entity_id",
        timewin.expected_windows(F.col("duration_s"), width_s).alias("count"),
    )
    return quality.video(rows, ID, fps, width_s, counts, **limits)


def trial_flags(
    samples: dict[str, DataFrame], fps: float, eeg_rate: float, width_s: float = 1.0, trial_s: float = 20.0, skipped: DataFrame | None = None, only: set[str] | None = None, eeg_noise: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Flags of trial data. samples: eeg (entity_id, trial, channel, t, value), audio (entity_id, trial_id, idx, value, rate)
    and video (entity_id, trial_id, frame and its metrics); skipped: entity_id, unit_id, signal_type known to be missing."""
    out: dict[str, DataFrame] = {}
    for name in [s for s in ("eeg", "audio", "video") if s in samples and (only is None or s in only)]:
        rows, trial = samples[name], "trial" if name == "eeg" else "trial_id"
        if skipped is not None:
            rows = rows.join(
                skipped.filter(F.col("signal_type") == name).select("entity_id", F.col("unit_id").alias(trial)),
                ["entity_id", trial],
                "left_anti",
            )
        if name == "eeg":
            out[name] = quality.eeg(rows, ID, eeg_rate, width_s, eeg_noise)
        elif name == "audio":
            out[name] = quality.audio(rows.filter(F.col("idx") < F.bround(F.col("rate") * trial_s)), ["entity_id", trial], "rate", width_s)
        else:
            out[name] = quality.video(rows, ["entity_id", trial], fps, width_s, int(trial_s // width_s))
    return out


def long_flags(flags: dict[str, DataFrame]) -> DataFrame:
    """All signals' flags as (entity_id, window_id, modality, quality_flag, problem_flag)."""
    own = [df.select("entity_id", "window_id", F.lit(name).alias("modality"), "quality_flag", "problem_flag") for name, df in flags.items()]
    out = own[0]
    for df in own[1:]:
        out = out.unionByName(df)
    return out


def flag_report(flags: dict[str, DataFrame], labels: DataFrame, width_s: float) -> tuple[DataFrame, DataFrame]:
    """(summary by signal, session report with the label in force)."""
    long = long_flags(flags)
    summary = quality.summary(long.withColumnRenamed("modality", "signal_type"), ["signal_type"])
    return summary, fusion.session_report(long, labels, list(flags), width_s)


def raw_to_metadata(manifest: DataFrame, inventory: DataFrame, rules: list) -> dict[str, DataFrame]:
    """The first layer's three steps as tables: issues of the raw files, rows to upload, outcome after upload."""
    issues = checks.file_issues(manifest.join(inventory.select("path", "length"), "path", "left"), rules)
    return {
        "issues": issues,
        "status": checks.rollup(issues, ["dataset"]),
        "to_upload": checks.to_upload(manifest, inventory.select("path", F.col("length").alias("size"))),
        "integrity": checks.reconcile(manifest, inventory.select("path", F.col("length").alias("size"), "md5")),
    }


def entity_features(samples: dict[str, DataFrame], rates: dict[str, float]) -> dict[str, DataFrame]:
    """Features of windowed samples (entity_id, window_id, idx, t, value or x, y, z) by signal."""
    keys = ["entity_id", "window_id"]
    build: dict[str, Callable[[DataFrame], DataFrame]] = {
        "E4_ACC": lambda d: features.moments(d, keys, ["x", "y", "z"]),
        "E4_BVP": lambda d: features.pulse(d, keys, rates.get("E4_BVP", 64)),
        "E4_EDA": lambda d: features.skin(d, keys, rates.get("E4_EDA", 4)),
        "E4_TEMP": lambda d: features.trend(d, keys, rates.get("E4_TEMP", 4)),
        "E4_HR": lambda d: features.heart_rate(d, keys),
        "Polar_HR": lambda d: features.heart_rate(d, keys),
        "E4_IBI": lambda d: features.interval_features(d, keys),
        "EEG": lambda d: features.spectra(d, keys, rates.get("EEG", 500)),
    }
    return {s: build[s](d) for s, d in samples.items() if s in build}


def sequence_labels(rows: DataFrame, vectors: list[str], qualities: list[str], seeds: list[int], share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Predictions and scores of the quality-aware HMM over several splits.

    rows: entity_id, trial_id, t, state, vectors, qualities. Returns the predictions with their seed, and for
    each entity the accuracy's mean, deviation and range over seeds.
    """
    trials = rows.groupBy("entity_id", "trial_id").agg(F.min("state").alias("label"))
    out = None
    for seed in seeds:
        part = stats.stratified_split(
            trials.withColumn("stratum", F.struct("entity_id", "label")),
            "stratum",
            "trial_id",
            share,
            seed,
        ).select("entity_id", "trial_id", "part")
        found = ml.hmm(
            rows.join(part, ["entity_id", "trial_id"]),
            "entity_id",
            "trial_id",
            "t",
            "state",
            vectors,
            qualities,
        ).withColumn("seed", F.lit(seed))
        out = found if out is None else out.unionByName(found)
    scores = out.groupBy("entity_id", "seed").agg(F.avg((F.col("state") == F.col("predicted")).cast("double")).alias("accuracy"))
    return out, stats.spread(scores, ["accuracy"], ["entity_id"])


def seed_deltas(scores: DataFrame, base_seed: int) -> DataFrame:
    """Each seed's accuracy less the base seed's, by entity."""
    base = scores.filter(F.col("seed") == base_seed).select("entity_id", F.col("accuracy").alias("base"))
    return scores.join(base, "entity_id").select("entity_id", "seed", "accuracy", (F.col("accuracy") - F.col("base")).alias("delta"))
