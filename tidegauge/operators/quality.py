"""Window metrics and quality flags of each kind of signal.

Samples are rows (keys, t in microseconds since the session's start, value). Every operator returns one
row for each key and window of the spine, empty windows included: window_id, its metrics, quality_flag and
problem_flag. All entities of a signal go through one plan. The sample before is looked up once for each
sample, before it is put into its windows; a difference counts in those windows that hold both samples.
Metrics are rounded to 4 places before the rules read them, deviations and jumps of slow signals to 6; NULL
stands for what can't be computed, such as the deviation of one sample.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import flags as R
from tidegauge.functions.scalars import decibels, finite
from tidegauge.operators import runs, timewin

SECOND = 1_000_000


@dataclass(frozen=True)
class Windows:
    """count output windows of `width` microseconds; metrics look back `look` microseconds (tumbling if None)."""

    width: int
    count: int
    look: int | None = None
    #: Without samples from before the start, windows that reach there are warm-up: NOISY with problem NONE.
    pre_start: bool = True

    def assign(self, samples: DataFrame, t: str = "t") -> DataFrame:
        if self.look is None:
            return timewin.tumbling(samples, F.col(t), self.width, self.count)
        return timewin.lookback(samples, F.col(t), self.width, self.look, self.count)

    def start(self) -> Column:
        """Where the window of a row begins."""
        return (F.col("window_id") + 1) * self.width - (self.look or self.width)

    def with_steps(self, samples: DataFrame, keys: list[str]) -> DataFrame:
        """The windows' rows with diff and gap: value and t less those of the sample before, if that lies in the window."""
        w = Window.partitionBy(*keys).orderBy("t")
        own = samples if self.pre_start else samples.filter("t >= 0")
        rows = self.assign(own.withColumn("_v", F.lag("value").over(w)).withColumn("_t", F.lag("t").over(w)))
        inside = F.col("_t") >= self.start()
        return rows.withColumn(
            "diff",
            F.when(inside, F.col("value") - F.col("_v")),
        ).withColumn("gap", F.when(inside, F.col("t") - F.col("_t"))).withColumnRenamed("_t", "before").drop("_v")

    def warm_up(self) -> Column:
        return F.lit(not self.pre_start) & ((F.col("window_id") + 1) * self.width < (self.look or 0))


def _n4(x: Column) -> Column:
    return F.round(x, 4)


def _n6(x: Column) -> Column:
    return F.round(x, 6)


def _spread(value: str) -> Column:
    """Deviation of two values or more."""
    return _n6(F.when(F.count(value) >= 2, F.stddev_pop(value)))


def _kept(keys: list[str]) -> list[str]:
    return [*keys, "window_id"]


def _finish(samples: DataFrame, metrics: DataFrame, keys: list[str], windows: Windows, rules, extra=(), own: DataFrame | None = None) -> DataFrame:
    """Metrics on the dense spine, with flags; rules: function of nothing that reads the metric columns; own: keys and their own number of windows, _n."""
    spine = timewin.spine(samples.select(*keys).distinct(), windows.count) if own is None else timewin.spine(own, F.col("_n")).drop("_n")
    dense = spine.join(metrics, _kept(keys), "left")
    for name, default in extra:
        dense = dense.withColumn(name, F.coalesce(name, F.lit(default)))
    own = [c for c in dense.columns if c not in _kept(keys)]
    bounds = [
        (F.col("window_id") * windows.width / SECOND).alias("window_start_s"),
        ((F.col("window_id") + 1) * windows.width / SECOND).alias("window_end_s"),
    ]
    return dense.select(*_kept(keys), *bounds, *own, *R.flags(rules()))


def _completeness(n: str, expected: float) -> Column:
    return _n4(F.least(F.lit(1.0), F.col(n) / F.lit(float(expected))))


def _warmed(out: DataFrame, windows: Windows, metric: str) -> DataFrame:
    """Warm-up windows with samples are NOISY and have no problem."""
    warm = windows.warm_up() & F.col(metric).isNotNull()
    return out.withColumn(
        "quality_flag",
        F.when(warm, "NOISY").otherwise(F.col("quality_flag")),
    ).withColumn("problem_flag", F.when(warm, "NONE").otherwise(F.col("problem_flag")))


def acc(
    samples: DataFrame,
    keys: list[str],
    windows: Windows,
    rate: float,
    limit: float = 128,
    clip: float = 126,
    still: float = 0.5,
    rest: float = 64,
    off: float = 10,
) -> DataFrame:
    """Three axes x, y, z. A sample is clipped if one of its axes is; l_max is the longest run of clipped samples."""
    rows = windows.assign(samples).withColumn("ok", finite(F.col("x")).isNotNull() & finite(F.col("y")).isNotNull() & finite(F.col("z")).isNotNull())
    good = F.col("ok")
    m = F.sqrt(F.col("x") ** 2 + F.col("y") ** 2 + F.col("z") ** 2)
    any_axis = lambda most, strict: F.greatest(F.abs("x"), F.abs("y"), F.abs("z")) > most if strict else F.greatest(F.abs("x"), F.abs("y"), F.abs("z")) >= most
    metrics = rows.groupBy(*_kept(keys)).agg(
        F.count(F.lit(1)).alias("n"),
        _n4(F.avg(F.when(good, any_axis(limit, True).cast("double")))).alias("out_ratio"),
        _n4(F.avg(F.when(good, any_axis(clip, False).cast("double")))).alias("clip_ratio"),
        *[F.stddev_pop(F.when(good, F.col(a))).alias(f"_s{a}") for a in "xyz"],
        F.avg(F.when(good, m)).alias("M"),
    )
    clipped = runs.longest_true_run(rows.filter("ok"), _kept(keys), "t", any_axis(clip, False))
    metrics = metrics.join(clipped, _kept(keys), "left").select(
        *_kept(keys),
        _completeness("n", round(rate * windows.width / SECOND)).alias("completeness"),
        "out_ratio",
        "clip_ratio",
        "l_max",
        ((F.col("_sx") < still) & (F.col("_sy") < still) & (F.col("_sz") < still) & (F.abs(F.col("M") - rest) > off)).alias("FLAT"),
        _n4("M").alias("M"),
        _n4("M").alias("M_mean"),
    )
    rules = lambda: R.acc(F.col("completeness"), F.coalesce("out_ratio", F.lit(1.0)), F.col("l_max"), F.col("FLAT"))
    out = _finish(samples, metrics, keys, windows, rules, [("completeness", 0.0), ("l_max", 0)])
    return out.withColumn("FLAT", F.coalesce("FLAT", F.lit(True)))  # nothing moves in a window without samples


def bvp(samples: DataFrame, keys: list[str], windows: Windows, rate: float, share: float = 0.999, **limits: float) -> DataFrame:
    """Clipping is a run at or above the key's own percentile `share` of the whole signal."""
    top = samples.groupBy(*keys).agg(F.percentile(finite(F.col("value")), F.lit(share)).alias("top"))
    rows = windows.assign(samples).withColumn("value", finite(F.col("value"))).join(top, keys)
    metrics = rows.groupBy(*_kept(keys)).agg(
        F.count(F.lit(1)).alias("n"),
        _n4(F.max("value") - F.min("value")).alias("amplitude"),
        _n4(F.stddev_pop("value")).alias("std"),
        _n4(F.when(F.count("value") > 0, F.sum((F.col("value") >= F.col("top")).cast("int")) / F.count(F.lit(1)))).alias("clip_ratio"),
        _n4(F.kurtosis("value") + 3).alias("kurtosis"),
    )
    clipped = runs.longest_true_run(rows.filter("value is not null"), _kept(keys), "t", F.col("value") >= F.col("top"))
    metrics = metrics.join(clipped, _kept(keys), "left").withColumn(
        "completeness",
        _completeness("n", round(rate * windows.width / SECOND)),
    ).drop("n")
    rules = lambda: R.bvp(F.col("completeness"), F.coalesce("amplitude", F.lit(0.0)), F.col("std"), F.col("l_max"), finite(F.col("kurtosis")), **limits)
    return _finish(samples, metrics, keys, windows, rules, [("completeness", 0.0), ("l_max", 0)])


def _smooth(samples: DataFrame, keys: list[str], windows: Windows, rate: float, low: float, high: float) -> DataFrame:
    """completeness, out_ratio, mean_value, sigma_window and max_jump of finite samples."""
    rows = windows.with_steps(samples.filter(finite(F.col("value")).isNotNull()), keys)
    outside = (~F.col("value").between(low, high)).cast("double")
    return rows.groupBy(*_kept(keys)).agg(
        _n4(F.least(F.lit(1.0), F.count(F.lit(1)) / F.lit(float(round(rate * (windows.look or windows.width) / SECOND))))).alias("completeness"),
        _n4(F.avg(outside)).alias("out_ratio"),
        _n4(F.avg("value")).alias("mean_value"),
        _spread("value").alias("sigma_window"),
        _n6(F.max(F.abs("diff"))).alias("max_jump"),
    )


def eda(samples: DataFrame, keys: list[str], windows: Windows, rate: float, low: float = 0.05, high: float = 60, **limits: tuple) -> DataFrame:
    metrics = _smooth(samples, keys, windows, rate, low, high).drop("mean_value")
    rules = lambda: R.eda(F.col("completeness"), F.coalesce("out_ratio", F.lit(1.0)), F.col("sigma_window"), F.col("max_jump"), **limits)
    return _warmed(_finish(samples, metrics, keys, windows, rules, [("completeness", 0.0)]), windows, "out_ratio")


def temp(samples: DataFrame, keys: list[str], windows: Windows, rate: float, low: float = 25, high: float = 36, **limits: tuple) -> DataFrame:
    metrics = _smooth(samples, keys, windows, rate, low, high).withColumnRenamed("mean_value", "mean_temp")
    rules = lambda: R.temp(F.col("completeness"), F.coalesce("out_ratio", F.lit(1.0)), F.col("mean_temp"), F.col("sigma_window"), F.col("max_jump"), **limits)
    return _warmed(_finish(samples, metrics, keys, windows, rules, [("completeness", 0.0)]), windows, "out_ratio")


def hr(samples: DataFrame, keys: list[str], windows: Windows, rate: float, bvp_flags: DataFrame | None = None, **limits: tuple) -> DataFrame:
    """RoC_max is the larger of |p95| and |p5| of differences; with bvp_flags, bvp_quality_flag joins by window. annotation marks warm-up."""
    rows = windows.with_steps(samples.filter(finite(F.col("value")).isNotNull()), keys)
    up = F.percentile("diff", F.lit(0.95))
    down = F.percentile("diff", F.lit(0.05))
    metrics = rows.groupBy(*_kept(keys)).agg(
        _n4(F.least(F.lit(1.0), F.count(F.lit(1)) / F.lit(float(round(rate * (windows.look or windows.width) / SECOND))))).alias("completeness"),
        _n4(F.avg("value")).alias("hr_mean"),
        _spread("value").alias("hr_std"),
        _n4(up).alias("hr_ratio_up"),
        _n4(down).alias("hr_ratio_down"),
        _n4(F.greatest(F.abs(up), F.abs(down))).alias("RoC_max"),
    )
    rules = lambda: R.hr(F.col("completeness"), F.col("hr_mean"), F.col("hr_std"), F.col("RoC_max"), **limits)
    out = _warmed(_finish(samples, metrics, keys, windows, rules, [("completeness", 0.0)]), windows, "hr_mean")
    out = out.withColumn("annotation", F.when(windows.warm_up() & F.col("hr_mean").isNotNull(), "insufficient_warmup").otherwise(""))
    if bvp_flags is None:
        return out
    return out.join(bvp_flags.select(*_kept(keys), F.col("quality_flag").alias("bvp_quality_flag")), _kept(keys), "left")


def ibi(samples: DataFrame, keys: list[str], windows: Windows, low: float = 270, high: float = 2000, **limits: tuple) -> DataFrame:
    """value in milliseconds; gap_before_s is the time since the last sample before the window, 0 if there is none."""
    rows = windows.with_steps(samples.filter(finite(F.col("value")).isNotNull()), keys)
    metrics = rows.groupBy(*_kept(keys)).agg(
        F.count(F.lit(1)).alias("n_ibi"),
        _n4(F.avg((~F.col("value").between(low, high)).cast("double"))).alias("out_ratio"),
        _n4(F.max("gap") / SECOND).alias("g_max_s"),
        _n4(F.min_by(F.col("t") - F.col("before"), "t") / SECOND).alias("gap_before_s"),
    )
    return _finish(
        samples,
        metrics,
        keys,
        windows,
        lambda: R.ibi(F.col("n_ibi"), F.col("out_ratio"), F.col("g_max_s"), **limits),
        [("n_ibi", 0), ("gap_before_s", 0.0)],
    )


def attention(samples: DataFrame, keys: list[str], windows: Windows, top: float = 100, rate: float = 1.0, **limits: float) -> DataFrame:
    """Attention or meditation scores, `rate` a second expected."""
    expected = round(rate * max(windows.look or windows.width, windows.width) / SECOND)
    rows = windows.with_steps(samples.filter(finite(F.col("value")).isNotNull()), keys)
    metrics = rows.groupBy(*_kept(keys)).agg(
        F.count(F.lit(1)).alias("n_window"),
        F.max(F.col("value") == 0).alias("zeros"),
        _n4(F.max(F.abs("diff"))).alias("max_delta"),
        F.sum((F.col("value") == top).cast("long")).alias("c_clip"),
    )
    metrics = metrics.join(runs.longest_run(rows, _kept(keys), "t", F.col("value")), _kept(keys), "left")
    rules = lambda: R.attention(F.col("n_window"), F.col("zeros"), F.col("max_delta"), F.col("c_clip"), F.col("run_max"), expected, **limits)
    return _finish(samples, metrics, keys, windows, rules, [("n_window", 0), ("zeros", False), ("c_clip", 0), ("run_max", 0)])


def brainwave(samples: DataFrame, keys: list[str], windows: Windows, bands: list[str], spike: float = 2.0, least: int = SECOND) -> DataFrame:
    """Band powers: zeros, flat bands (over the last windows where a window has one sample) and power spikes.

    Metrics are computed in windows of `least` microseconds or the output width, if that is more; an output window
    has those of the computing window whose number is the second in which its centre lies, or else of the last one.
    The last sample before the start is the power before the first window.
    """
    inner = Windows(max(least, windows.width), windows.count * windows.width // max(least, windows.width))
    rows = inner.assign(samples)
    total = sum((F.col(b) for b in bands[1:]), F.col(bands[0]))
    zero = F.lit(False)
    for b in bands:
        zero = zero | (F.col(b) == 0)
    still = F.lit(False)
    for b in bands:
        still = still | (F.stddev_pop(b) == 0)
    own = rows.groupBy(*_kept(keys)).agg(
        F.count(F.lit(1)).alias("n"), F.max(zero).alias("zero"), still.alias("still"), F.avg(total).alias("power_"), F.max_by(F.array(*bands), "t").alias("last")
    )
    first = samples.filter("t < 0").groupBy(*keys).agg(F.max_by(total, "t").alias("_first"))
    dense = timewin.spine(samples.select(*keys).distinct(), inner.count).join(own, _kept(keys), "left").join(first, keys, "left")
    w = Window.partitionBy(*keys).orderBy("window_id")
    one, two = F.lag("last", 1).over(w), F.lag("last", 2).over(w)
    same = F.exists(F.arrays_zip(F.col("last").alias("a"), one.alias("b"), two.alias("c")), lambda x: (x["a"] == x["b"]) & (x["b"] == x["c"]))
    before = F.when(F.col("window_id") == 0, F.col("_first")).otherwise(F.lag("power_").over(w))
    dense = dense.withColumn("flat", F.when(F.col("n") >= 2, F.col("still")).when(one.isNotNull() & two.isNotNull(), same).otherwise(False))
    dense = dense.withColumn("_before", before).withColumn("power_ratio_", F.when(F.col("_before") > 0, F.col("power_") / F.col("_before")))
    found = dense.select(
        *keys,
        F.col("window_id").alias("_inner"),
        F.coalesce("zero", F.lit(False)).alias("zero"),
        F.coalesce("flat", F.lit(False)).alias("flat"),
        F.coalesce(F.col("power_ratio_") > spike, F.lit(False)).alias("spike"),
        _n4("power_").alias("power"),
        _n4("power_ratio_").alias("power_ratio"),
        F.col("n").isNull().alias("_empty"),
    )
    centre = timewin.whole(F.col("window_id") * windows.width + windows.width // 2, least)
    out = timewin.spine(samples.select(*keys).distinct(), windows.count).withColumn("_inner", F.least(centre, F.lit(inner.count - 1)))
    metrics = out.join(found, [*keys, "_inner"], "left").drop("_inner")
    rules = lambda: [*R.brainwave(F.col("zero"), F.col("flat"), F.col("spike")), (F.coalesce("_empty", F.lit(True)), "BAD", "ARTIFACT")]
    return _finish(samples, metrics, keys, windows, rules).drop("_empty")


def eeg(samples: DataFrame, keys: list[str], rate: float, width_s: float, noise: DataFrame | None = None) -> DataFrame:
    """samples: keys, trial, channel, t (sample index), value. noise: keys, trial, channel, window_id, rNSR (see features.noise_ratio).

    The z-score of rNSR is robust and taken over all windows and channels of one (keys, trial).
    """
    size = round(rate * width_s)
    part = [*keys, "trial", "channel"]
    rows = samples.withColumn("window_id", timewin.whole(F.col("t"), size)).withColumn("x", finite(F.col("value")))
    metrics = rows.groupBy(*part, "window_id").agg(
        F.count("x").alias("samples"), F.max(F.col("x").isNull()).alias("nan_present"), F.round(F.stddev_pop("x"), 6).alias("std"), _n4(F.max("x") - F.min("x")).alias("peak_to_peak"), F.count(F.lit(1)).alias("_all")
    )
    metrics = metrics.join(
        runs.longest_run(rows.filter("x is not null"), [*part, "window_id"], "t", F.col("x"), "max_run"),
        [*part, "window_id"],
        "left",
    )
    metrics = metrics.filter(F.col("_all") == size).drop("_all")
    if noise is None:
        metrics = metrics.withColumn("rNSR", F.lit(None).cast("double"))
    else:
        metrics = metrics.join(noise, [*part, "window_id"], "left")
    metrics = robust_z(metrics, [*keys, "trial"], "rNSR", "rNSR_zscore").withColumn("rNSR_zscore", _n4("rNSR_zscore"))
    rules = R.eeg(
        F.col("samples"),
        size,
        F.col("nan_present"),
        F.col("std"),
        F.col("rNSR"),
        F.col("rNSR_zscore"),
        F.coalesce("max_run", F.lit(0)),
        F.col("peak_to_peak"),
    )
    return metrics.select(
        *part,
        "window_id",
        "samples",
        "std",
        F.coalesce("max_run", F.lit(0)).alias("max_run"),
        "peak_to_peak",
        "rNSR",
        "rNSR_zscore",
        *R.flags(rules),
    )


def robust_z(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """(x - median) / (1.4826 MAD) within each key; NULL if there are under two values or the MAD is 0.

    Two grouped passes that join back, so no key has to fit one sorted window.
    """
    half = F.lit(0.5)
    mid = df.groupBy(*keys).agg(F.percentile(value, half).alias("_mid"), F.count(value).alias("_n"))
    with_mid = df.join(mid, keys, "left")
    mad = with_mid.groupBy(*keys).agg(F.percentile(F.abs(F.col(value) - F.col("_mid")), half).alias("_mad"))
    z = F.when((F.col("_n") >= 2) & (F.col("_mad") > 0), (F.col(value) - F.col("_mid")) / (1.4826 * F.col("_mad")))
    return with_mid.join(mad, keys, "left").withColumn(name, z).drop("_mid", "_n", "_mad")


def audio(samples: DataFrame, keys: list[str], rate: float | str, width_s: float, clip: float = 0.999) -> DataFrame:
    """samples: keys, idx, value. rate: of all files, or the column that has each file's.

    snr_db is against the file's noise floor, the 10th percentile of its windows' linear RMS. Whole windows only.
    """
    hz = F.col(rate) if isinstance(rate, str) else F.lit(float(rate))
    samples = samples.withColumn("_size", F.round(hz * width_s).cast("long")).withColumn("_hz", hz)
    part = [*keys, "window_id"]
    rows = timewin.by_count(samples.filter("_size > 0"), keys, F.col("idx"), F.col("_size"))
    metrics = rows.groupBy(*part).agg(
        F.sqrt(F.avg(F.col("value") ** 2)).alias("_rms"),
        _n6(F.avg((F.abs("value") < 1e-6).cast("double"))).alias("zero_ratio"),
        _n6(F.avg((F.abs("value") >= clip).cast("double"))).alias("clip_ratio"),
        F.first("_size").alias("_size"),
        F.first("_hz").alias("_hz"),
    )
    metrics = metrics.withColumn("rms_db", _n4(decibels(F.col("_rms"))))
    metrics = metrics.join(runs.longest_true_run(rows, part, "idx", F.abs("value") >= clip, "clip_run_max"), part, "left")
    floor = metrics.groupBy(*keys).agg(F.greatest(F.percentile("_rms", F.lit(0.1)), F.lit(1e-12)).alias("_floor"))
    rules = R.audio(F.col("rms_db"), F.col("zero_ratio"), F.col("clip_ratio"), F.col("clip_run_max"))
    snr = _n4(F.when(F.col("_rms") > 1e-12, 20 * F.log10(F.col("_rms") / F.col("_floor"))).otherwise(-120.0))
    at = lambda k: F.round(k * F.col("_size") / F.col("_hz"), 3)
    bounds = [at(F.col("window_id")).alias("window_start_s"), at(F.col("window_id") + 1).alias("window_end_s")]
    return metrics.join(floor, keys).select(
        *part,
        *bounds,
        "rms_db",
        "zero_ratio",
        "clip_ratio",
        "clip_run_max",
        *R.flags(rules),
        snr.alias("snr_db"),
    )


def video(
    frames: DataFrame,
    keys: list[str],
    fps: float,
    width_s: float,
    count: int | DataFrame,
    blur: tuple = (40.0, 20.0),
    clipped: tuple = (0.01, 0.03),
    face: tuple = (0.78, 0.5),
    whole: bool = False,
) -> DataFrame:
    """frames: keys, frame, lap_var, clipped_ratio, face. count: windows of each key, or a table (keys, count).

    Windows without frames are BAD; whole: keys with frames beyond `count` windows have as many more. The limits are those
    of GOOD and of NOISY; a NOISY window has no problem. The rules read unrounded means.
    """
    size = max(1, round(fps * width_s))
    rows = frames.withColumn("window_id", timewin.whole(F.col("frame"), size))
    if isinstance(count, DataFrame):
        own = count.select(*keys, F.col("count").alias("_n"))
        rows = rows.join(own, keys).filter("window_id < _n").drop("_n")
        own = own.filter("_n > 0")
    elif whole:
        own = rows.groupBy(*keys).agg(F.greatest(F.lit(count), F.max("window_id") + 1).alias("_n"))
    else:
        rows, own = rows.filter(F.col("window_id") < count), None
    windows = Windows(round(width_s * SECOND), count if isinstance(count, int) else 0)
    metrics = rows.groupBy(*_kept(keys)).agg(
        F.avg("lap_var").alias("window_blur"),
        F.avg("clipped_ratio").alias("window_clipping"),
        F.avg("face").alias("face_detection_rate"),
    )
    out = _finish(
        frames,
        metrics,
        keys,
        windows,
        lambda: R.video(F.col("window_blur"), F.col("window_clipping"), F.col("face_detection_rate"), blur, clipped, face),
        own=own,
    )
    return out.withColumns(
        {"window_blur": _n4("window_blur"), "window_clipping": _n6("window_clipping"), "face_detection_rate": _n4("face_detection_rate")},
    )


def summary(flags: DataFrame, keys: list[str]) -> DataFrame:
    """Windows by quality: counts and percentages; other flags are ignored and empty groups dropped."""
    n = {q: F.sum((F.col("quality_flag") == q).cast("long")) for q in R.QUALITIES}
    out = flags.groupBy(*keys).agg(*[v.alias(q.lower()) for q, v in n.items()]).withColumn(
        "total_windows",
        F.col("good") + F.col("noisy") + F.col("bad"),
    )
    return out.filter("total_windows > 0").select(
        *keys,
        "total_windows",
        "good",
        "noisy",
        "bad",
        *[F.round(F.col(q.lower()) * 100 / F.col("total_windows"), 2).alias(f"{q.lower()}_pct") for q in R.QUALITIES],
    )
