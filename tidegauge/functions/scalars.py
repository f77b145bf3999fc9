"""Scalar functions of identifiers, paths, scores and classes, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMOTIONS = ("Neutral", "Calm", "Happiness", "Anger", "Sadness")


def canonical_id(n: Column) -> Column:
    return F.format_string("e%02d", n)


def id_number(raw: Column, pattern: str = r"^p?(\d+)$") -> Column:
    """The number in an id, case aside; NULL if the pattern doesn't match."""
    return F.regexp_extract(raw, f"(?i){pattern}", 1).try_cast("int")


def resolve_id(raw: Column, pattern: str = r"^p?(\d+)$", separator: str = "_") -> Column:
    """Canonical ids of a raw id, an array: one, two of a pair joined by the separator, or none."""
    number = id_number(raw, pattern)
    parts = F.split(raw, separator)
    numbers = F.transform(parts, lambda x: id_number(x, pattern))
    pair = (F.size(parts) > 1) & F.forall(numbers, lambda x: x.isNotNull())
    none = F.array().cast("array<string>")
    return F.when(number.isNotNull(), F.array(canonical_id(number))).when(pair, F.transform(numbers, canonical_id)).otherwise(none)


def id_format(raw: Column, pattern: str = r"^p?(\d+)$", separator: str = "_") -> Column:
    found = F.size(resolve_id(raw, pattern, separator))
    return F.when(raw.rlike(r"^e\d{2}$"), "canonical").when(found > 1, "dyadic").when(found == 1, "single").otherwise("unknown")


def rewritten_path(path: Column, old: str, new: str, entity: Column) -> Column:
    """The first prefix swapped and the entity segment replaced."""
    swapped = F.when(path.startswith(old), F.concat(F.lit(new), F.substring(path, F.lit(len(old) + 1), F.length(path)))).otherwise(path)
    return F.regexp_replace(swapped, F.lit("entity=[^/]+"), F.concat(F.lit("entity="), entity))


def path_part(path: Column, key: str) -> Column:
    """The value of a `key=value` segment; NULL if there is none."""
    return F.nullif(F.regexp_extract(path, f"(?:^|/){key}=([^/]+)", 1), F.lit(""))


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)


#: The file stem of each signal's flags.
SIGNAL_STEMS = {
    "E4_BVP": "biosignal_bvp",
    "E4_EDA": "biosignal_eda",
    "E4_ACC": "biosignal_acc",
    "E4_HR": "biosignal_hr",
    "E4_IBI": "biosignal_ibi",
    "E4_TEMP": "biosignal_temp",
    "BrainWave": "biosignal_brainwave",
    "Attention": "biosignal_attention",
    "Meditation": "biosignal_meditation",
    "Polar_HR": "biosignal_polar_hr",
    "eeg": "biosignal_eeg",
    "audio": "audio",
    "video": "video",
}


def flags_file_name(entity: Column, signal: str) -> Column:
    """Name of the file of a signal's flags; a signal without a stem of its own gets one from its name."""
    return F.concat(entity, F.lit(f"_{SIGNAL_STEMS.get(signal, f'biosignal_{signal.lower()}')}_quality_flags.csv"))


def signal_of_path(path: Column) -> Column:
    """The signal whose stem a flags file's name is or ends in; else the path's modality, else unknown."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), "_quality_flags\\.csv", "")
    known = [F.when((stem == own) | stem.endswith(f"_{own}"), name) for name, own in SIGNAL_STEMS.items()]
    return F.coalesce(*known, path_part(path, "modality"), F.lit("unknown"))


def dataset_of_path(path: Column, prefix: str) -> Column:
    """The segment behind a prefix."""
    return F.split(F.regexp_replace(F.substring(path, len(prefix) + 1, 1 << 20), "^/+", ""), "/")[0]


def trial_id(file_name: Column) -> Column:
    """The number before the first underscore, NULL if there is none."""
    return F.regexp_extract(file_name, r"^(\d+)_", 1).try_cast("int")


def trial_unit(file_name: Column) -> Column:
    """The digits before the first underscore as they stand, or else the file's stem."""
    return F.coalesce(F.nullif(F.regexp_extract(file_name, r"^(\d+)_", 1), F.lit("")), file_stem(file_name))


def participant_number(entity: Column) -> Column:
    return F.substring(entity, 2, 9).try_cast("int")


def trial_window_key(trial: Column, window: Column) -> Column:
    return F.format_string("%03d_%02d", trial, window)


def trial_of_key(key: Column) -> Column:
    return F.split(key, "_")[0].try_cast("int")


def window_of_key(key: Column) -> Column:
    return F.split(key, "_")[1].try_cast("int")


def expected_trials(start: int | Column, step: int, count: int, pattern: str = "%03d") -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda k: F.format_string(pattern, k * step + start))


def flag_score(flag: Column) -> Column:
    return F.when(flag == "GOOD", 1.0).when(flag == "NOISY", 0.5).when(flag == "BAD", 0.1).otherwise(0.5)


def worst_flag(flags: Column) -> Column:
    return F.when(F.array_contains(flags, "BAD"), "BAD").when(F.array_contains(flags, "NOISY"), "NOISY").when(F.array_contains(flags, "GOOD"), "GOOD")


def quadrant(valence: Column, arousal: Column, centre: float = 0.0) -> Column:
    """Emotion of a point; borders go to the first of Happiness, Anger, Calm, Sadness; NULL if a score is."""
    v, a = valence - centre, arousal - centre
    return F.when((v >= 0) & (a >= 0), "Happiness").when((v <= 0) & (a >= 0), "Anger").when((v >= 0) & (a <= 0), "Calm").when((v <= 0) & (a <= 0), "Sadness")


def aligned(score: Column, low: Column, high: Column) -> Column:
    """Whether a score fits its class: 0 never does, a missing score or bound is no objection."""
    return ~F.coalesce((score == 0) | (score < low) | (score > high), F.lit(False))


def decibels(rms: Column) -> Column:
    return F.when(rms > 1e-12, 20 * F.log10(rms)).otherwise(-120.0)


def finite(x: Column) -> Column:
    """x, or NULL if it is NaN or infinite."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def is_false(x: Column) -> Column:
    return F.upper(F.trim(x)) == "FALSE"


def is_ticked(x: Column) -> Column:
    return F.coalesce(F.lower(F.trim(x)) == "x", F.lit(False))


def status(actual: Column, expected: Column, zeros: Column | None = None, nulls: Column | None = None) -> Column:
    """total_missing, partial_missing or complete; zeros or nulls make complete partial."""
    flawed = F.coalesce(zeros > 0, F.lit(False)) if zeros is not None else F.lit(False)
    if nulls is not None:
        flawed = flawed | F.coalesce(nulls > 0, F.lit(False))
    return F.when(actual == 0, "total_missing").when((actual < expected - 1) | flawed, "partial_missing").otherwise("complete")


def scores_agree(a: Column, b: Column, apart: float = 3) -> Column:
    """Whether two raters' scores lie less than `apart` from each other; a missing score is no objection."""
    return ~F.coalesce(F.abs(a - b) >= apart, F.lit(False))


def annotation_flag(valence_fits: Column, arousal_fits: Column, valence_agrees: Column, arousal_agrees: Column) -> Column:
    """Flag of a trial: whether the participant's scores fit the class, then whether the raters agree."""
    return (
        F.when(~valence_fits & ~arousal_fits, "BAD")
        .when(~valence_fits | ~arousal_fits, "NOISY")
        .when(~valence_agrees & ~arousal_agrees, "NOISY")
        .when(~valence_agrees | ~arousal_agrees, "ACCEPTABLE")
        .otherwise("GOOD")
    )


def raters_agree(*scores: Column) -> Column:
    """Whether any two ratings lie within 1 of each other."""
    pairs = [F.coalesce(F.abs(a - b) <= 1, F.lit(False)) for k, a in enumerate(scores) for b in scores[k + 1 :]]
    out = pairs[0]
    for p in pairs[1:]:
        out = out | p
    return out


def session_flag(disagreements: Column, arousal_agrees: Column, valence_agrees: Column) -> Column:
    """By the number of dimensions on which raters disagree, and by the two main ones."""
    return (
        F.when(disagreements >= 5, "BAD")
        .when((disagreements >= 3) | (~arousal_agrees & ~valence_agrees), "NOISY")
        .when(~arousal_agrees | ~valence_agrees, "ACCEPTABLE")
        .otherwise("GOOD")
    )
