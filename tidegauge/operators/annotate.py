"""Agreement of raters and the quality of annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import scalars as S


def conversations(meta: DataFrame, classes: list[str], size: int = 10) -> DataFrame:
    """Index, one-hot class columns -> emotion, conversation, its dominant class and the class's occurrence.

    The dominant class of a conversation is its first that isn't Neutral.
    """
    emotion = F.coalesce(*[F.when(F.col(c) == 1, c) for c in classes])
    rows = meta.withColumn("emotion", emotion).withColumn("conversation", F.floor((F.col("Index") - 1) / size).cast("long"))
    top = rows.groupBy("conversation").agg(F.min_by(F.col("emotion"), F.when(F.col("emotion") != "Neutral", F.col("Index"))).alias("dominant"))
    top = top.withColumn("occurrence", F.row_number().over(Window.partitionBy("dominant").orderBy("conversation")))
    return rows.join(top, "conversation").select("Index", "emotion", "conversation", "dominant", "occurrence")


def questionnaire(cells: DataFrame, keys: list[str], order: str, label: str, most: int = 5) -> DataFrame:
    """Sheet rows -> (keys, emotion_class, k, other columns): header rows carry a label forward, then up to `most` data rows follow."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = cells.withColumn("emotion_class", F.last(label, ignorenulls=True).over(w)).filter(
        F.col(label).isNull() & F.col("emotion_class").isNotNull(),
    )
    rows = rows.withColumn("k", F.row_number().over(Window.partitionBy(*keys, "emotion_class").orderBy(order)))
    return rows.filter(F.col("k") <= most).drop(label)


def trial_annotations(trials: DataFrame, scores: DataFrame, thresholds: DataFrame, apart: float = 3) -> DataFrame:
    """trials: subject, trial_id, emotion_class, k. scores: subject, emotion_class, k and four scores, valence_ and
    arousal_ participant and experimenter. thresholds: emotion_class (one row each) and bounds valence_low .. arousal_high.

    The participant's scores are held against the class; both raters' means give the emotion. A trial without
    scores has NULL in all of these.
    """
    rows = trials.join(scores.withColumn("_rated", F.lit(True)), ["subject", "emotion_class", "k"], "left").join(thresholds, "emotion_class", "left")
    fits = {d: S.aligned(F.col(f"{d}_participant"), F.col(f"{d}_low"), F.col(f"{d}_high")) for d in ("valence", "arousal")}
    agree = {d: S.scores_agree(F.col(f"{d}_participant"), F.col(f"{d}_experimenter"), apart) for d in fits}
    mean = {d: (F.col(f"{d}_participant") + F.col(f"{d}_experimenter")) / 2 for d in fits}
    emotion = S.quadrant(mean["valence"], mean["arousal"])
    rated = lambda x: F.when(F.col("_rated"), x)
    said = lambda x: rated(F.when(x, "ALIGNED").otherwise("MISALIGNED"))
    new = {
        "valence_class_alignment": said(fits["valence"]),
        "arousal_class_alignment": said(fits["arousal"]),
        "quality_flag": rated(S.annotation_flag(fits["valence"], fits["arousal"], agree["valence"], agree["arousal"])),
        "avg_valence": mean["valence"],
        "avg_arousal": mean["arousal"],
        "valence_arousal_emotion": emotion,
        "emotion_class_alignment": said(F.coalesce(emotion == F.col("emotion_class"), F.lit(False))),
    }
    return rows.withColumns(new).drop("_rated", *[f"{d}_{e}" for d in fits for e in ("low", "high")])


def tail_aligned(rows: DataFrame, keys: list[str], rater: str, order: str) -> DataFrame:
    """Adds position: rows of all raters matched from the end, as many as the shortest rater has."""
    w = Window.partitionBy(*keys, rater)
    own = rows.withColumn("_back", F.row_number().over(w.orderBy(F.col(order).desc())))
    n = own.groupBy(*keys, rater).agg(F.count(F.lit(1)).alias("_c")).groupBy(*keys).agg(F.min("_c").alias("_n"))
    return own.join(n, keys).filter(F.col("_back") <= F.col("_n")).withColumn("position", F.col("_n") - F.col("_back")).drop("_back", "_n")


def head_aligned(rows: DataFrame, keys: list[str], rater: str, order: str) -> DataFrame:
    """Adds position: rows of all raters matched from the start, as many as the shortest rater has."""
    w = Window.partitionBy(*keys, rater)
    own = rows.withColumn("position", F.row_number().over(w.orderBy(order)) - 1)
    n = own.groupBy(*keys, rater).agg(F.count(F.lit(1)).alias("_c")).groupBy(*keys).agg(F.min("_c").alias("_n"))
    return own.join(n, keys).filter(F.col("position") < F.col("_n")).drop("_n")


def session_annotations(
    rows: DataFrame,
    keys: list[str],
    scores: list[str],
    checks: list[list[str]],
    raters: tuple[str, ...] = ("self", "partner", "external"),
    step_s: int = 5,
) -> DataFrame:
    """One row for each key and step: agreement of each score and check group, flag, dominant emotion and the raters' means.

    rows: keys, rater, row (order), scores (Likert), checks (columns of each group: ticked or not). A key without
    rows of all raters has none.
    """
    all_there = rows.filter(F.col("rater").isin(*raters)).groupBy(*keys).agg(F.count_distinct("rater").alias("_n")).filter(F.col("_n") == len(raters)).drop("_n")
    placed = tail_aligned(rows.join(all_there, keys, "left_semi"), keys, "rater", "row")
    names = scores + [c for g in checks for c in g]
    wide = placed.groupBy(*keys, "position").pivot("rater", list(raters)).agg(*[F.first(c).alias(c) for c in names])
    score = lambda c: [F.col(f"{r}_{c}") for r in raters]
    out = wide.withColumn("seconds", F.col("position") * step_s)
    agrees = {c: S.raters_agree(*score(c)) for c in scores}
    for k, group in enumerate(checks):
        ticks = [sum((S.is_ticked(x).cast("int") for x in score(c)), F.lit(0)) for c in group]
        agrees[f"check_{k}"] = F.greatest(F.lit(0), *ticks) >= 2
    for name, a in agrees.items():
        out = out.withColumn(f"{name}_agree", F.when(a, "AGREE").otherwise("DISAGREE"))
    off = sum((F.when(a, 0).otherwise(1) for a in agrees.values()), F.lit(0))
    out = out.withColumn("quality_flag", S.session_flag(off, agrees["arousal"], agrees["valence"]))
    sums = {c: sum((F.coalesce(x.cast("double"), F.lit(0.0)) for x in score(c)), F.lit(0.0)) for c in scores if c not in ("arousal", "valence")}
    labels, top = dominant_of(sums)
    out = out.withColumn("dominant_emotion", labels).withColumn("dominant_emotion_value", top)
    rated = lambda c: F.filter(F.array(*[x.cast("double") for x in score(c)]), lambda x: x.isNotNull())
    mean = lambda c: F.aggregate(rated(c), F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(rated(c)), F.lit(0))
    out = out.withColumn("avg_valence", mean("valence")).withColumn("avg_arousal", mean("arousal"))
    out = out.withColumn("valence_arousal_emotion", S.quadrant(F.col("avg_valence"), F.col("avg_arousal"), 3.0))
    fits = F.coalesce(F.array_contains(F.split("dominant_emotion", ", "), F.col("valence_arousal_emotion")), F.lit(False))
    return out.select(
        *keys,
        "seconds",
        *[f"{n}_agree" for n in agrees],
        "quality_flag",
        "dominant_emotion",
        "dominant_emotion_value",
        "avg_valence",
        "avg_arousal",
        "valence_arousal_emotion",
        F.when(fits, "ALIGNED").otherwise("MISALIGNED").alias("emotion_class_alignment"),
    )


#: The emotions in the order of the output, and the feelings that stand for them.
DOMINANT = ("Neutral", "Calm", "Happiness", "Anger", "Sadness")
FEELINGS = {"Happiness": ("cheerful", "happy"), "Anger": ("angry",), "Sadness": ("nervous", "sad")}
CALM, CALM_MOST, NEUTRAL_MOST = ("happy", "sad"), 6, 4


def dominant_of(sums: dict[str, Column]) -> tuple[Column, Column]:
    """The emotions that the feelings with the largest sum stand for, joined; and that sum.

    A largest sum of 4 or less is Neutral, too; one of 6 or less is Calm if it is that of happy or sad.
    """
    top = F.greatest(*sums.values())
    leads = lambda names: F.greatest(*[sums[f] == top for f in names if f in sums], F.lit(False), F.lit(False))
    hit = {"Neutral": top <= NEUTRAL_MOST, "Calm": leads(CALM) & (top <= CALM_MOST)} | {e: leads(own) for e, own in FEELINGS.items()}
    return F.array_join(F.array_compact(F.array(*[F.when(hit[e], e) for e in DOMINANT])), ", "), top
