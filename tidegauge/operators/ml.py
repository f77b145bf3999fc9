"""Models over feature tables: scaling, reduction, clustering and quality-aware sequence labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidegauge.operators import kernels


def impute(df: DataFrame, train: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs and NaNs become the training mean; 0 if there is none."""
    clean = {c: F.when(~F.isnan(c), F.col(c)) for c in columns}
    row = train.agg(*[F.coalesce(F.avg(v), F.lit(0.0)).alias(c) for c, v in clean.items()]).first()
    return df.withColumns({c: F.coalesce(v, F.lit(float(row[c]))) for c, v in clean.items()})


def numeric_filled(df: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` and the numeric columns, in which NULLs and NaNs become 0."""
    from pyspark.sql.types import NumericType

    names = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in keep]
    return df.select(*keep, *names).na.fill(0, names)


def scale(df: DataFrame, train: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population deviation of the training rows; constant columns are only centred."""
    row = train.agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return df.withColumns({c: (F.col(c) - float(row[f"{c}_m"] or 0)) / float(row[f"{c}_s"] or 1) for c in columns})


def scaled_vectors(vectors: DataFrame, key: str, vector: str, like: DataFrame | None = None) -> DataFrame:
    """(key, pos, z): arrays standardised by position with population moments."""
    long = vectors.select(key, F.posexplode(vector).alias("pos", "x")).withColumn("x", F.col("x").cast("double"))
    moments = (like.select(F.posexplode(vector).alias("pos", "x")) if like is not None else long).groupBy("pos").agg(
        F.avg(F.col("x").cast("double")).alias("m"),
        F.stddev_pop(F.col("x").cast("double")).alias("s"),
    )
    return long.join(F.broadcast(moments), "pos").select(key, "pos", ((F.col("x") - F.col("m")) / F.when(F.col("s") > 0, F.col("s")).otherwise(1.0)).alias("z"))  # one row a position


def vector_column(df: DataFrame, columns: list[str], name: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(name, array_to_vector(F.array(*[F.col(c).cast("double") for c in columns])))


def pca(df: DataFrame, train: DataFrame, columns: list[str], most: int = 3, name: str = "pc") -> DataFrame:
    """Up to `most` principal components of standardised columns, as an array."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import vector_to_array

    model = PCA(k=min(most, len(columns)), inputCol="features", outputCol="_pc").fit(vector_column(train, columns))
    return model.transform(vector_column(df, columns)).withColumn(name, vector_to_array("_pc")).drop("features", "_pc")


#: Points whose pairs a silhouette compares at most.
POINTS = 20_000


def silhouette(points: DataFrame, key: str, x: str, cluster: str) -> DataFrame:
    """Mean Euclidean silhouette over entities (key, array x, cluster). Their pairs are the definition: more than POINTS are an error."""
    if points.count() > POINTS:
        raise ValueError(f"a silhouette compares all pairs; it is for {POINTS} entities at most")
    a = points.select(F.col(key).alias("a"), F.col(x).alias("xa"), F.col(cluster).alias("ca"))
    b = points.select(F.col(key).alias("b"), F.col(x).alias("xb"), F.col(cluster).alias("cb"))
    d = F.sqrt(F.aggregate(F.zip_with("xa", "xb", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v))
    # points against the other points, by nested loop; for entity means only
    near = a.join(b, F.col("a") != F.col("b")).groupBy("a", "ca", "cb").agg(F.avg(d).alias("d"))
    own = near.groupBy("a").agg(
        F.max(F.when(F.col("ca") == F.col("cb"), F.col("d"))).alias("inside"),
        F.min(F.when(F.col("ca") != F.col("cb"), F.col("d"))).alias("outside"),
    )
    s = F.when(F.col("inside").isNull() | F.col("outside").isNull(), 0.0).otherwise(
        (F.col("outside") - F.col("inside")) / F.greatest("inside", "outside"),
    )
    return own.agg(F.avg(s).alias("silhouette"))


#: Distances that a task of `kmeans` holds at once.
DISTANCES = 2_000_000


def kmeans(
    points: DataFrame,
    key: str,
    columns: list[str],
    ks: range,
    seed: int = 42,
    starts: int = 10,
    good: float = 0.5,
) -> tuple[DataFrame, int, dict[int, float]]:
    """(key, cluster), the chosen k and each k's silhouette: the largest k above `good`, else the best one.

    Points that lack a value are left out; every k below their number is tried. Their silhouettes compare all pairs, so
    more than POINTS are an error; as many fit into each task, which makes whole fits, or rows of all silhouettes.
    """
    spark, kind = points.sparkSession, points.schema[key].dataType
    x = F.array(*[F.col(c).cast("double") for c in columns])
    # in one order, as fits draw rows by position
    found = points.na.drop(subset=columns).select(F.col(key).alias("key"), x.alias("x")).sort("key", "x").limit(POINTS + 1).collect()
    if len(found) > POINTS:
        raise ValueError(f"a silhouette compares all pairs; K-Means is for {POINTS} entities at most")
    n, schema = len(found), StructType([StructField(key, kind), StructField("cluster", IntegerType(), False)])
    ks = [k for k in ks if k < n]
    if not ks:
        return spark.createDataFrame([(r.key, 0) for r in found], schema), min(n, 1), {}
    z = kernels.standardised(np.array([r.x for r in found], np.float64))
    if not np.isfinite(z).all():
        raise ValueError("K-Means needs finite values")
    shared = spark.sparkContext.broadcast(z)  # at most POINTS rows

    def fits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in batch["id"]:
                start, at = divmod(i, len(ks))
                y, cost = kernels.kmeans(shared.value, ks[at], seed + start)
                yield pd.DataFrame({"at": [at], "start": [start], "cost": [cost], "labels": [y.astype("<i4").tobytes()]})

    # every k of a start, then the next start: neighbours differ in k, so that tasks have about the same work
    tried = over(spark, len(ks) * starts).mapInPandas(fits, "at long, start long, cost double, labels binary")
    kept = tried.groupBy("at").agg(F.min_by("labels", F.struct("cost", "start")).alias("labels")).sort("at").collect()
    labels = spark.sparkContext.broadcast(np.stack([np.frombuffer(r.labels, "<i4") for r in kept]))
    size = max(1, DISTANCES // n)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in batch["id"]:
                own = np.arange(i * size, min(n, (i + 1) * size))
                s = kernels.silhouettes(shared.value, own, labels.value).sum(1)
                yield pd.DataFrame({"block": i, "at": np.arange(len(ks)), "s": s})

    parts = over(spark, -(-n // size)).mapInPandas(rows, "block long, at long, s double").collect()
    sums = np.zeros(len(ks))
    for r in sorted(parts):
        sums[r["at"]] += r["s"]
    scores = {k: float(s) / n for k, s in zip(ks, sums, strict=True)}
    above = [k for k, s in scores.items() if s > good]
    best = max(above) if above else max(scores, key=lambda k: scores[k])
    chosen = labels.value[ks.index(best)].tolist()
    shared.destroy()
    labels.destroy()
    return spark.createDataFrame([(r.key, c) for r, c in zip(found, chosen, strict=True)], schema), best, scores


def over(spark: SparkSession, n: int) -> DataFrame:
    """(id) 0 .. n - 1, dealt to every core."""
    return spark.range(0, n, 1, min(n, spark.sparkContext.defaultParallelism))


def lda(df: DataFrame, group: list[str], label: str, columns: list[str], keep: list[str], most: int = 3) -> DataFrame:
    """Discriminant scores lda_1 .. of each group with at least two classes; a group is one entity and modality."""
    schema = df.select(*group, *keep, label).schema
    for k in range(most):
        schema = schema.add(f"lda_{k + 1}", "double")

    def run(own: pd.DataFrame) -> pd.DataFrame:
        own = own[own[label].notna()]
        out = own[[*group, *keep, label]].copy()
        if own[label].nunique() < 2:
            return out.iloc[:0].assign(**{f"lda_{k + 1}": [] for k in range(most)})
        z = kernels.discriminant(np.nan_to_num(own[columns].to_numpy(np.float64)), own[label].to_numpy(), most)
        for k in range(most):
            out[f"lda_{k + 1}"] = z[:, k] if k < z.shape[1] else np.nan
        return out

    return df.select(*group, *keep, label, *columns).groupBy(*group).applyInPandas(run, schema)


def entity_means(df: DataFrame, entity: str, modality: str, values: list[str], modalities: list[str]) -> DataFrame:
    """One row for each entity: mean of each value in each modality, 0 where there is none."""
    clean = lambda v: F.when(~F.isnan(F.col(v).cast("double")), F.col(v))
    return df.groupBy(entity).agg(
        *[F.coalesce(F.avg(F.when(F.col(modality) == m, clean(v))), F.lit(0.0)).alias(f"{m}_{v}") for m in modalities for v in values]
    )


def dense_labels(df: DataFrame, label: str, name: str = "state") -> DataFrame:
    """Labels -> 0 .. n - 1 in their order; the distinct labels are ranked, not the rows."""
    own = df.select(label).filter(F.col(label).isNotNull()).distinct()
    ranked = own.withColumn(name, F.dense_rank().over(Window.orderBy(label)) - 1)
    return df.join(ranked, label)


def sequences(rows: DataFrame, trial: str, label: str, order: str, modality: str) -> DataFrame:
    """Rows of trials that every modality has and that have one label, with position t, cut to the shortest modality."""
    n = rows.select(modality).distinct().count()
    good = rows.groupBy(trial).agg(
        F.count_distinct(modality).alias("m"),
        F.count_distinct(label).alias("l"),
    ).filter((F.col("m") == n) & (F.col("l") == 1)).select(trial)
    own = rows.join(good, trial, "left_semi").withColumn("t", F.row_number().over(Window.partitionBy(trial, modality).orderBy(order)) - 1)
    least = own.groupBy(trial, modality).agg(F.count(F.lit(1)).alias("c")).groupBy(trial).agg(F.min("c").alias("_n"))
    return own.join(least, trial).filter(F.col("t") < F.col("_n")).drop("_n")


def hmm(
    rows: DataFrame,
    entity: str,
    sequence: str,
    order: str,
    state: str,
    vectors: list[str],
    qualities: list[str],
    part: str = "part",
    **settings: float,
) -> DataFrame:
    """(entity, sequence, order, state, predicted) of the test rows: one model for each entity, trained on its train rows.

    vectors: array columns, one for each modality; qualities: their scores in [0, 1]. An entity's rows meet in one task.
    """
    schema = rows.select(entity, sequence, order, state).schema.add("predicted", "long")

    def run(own: pd.DataFrame) -> pd.DataFrame:
        def parts(frame: pd.DataFrame) -> list[tuple]:
            out = []
            for _, s in frame.sort_values([sequence, order]).groupby(sequence):
                out.append(
                    (
                        s,
                        s[state].to_numpy(np.int64),
                        [np.stack(s[v]).astype(np.float64) for v in vectors],
                        [s[q].to_numpy(np.float64) for q in qualities],
                    )
                )
            return out

        train, test = parts(own[own[part] == "train"]), parts(own[own[part] == "test"])
        empty = own.iloc[:0][[entity, sequence, order, state]].assign(predicted=np.zeros(0, np.int64))
        if not train or not test:
            return empty
        model = kernels.QualityHmm(**settings).fit([x[1:] for x in train], int(own[state].max()) + 1)
        return pd.concat([s[[entity, sequence, order, state]].assign(predicted=model.decode(xs, qs)) for s, _, xs, qs in test])

    return rows.select(entity, sequence, order, state, *vectors, *qualities, part).groupBy(entity).applyInPandas(run, schema)


def evaluate(pairs: DataFrame, truth: str, guess: str) -> DataFrame:
    """accuracy and macro F1 of labelled predictions."""
    from tidegauge.operators import stats

    classes = pairs.select(F.col(truth).alias("class")).union(pairs.select(guess)).distinct()
    table = stats.confusion(pairs, truth, guess, classes)
    scores = stats.raw_scores(table, truth, guess)
    hit: Column = F.sum(F.when(F.col(truth) == F.col(guess), F.col("n")).otherwise(0)) / F.sum("n")
    return table.agg(F.round(hit, 4).alias("accuracy")).crossJoin(scores.agg(F.round(F.avg("f1"), 4).alias("macro_f1")))  # one row each
