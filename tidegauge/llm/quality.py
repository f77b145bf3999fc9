"""Quality of documents: a classifier's evidence combined with site and path rates by hierarchical empirical Bayes.

1. Evidence. Each text's FEATURES are computed in one pass. A logistic regression on standardised
   features is fitted on the driver to at most SAMPLE labelled rows (those with the smallest hash of
   their id, a documented bound). Its evidence is the log-odds less those of the sample's base rate.
2. Sites. Each document's probability under the base rate is summed by host and by path within the host;
   both are grouped sums that combine before the shuffle, whatever a host's size. A host's rate is shrunk
   toward the global rate as (s + k * global) / (n + k), a path's rate toward its host's in the same way. The
   strength k of a level comes from the level itself: the spread of its rates beyond what chance gives
   (method of moments), between 1 and STRONGEST. Sparse sites thus stay near their parent.
3. Posterior. log-odds = evidence + log-odds of the path's rate; a document is kept at THRESHOLD or more.

A text without words (null, empty, blank) has nothing to judge and is rejected. Null hosts or paths are
values of their own. Without labels of both kinds the evidence is 0 and every document with words is kept.
Repeated rows are judged alike; in `reject`, rows that share an id stay if one of them is kept, and rows
with a null id stay if they have words. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import common
from tidegauge.llm.chunks import release

SAMPLE = 20_000
STRONGEST = 10_000.0
THRESHOLD = 0.5
SYMBOLS = "#=&$*%{}^~<>@_\\"
FEATURES = (
    "words", "word_length", "distinct", "heaps", "top", "repeats", "adjacent", "upper", "upper_count", "bangs", "bang_count", "bars", "bar_count",
    "digits", "stops", "lines", "same_lines", "long_words", "longest", "pairs", "marks", "symbols", "symbol_count", "repeat_count",
)


def features(text: str | None) -> list[float]:
    """The FEATURES of a whole text; zeros if it has no words."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size, kinds, lines = len(text), Counter(words), text.split("\n")
    pairs = Counter(zip(words, words[1:], strict=False))
    adjacent = sum(m for (a, b), m in pairs.items() if a == b)
    upper = sum(1 for w in kinds if len(w) > 1 and w.isupper())
    upper_n = sum(m for w, m in kinds.items() if len(w) > 1 and w.isupper())
    bangs, bars, symbols = text.count("!"), text.count("|"), sum(text.count(c) for c in SYMBOLS)
    digits = sum(text.count(d) for d in "0123456789")
    stops = text.count(".") + text.count("?")
    long_words = sum(m for w, m in kinds.items() if len(w) > 18)
    filled = [x for x in lines if x.strip()]
    log = math.log1p
    return [
        log(n), sum(map(len, words)) / n, len(kinds) / n, log(len(kinds)) / log(n), max(kinds.values()) / n, 1 - len(pairs) / max(n - 1, 1), adjacent / n,
        upper_n / n, log(upper), bangs / size, log(bangs), bars / n, log(bars),
        digits / size, stops / n, log(len(lines)), 1 - len(set(filled)) / max(len(filled), 1), long_words / n, log(max(map(len, kinds))), log(max(pairs.values(), default=0)),
        sum(text.count(c) for c in ",;:") / n, symbols / n, log(symbols), log(adjacent),
    ]


def table(docs: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, host, path, has_words, f0 .. of each row: one pass over the texts."""
    common.text_batches(docs.sparkSession)
    names = ["doc_id", "host", "path", "has_words", *[f"f{k}" for k in range(len(FEATURES))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            own = np.array([features(x) for x in b.column(1).to_pylist()], np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), pa.array(own[:, 0] > 0), *[pa.array(own[:, k]) for k in range(len(FEATURES))]],
                names,
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
    )
    return rows.mapInArrow(run, "doc_id long, host string, path string, has_words boolean, " + ", ".join(f"{n} double" for n in names[4:]))


def _expand(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(x), 1)), x, x * x], 1)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(means, spreads, weights) of a logistic regression on clipped, standardised features and their squares, by Newton's method."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = _expand(np.clip((x - mean) / spread, -5, 5))
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-5:
            break
    return mean, spread, w


def _strength(groups: DataFrame, parent: Column) -> float:
    """Method of moments: how many documents the parent's rate is worth at this level."""
    r, n = F.col("s") / F.col("n"), F.col("n")
    row = groups.agg(
        F.count(F.lit(1)).alias("g"), F.sum("n").alias("n"), F.sum(n * (r - parent) ** 2).alias("between"), F.sum(n * parent * (1 - parent)).alias("chance"), F.sum(n * n).alias("nn")
    ).first()
    if not row.g or not row.n or not row.chance:
        return STRONGEST
    each = row.chance / row.n
    # E[between] = g * each + spread * n, with spread the variance of the true rates
    spread = (row.between - row.g * each) / row.n
    return float(min(max(each / spread - 1, 1.0), STRONGEST)) if spread > 0 else STRONGEST


def _odds(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def classify(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE
) -> DataFrame:
    """doc_id, evidence, host_rate, path_rate, posterior, keep for every row of docs; labels: doc_id and label_col (1 good, 0 bad)."""
    rows = common.saved(table(docs, host, path, id_col, text_col), "features")
    names = [f"f{k}" for k in range(len(FEATURES))]
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("y is not null and doc_id is not null")
    chosen = known.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most `sample` rows
    found = rows.filter("has_words").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").select("y", *names).collect()
    y = np.array([r[0] for r in found], np.float64)
    if len(set(y.tolist())) < 2:
        base, evidence = 0.5, F.lit(0.0)
    else:
        mean, spread, w = fit(np.array([r[1:] for r in found], np.float64), y)
        base = float(y.mean())
        evidence = F.lit(float(w[0]) - math.log(base / (1 - base)))
        for k, name in enumerate(names):
            z = F.greatest(F.lit(-5.0), F.least(F.lit(5.0), (F.col(name) - float(mean[k])) / float(spread[k])))
            evidence = evidence + z * (float(w[1 + k]) + z * float(w[1 + len(names) + k]))
    own = rows.select("doc_id", "host", "path", "has_words", evidence.alias("evidence"))
    own = own.withColumn("p", 1 / (1 + F.exp(-F.least(F.greatest(F.col("evidence") + math.log(base / (1 - base)), F.lit(-30.0)), F.lit(30.0)))))
    own = common.saved(own, "evidence")

    paths = common.saved(own.filter("has_words").groupBy("host", "path").agg(F.sum("p").alias("s"), F.count(F.lit(1)).alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    total = hosts.agg(F.sum("s"), F.sum("n")).first()
    rate = (total[0] or 0.0) / total[1] if total[1] else base
    k_host = _strength(hosts, F.lit(rate))
    host_rate = hosts.select(F.col("host").alias("h"), ((F.col("s") + k_host * rate) / (F.col("n") + k_host)).alias("host_rate"))
    level = common.saved(paths.join(host_rate, F.col("host").eqNullSafe(F.col("h"))).drop("h"), "level")
    k_path = _strength(level, F.col("host_rate"))
    path_rate = level.select(
        F.col("host").alias("h"),
        F.col("path").alias("q"),
        "host_rate",
        ((F.col("s") + k_path * F.col("host_rate")) / (F.col("n") + k_path)).alias("path_rate"),
    )

    joined = own.join(path_rate, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q")), "left")
    odds = F.col("evidence") + _odds(F.coalesce("path_rate", F.lit(rate)))
    posterior = F.when(F.col("has_words"), 1 / (1 + F.exp(-odds))).otherwise(0.0)
    return joined.select(
        "doc_id", "evidence", F.coalesce("host_rate", F.lit(rate)).alias("host_rate"), F.coalesce("path_rate", F.lit(rate)).alias("path_rate"), posterior.alias("posterior")
    ).withColumn("keep", F.col("posterior") >= THRESHOLD)


def reject(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """The rows of docs that are kept, with all their columns; only rows that may have been rejected are shuffled."""
    judged = classify(docs, labels, host, path, id_col, text_col, label_col)
    kept = judged.filter("doc_id is not null").groupBy("doc_id").agg(F.max("keep").alias("keep"))
    with_words = docs.filter(F.col(id_col).isNotNull() | F.col(text_col).rlike(r"\S"))
    return common.without_ids(with_words, id_col, kept.filter("not keep").select("doc_id"))
