"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of the characters of its words, ORDER characters deep, with word marks; the
highest order uses counts, lower orders count distinct left neighbours, and every order discounts
n1 / (n1 + 2 n2). Discounted shares and back-off weights lie in arrays sorted by n-gram hash, one column
for each language. A document's cross-entropy is the mean over its characters (word ends included); the
language with the smallest one wins, ties going to the first name.

Training takes, of the rows that may be learned from and have a language and text, an expected SAMPLE of each
language, those with the smallest hashes of their ids: a documented bound. A fifth of them calibrates: the scale of
the softmax that turns cross-entropies into a score, and for each language the cross-entropy beyond which
a document is marked `rejected` (unlike anything learned; lang_pred still names the nearest language).

Texts are lowered and read as words of letters. A null text or one without letters is `und` with score 0.
If there is nothing to learn from, every document is `und`. Repeated rows are treated alike. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm import common
from tidegauge.llm.chunks import ChunkTable

ORDER = 5
SAMPLE = 1000
#: A language with fewer documents learns from all of them and isn't calibrated.
FEW = 10
LETTERS = re.compile(r"[^\W\d_]+")
#: Share of the calibration documents of a language that its threshold accepts, before the margin.
ACCEPT, MARGIN = 0.99, 0.35
MARK = 1


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


def grams_of(words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order, hashes of the grams that end at each character or word end (0: reaches before the word); the word of each."""
    flat = np.frombuffer("".join([f"\x01{w}\x01" for w in words]).encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out, h = [], np.zeros(len(flat), np.uint64)
    for k in range(ORDER):
        # the hash grows to the left: a gram's hash without its first character is its suffix's
        back = np.concatenate((np.zeros(min(k, len(flat)), np.uint64), flat[: max(len(flat) - k, 0)]))
        x = (back + np.uint64(k << 32)) * np.uint64(0x9E3779B97F4A7C15)
        h = h + (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append(np.where(place >= k, h, np.uint64(0)))
    return out, np.where(place > 0, word, -1)


class Language:
    """Counts of one language -> share and back-off weight of each gram and context."""

    def __init__(self, words: list[str], counts: np.ndarray):
        grams, word = grams_of(words)
        use = word >= 0
        weight = counts[word[use]]
        # the context of a gram of order k is the gram of order k - 1 that ends one place earlier
        self.shares, self.backs = [], []
        keep = None
        for k in reversed(range(ORDER)):
            g = grams[k][use]
            before = np.concatenate((np.zeros(1, np.uint64), grams[k - 1][:-1]))[use] if k else np.zeros(len(g), np.uint64)
            there = g != 0
            uniq, first, inverse = np.unique(g[there], return_index=True, return_inverse=True)
            if keep is None:
                n = np.bincount(inverse, weight[there], len(uniq))
            else:
                # continuation counts: distinct grams one longer that end in this one; word starts have none and count themselves
                longer, suffix = keep
                n = np.zeros(len(uniq))
                at = np.searchsorted(uniq, suffix)
                np.add.at(n, at, 1)
                n = np.where(n > 0, n, np.bincount(inverse, weight[there], len(uniq)))
            context = before[there][first]
            ones, twos = (n == 1).sum(), (n == 2).sum()
            d = float(ones / (ones + 2 * twos)) if ones and twos else 0.5
            heads, at = np.unique(context, return_inverse=True)
            total = np.bincount(at, n)
            kinds = np.bincount(at)
            self.shares.append((uniq, np.maximum(n - d, 0) / total[at]))
            self.backs.append((heads, d * kinds / total))
            # suffix of each distinct gram of this order
            shorter = grams[k - 1][use][there][first] if k else uniq
            keep = uniq, shorter
        self.shares.reverse()
        self.backs.reverse()


class Model:
    """All languages' arrays, merged by hash: one search gives every language's value."""

    def __init__(self, names: list[str], languages: list[Language], alphabet: int):
        self.names, self.alphabet = names, alphabet
        self.shares = [self._merged([x.shares[k] for x in languages], 0.0) for k in range(ORDER)]
        self.backs = [self._merged([x.backs[k] for x in languages], 1.0) for k in range(ORDER)]
        self.scale, self.limits = 1.0, np.full(len(names), np.inf)

    @staticmethod
    def _merged(columns: list[tuple[np.ndarray, np.ndarray]], missing: float) -> tuple[np.ndarray, np.ndarray]:
        keys = np.unique(np.concatenate([k for k, _ in columns]))
        values = np.full((len(keys) + 1, len(columns)), missing, np.float32)
        for j, (k, v) in enumerate(columns):
            values[np.searchsorted(keys, k), j] = v
        return keys, values

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> np.ndarray:
        keys, values = table
        if not len(keys):
            return values[np.zeros(len(hashes), np.int64)]
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return values[np.where(keys[at] == hashes, at, len(keys))]

    def log2(self, words: list[str]) -> np.ndarray:
        """[word, language]: log2 probability of the word's characters and end."""
        grams, word = grams_of(words)
        use = word >= 0
        p = np.full((int(use.sum()), len(self.names)), 1 / self.alphabet, np.float32)
        for k in range(ORDER):
            g = grams[k][use]
            before = np.concatenate((np.zeros(1, np.uint64), grams[k - 1][:-1]))[use] if k else np.zeros(len(g), np.uint64)
            there = g != 0
            p[there] = self._find(self.shares[k], g[there]) + self._find(self.backs[k], before[there]) * p[there]
        logs = np.log2(p)
        return np.stack([np.bincount(word[use], logs[:, j], len(words)) for j in range(len(self.names))], 1)


_tables: dict[str, tuple[Model, ChunkTable]] = {}


def entropies(docs: DataFrame, model: Model, *more: str) -> DataFrame:
    """doc_id, `more` columns, n (characters read), bits (array: cross-entropy by language) of docs (doc_id, text, more)."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _tables:
            _tables.clear()
            _tables[key] = shared.value, ChunkTable(lambda words: shared.value.log2(words), 200_000)
        model, table = _tables[key]
        for b in batches:
            counts = [Counter(words_of(x)) for x in b.column(1).to_pylist()]
            table.fill(counts)
            n, bits = [], []
            for c in counts:
                size = sum((len(w) + 1) * m for w, m in c.items())
                n.append(size)
                total = np.array(list(c.values()), np.float64) @ np.array([table[w] for w in c]) if size else np.zeros(len(model.names))
                bits.append((-total / max(size, 1)).tolist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *b.columns[2:], pa.array(n, pa.int64()), pa.array(bits, pa.list_(pa.float64()))],
                ["doc_id", *more, "n", "bits"],
            )

    schema = docs.select("doc_id", *more).schema.add("n", T.LongType()).add("bits", T.ArrayType(T.DoubleType()))
    return docs.select("doc_id", "text", *more).mapInArrow(run, schema)


def train(docs: DataFrame, learnable: Column, sample: int = SAMPLE) -> Model | None:
    """A model from docs (doc_id, text, lang); None if no row can be learned from."""
    spark = docs.sparkSession
    order = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.filter(learnable & F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("order", order)
    # one count of each language gives the share of the hashes that holds its sample
    many = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not many:
        return None
    limits = {lang: int((1 << 62) * min(1.0, sample / n)) for lang, n in many.items()}
    few = [lang for lang, n in many.items() if n < FEW]
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    chosen = rows.filter(F.shiftrightunsigned("order", 2) < limit[F.col("lang")]).withColumn(
        "check",
        (F.pmod(F.xxhash64(F.lit("check"), "order"), F.lit(5)) == 0) & ~F.col("lang").isin(few),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen.update((lang, w) for w in words_of(text))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
            ["lang", "word", "n"],
        )

    tally = chosen.filter(~F.col("check")).select("lang", "text").mapInArrow(
        count,
        "lang string, word string, n long",
    ).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    found: dict[str, list[tuple[str, int]]] = {}
    for lang, word, n in tally.orderBy("lang", "word").collect():
        found.setdefault(lang, []).append((word, n))
    names = sorted(found)
    if not names:
        return None
    languages = [Language([w for w, _ in found[x]], np.array([n for _, n in found[x]], np.float64)) for x in names]
    alphabet = len({c for x in found.values() for w, _ in x for c in w}) + 2
    model = Model(names, languages, alphabet)

    checks = [
        (r.lang, r.n, r.bits) for r in entropies(
            chosen.filter("check").select("doc_id", "text", "lang"),
            model,
            "lang",
        ).filter("n > 0").collect() if r.lang in names
    ]
    if checks:
        own = np.array([names.index(x) for x, _, _ in checks])
        bits = np.array([x for _, _, x in checks])
        best = None
        for scale in 2.0 ** np.arange(-2, 8):
            z = -scale * bits
            z -= z.max(1, keepdims=True)
            loss = -(z[np.arange(len(own)), own] - np.log(np.exp(z).sum(1))).mean()
            if best is None or loss < best - 1e-4:
                best, model.scale = loss, float(scale)
        for k in range(len(names)):
            if (own == k).any():
                model.limits[k] = np.quantile(bits[own == k, k], ACCEPT) + MARGIN
    return model


def predict(
    docs: DataFrame,
    learnable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected, bits; learnable: condition on doc_id of the rows that training may read."""
    common.text_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    model = train(rows, learnable, sample)
    held = (~learnable).alias("held_out")
    if model is None:
        return rows.select(
            "doc_id",
            held,
            F.lit("und").alias("lang_pred"),
            F.lit(0.0).alias("score"),
            F.lit(False).alias("rejected"),
            F.lit(None).cast("double").alias("bits"),
        )
    names = F.array(*[F.lit(x) for x in model.names])
    limits = F.array(*[F.lit(float(x)) for x in model.limits])
    found = entropies(rows, model).withColumn("least", F.array_min("bits")).withColumn("k", F.array_position("bits", F.col("least")).cast("int"))
    share = 1 / F.aggregate("bits", F.lit(0.0), lambda a, x: a + F.exp(-(x - F.col("least")) * model.scale))
    some = F.col("n") > 0
    return found.select(
        "doc_id",
        held,
        F.when(some, F.element_at(names, F.col("k"))).otherwise("und").alias("lang_pred"),
        F.when(some, share).otherwise(0.0).alias("score"),
        (some & (F.col("least") > F.element_at(limits, F.col("k")))).alias("rejected"),
        F.when(some, F.col("least")).alias("bits"),
    )
