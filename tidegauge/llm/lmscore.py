"""Language-model scores from a log-frequency Bloom filter.

Training counts every word and every pair of neighbouring words of every training document. These unigrams
and bigrams are the n-grams of the model; none is left out at any size. A pair's count is quantised to a
level, the pair is entered into a bit filter under the keys of level 1 to its own, and the count is read back
by probing level after level until a probe misses. Read counts are the least of their level, so those of the
pairs after one word never add up to more than its own count, but for a probe that errs (1 in 125).

The filters of pairs between the CLASSES most frequent words and the end are broadcast: at most
(CLASSES + 1)^2 pairs of at most 64 levels, 113 MB, whatever the input holds. All other pairs, and the exact
counts of the words beyond the HEAD most frequent, are dealt to shards whose number follows the tokens. A
pair lies in the shard of its second word if that is beyond HEAD, so that the word's own count is read beside
it; or else of its first word, if that is; or else of the pair. Scored pairs are dealt to the same shards and
probed there, so nothing that grows with the input is held in one place. A word beyond HEAD has at most one
in 65,536 tokens and a pair that isn't broadcast one in 1,024, so no shard is hot. Tokens travel packed, a
row for each batch of texts and shard, and sums of scores come back the same way.

The events are the known words and one unknown word, as in the base score. With N tokens and N1 words seen
once, the unknown word counts N1. A word after another has p(w | v) = (c(v, w) + PRIOR * c(w) / (N + N1)) /
(c(v) + PRIOR): what the pair doesn't tell comes from the word's own count. A text starts after an end. Scores
add log10 p. Beside it stands the exact base score: add-one smoothed words.

Words are told apart by a 64-bit hash: among V words, two are one with a probability of V^2 / 2^65.

Tokens are words [^\\x20\\x09-\\x0D]+ with A-Z lowered, then one end. A null text has only its end. Repeated
rows count and score separately. Without training documents every token is unknown. An empty table gives
an empty result. A long text is read in blocks; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import common

PROBES = 3
#: Bits for each entry: a fifth of the bits are set, so 1 in 125 probes errs.
ROOM = PROBES / -math.log(0.8)
BASE, TOP_LEVEL = 1.5, 64
#: The least count of every level; level 0 is 0.
LOW = np.array([0] + [math.ceil(BASE**q - 1e-9) for q in range(TOP_LEVEL)], np.float64)
#: Words, with the end, whose counts are broadcast; those whose pairs are.
HEAD, CLASSES = 65_535, 1024
PRIOR = 20.0
#: Least and most shards, and the training tokens of one between them.
SHARDS, MOST_SHARDS, SHARD_TOKENS = 256, 1 << 16, 1 << 20
#: Bytes that are split into words at once; tokens that are dealt to shards at once.
BLOCK, HELD = 1 << 20, 1 << 20
GRAM_BITS, GRAM_BYTES = 40, 5
END = np.uint64(1)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A number for each byte; A-Z have those of a-z.
_SYMBOL = np.random.default_rng(6).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SYMBOL[65:91] = _SYMBOL[97:123]
_FACTOR = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(_FACTOR)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, modulo 2^64."""
    out = []
    for base in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
        own = np.full(n, base, np.uint64)
        own[0] = 1
        out.append(np.multiply.accumulate(own))
    return out[0], out[1]


_block_powers: list[tuple[np.ndarray, np.ndarray]] = []


def words(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number of its text and hash of every word of the texts, some BLOCK bytes at a time."""
    if not _block_powers:
        _block_powers.append(_powers(BLOCK))
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, raw = column.buffers()
    if raw is None or not len(column):
        return
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    at = 0
    while at < len(data):
        to = min(at + BLOCK, len(data))
        if to < len(data):
            gaps = np.flatnonzero(_SPACE[data[at:to]])
            cut = max(at + gaps[-1] + 1 if len(gaps) else at, off[np.searchsorted(off, to, "right") - 1])
            if cut > at:
                to = int(cut)
            else:  # a word that is longer than a block ends it
                end = off[np.searchsorted(off, to)]
                gaps = np.flatnonzero(_SPACE[data[to:end]])
                to = int(to + gaps[0] if len(gaps) else end)
        own = data[at:to]
        gap = _SPACE[own]
        edges = off[np.searchsorted(off, at) : np.searchsorted(off, to)] - at
        first, last = ~gap, ~gap
        first[1:] &= gap[:-1]
        first[edges] = ~gap[edges]
        last[:-1] &= gap[1:]
        edges = edges[edges > 0] - 1
        last[edges] = ~gap[edges]
        start, end = np.flatnonzero(first), np.flatnonzero(last)
        up, down = _block_powers[0] if len(own) <= BLOCK else _powers(len(own))
        sums = np.cumsum(_SYMBOL[own] * up[: len(own)], dtype=np.uint64)
        h = (sums[end] - np.where(start > 0, sums[start - 1], np.uint64(0))) * down[start]
        if len(h):
            yield np.searchsorted(off, at + start, "right") - 1, _mix(h + (end - start).astype(np.uint64))
        at = to


def steps(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Every token of the texts: number of its text, word before it, word; the ends come last."""
    last = np.full(len(column), END)
    for doc, h in words(column):
        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        before = np.concatenate((last[doc[:1]], h[:-1]))
        before[first[1:]] = END
        ends = np.append(first[1:], len(h)) - 1
        last[doc[ends]] = h[ends]
        yield doc, before, h
    yield np.arange(len(column)), last, np.full(len(column), END)


def hash_of(word: str) -> int:
    found = [h for _, h in words(pa.array([word]))]
    return int(found[0][0])


def level_of(count: np.ndarray) -> np.ndarray:
    """The highest level whose least count isn't above."""
    return np.searchsorted(LOW[1:], count, "right")


def grams_of(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """40-bit hashes of pairs of words."""
    return _mix(_mix(v + np.uint64(0xD6E8FEB86659FD93)) + w) >> np.uint64(64 - GRAM_BITS)


class Filter:
    """A bit filter of (n-gram, level); levels() reads the levels back by probing."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.size = bits, np.uint64(8 * len(bits))

    @classmethod
    def of(cls, grams: np.ndarray, n: np.ndarray) -> Filter:
        """All levels of every n-gram, in as many bits as they need."""
        top = level_of(n)
        at = np.repeat(np.arange(len(top)), top)
        each = np.arange(len(at)) - np.repeat(np.cumsum(top) - top, top) + 1
        out = cls(np.zeros(max(8, math.ceil(len(at) * ROOM / 8)), np.uint8))
        on = np.zeros(8 * len(out.bits), bool)
        for k in out.positions(grams[at], each.astype(np.uint64)):
            on[k] = True
        out.bits = np.packbits(on, bitorder="little")
        return out

    def positions(self, grams: np.ndarray, level: np.ndarray) -> list[np.ndarray]:
        h = _mix(grams + _mix(level * np.uint64(_FACTOR) + np.uint64(1)))
        step = _mix(h) | np.uint64(1)
        return [(((h + np.uint64(k) * step) >> np.uint64(32)) * self.size >> np.uint64(32)).astype(np.int64) for k in range(PROBES)]

    def has(self, grams: np.ndarray, level: int) -> np.ndarray:
        out = np.ones(len(grams), bool)
        for at in self.positions(grams, np.array([level], np.uint64)):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return out

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """0 for n-grams that aren't in."""
        found, open_ = np.zeros(len(grams), np.int64), np.arange(len(grams))
        for q in range(1, TOP_LEVEL + 1):
            open_ = open_[self.has(grams[open_], q)]
            if not len(open_):
                break
            found[open_] = q
        return found


class Head:
    """The most frequent words by hash, their counts and classes (-1 beyond CLASSES), and what all need to know."""

    def __init__(self, counts: dict[int, int], tokens: int, distinct: int, once: int):
        counts = {int(END): 0} | counts
        self.words = np.sort(np.array(list(counts), np.uint64))
        self.counts = np.array([counts[int(w)] for w in self.words], np.float64)
        top = np.lexsort((self.words, -self.counts))
        own = np.concatenate((np.searchsorted(self.words, END)[None], top[self.words[top] != END][:CLASSES]))
        self.classes = np.full(len(self.words), -1, np.int64)
        self.classes[own] = np.arange(len(own))
        self.members = own
        self.tokens, self.total, self.unknown = tokens, max(tokens + once, 1), max(once, 1e-9)
        self.norm = math.log10(tokens + distinct + 1)
        self.shards = min(max(SHARDS, tokens // SHARD_TOKENS), MOST_SHARDS)

    def find(self, own: np.ndarray) -> np.ndarray:
        """Places in the head; -1 beyond."""
        at = np.minimum(np.searchsorted(self.words, own), len(self.words) - 1)
        return np.where(self.words[at] == own, at, -1)

    def alone(self, n: np.ndarray) -> np.ndarray:
        """PRIOR * p(w) of words with these counts."""
        return PRIOR * np.where(n > 0, n, self.unknown) / self.total

    def dealt(self, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, ...]:
        """Places of both words in the head, whether both have classes, hash and shard of the pair."""
        in_v, in_w = self.find(v), self.find(w)
        near = (in_v >= 0) & (in_w >= 0) & (self.classes[in_v] >= 0) & (self.classes[in_w] >= 0)
        gram = grams_of(v, w)
        key = np.where(in_w < 0, w, np.where(in_v < 0, v, gram))
        return in_v, in_w, near, gram, self.shard_of(key)

    def shard_of(self, key: np.ndarray) -> np.ndarray:
        return (key % np.uint64(self.shards)).astype(np.int64)


def _tally(values: list[np.ndarray], n: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and the sum of their counts."""
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    if n is None:
        own, many = np.unique(flat, return_counts=True)
        return own, many.astype(np.int64)
    own, at = np.unique(flat, return_inverse=True)
    return own, np.bincount(at, np.concatenate(n) if n else None, len(own)).astype(np.int64)


def _bytes_of_counts(own: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same counts as single bytes: a count over 255 takes several entries of its value."""
    times = (n + 254) // 255
    last = np.cumsum(times) - 1
    out = np.full(int(times.sum()), 255, np.uint8)
    out[last] = n - 255 * (times - 1)
    return np.repeat(own, times), out


def _pack(x: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bytes of each, one after another."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).ravel()


def _unpack(raw: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = raw.reshape(-1, width)
    return out.view("<u8").ravel().astype(np.uint64)


def _raw(column: pa.Array, first: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some binary values in a row, and the size of each."""
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset + first : column.offset + stop + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[off[0] : off[-1]], np.diff(off)


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """(first, stop) of the runs of rows that are equal in the columns."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    edges = [0, *np.flatnonzero(new).tolist(), len(new)]
    return list(zip(edges[:-1], edges[1:], strict=True)) if len(new) else []


def count_words(docs: DataFrame) -> DataFrame:
    """word (its hash), n over the texts of docs (text), with one end for each document."""
    common.text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out() -> pa.RecordBatch:
            own, many = _tally(held)
            return pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(many)], ["word", "n"])

        for b in batches:
            for _, _, w in steps(b.column(0)):
                held.append(w)
                n += len(w)
                if n >= HELD:
                    yield out()
                    held, n = [], 0
        yield out()

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counted: DataFrame, most: int = HEAD - 1) -> dict[int, int]:
    """Exact counts of the most frequent words, `most` at the most.

    The words above a count are taken whole; the count is found in a histogram of its logarithm, so neither
    a sort nor every task's own candidates reach the driver.
    """
    binned = counted.withColumn("bin", F.floor(F.log("n") * 100).cast("int"))
    bins = sorted(((r["bin"], r["count"]) for r in binned.groupBy("bin").count().collect()), reverse=True)
    least, total = None, 0
    for b, n in bins:
        total += n
        if total > most:
            break
        least = b
    return {} if least is None else {r.word % (1 << 64): r.n for r in binned.filter(F.col("bin") >= least).select("word", "n").collect()}


def build(docs: DataFrame, head: Head) -> DataFrame:
    """The model from training docs (text), saved: shard, words, counts (bytes of 64-bit numbers), bits. Pairs of classes lie below 0."""
    shared = docs.sparkSession.sparkContext.broadcast(head)
    names = ["shard", "words", "word_n", "grams", "gram_n"]

    def rows(shard: np.ndarray, own: np.ndarray, own_n: np.ndarray, of: np.ndarray, gram: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        """A row for each shard of its grams (shard, own, own_n) and words (of, gram, n); both sorted by shard."""
        there, first = np.unique(shard, return_index=True)
        bounds, inside = np.append(first, len(shard)), np.append(np.searchsorted(of, there), len(of))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(there.astype(np.int32)),
                common.ragged(_pack(gram, 8), inside * 8),
                common.ragged(n, inside),
                common.ragged(_pack(own, GRAM_BYTES), bounds * GRAM_BYTES),
                common.ragged(own_n, bounds),
            ], names
        )

    def tally(head: Head, held: list[tuple[np.ndarray, np.ndarray]], near: np.ndarray) -> pa.RecordBatch:
        """Counts of some tokens, those of pairs of classes aside in `near`."""
        v, w = (np.concatenate(x) for x in zip(*held, strict=True))
        in_v, in_w, is_near, gram, shard = head.dealt(v, w)
        side = len(head.members)
        near += np.bincount(head.classes[in_v[is_near]] * side + head.classes[in_w[is_near]], minlength=side * side)
        codes, n = _tally([shard[~is_near].astype(np.uint64) << np.uint64(GRAM_BITS) | gram[~is_near]])
        codes, n = _bytes_of_counts(codes, n)
        tail, many = _bytes_of_counts(*_tally([w[in_w < 0]]))
        of = head.shard_of(tail)
        order = np.argsort(of, kind="stable")
        return rows((codes >> np.uint64(GRAM_BITS)).astype(np.int64), codes, n, of[order], tail[order], many[order])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held, n = shared.value, [], 0
        near = np.zeros(len(head.members) ** 2, np.int64)
        for b in batches:
            for _, v, w in steps(b.column(0)):
                held.append((v, w))
                n += len(w)
                if n >= HELD:
                    yield tally(head, held, near)
                    held, n = [], 0
        if n:
            yield tally(head, held, near)
        # pairs of classes leave once a task, by the class of the first word
        code = np.flatnonzero(near)
        code, many = _bytes_of_counts(code, near[code])
        v, w = np.divmod(code, len(head.members))
        member = head.words[head.members]
        order = np.argsort(-1 - v, kind="stable")
        none = np.zeros(0, np.int64)
        yield rows((-1 - v)[order], grams_of(member[v], member[w])[order], many[order], none, none.view(np.uint64), none.astype(np.uint8))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: int | None = None
        held: list[list[np.ndarray]] = [[], [], [], []]

        def merge() -> None:
            for k in (0, 2):
                own, n = _tally(held[k], held[k + 1])
                held[k], held[k + 1] = [own], [n]

        def out() -> pa.RecordBatch:
            merge()
            own, n, grams, many = (x[0] for x in held)
            bits = Filter.of(grams, many).bits
            return pa.RecordBatch.from_arrays(
                [pa.array([last], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (own, n, bits))],
                ["shard", "words", "counts", "bits"],
            )

        for b in batches:
            shard = b.column(0).to_numpy()
            for i, j in _runs(shard):
                if last is not None and last != shard[i]:
                    yield out()
                    held = [[], [], [], []]
                last = int(shard[i])
                own, n, grams, many = (_raw(c, i, j)[0] for c in b.columns[1:])
                for x, new in zip(held, (_unpack(own, 8), n, _unpack(grams, GRAM_BYTES), many), strict=True):
                    x.append(new.copy())
                if sum(map(len, held[2])) > 4 * HELD + 2 * len(held[2][0]):
                    merge()
        if last is not None:
            yield out()

    counted = docs.select("text").mapInArrow(count, "shard int, words binary, word_n binary, grams binary, gram_n binary")
    folded = counted.repartition("shard").sortWithinPartitions("shard").mapInArrow(fold, "shard int, words binary, counts binary, bits binary")
    return common.saved(folded, "model")


class Near:
    """log10(c(v, w) + PRIOR * p(w)) of all pairs of classes, read from their filters once by a worker."""

    def __init__(self, head: Head, filters: dict[int, bytes]):
        member, n = head.words[head.members], head.counts[head.members]
        self.gain = np.empty((len(member), len(member)), np.float32)
        for k, v in enumerate(member):
            seen = np.zeros(len(member))
            if k in filters:
                seen = LOW[Filter(np.frombuffer(filters[k], np.uint8)).levels(grams_of(np.full(len(member), v), member))]
            seen = np.minimum(seen, np.minimum(n[k], n))
            self.gain[k] = np.log10(seen + head.alone(n))


#: What a worker has read, by the name of its build.
_near: dict[str, Near] = {}


def _ask(docs: DataFrame, head_of, filters_of) -> DataFrame:
    """Packed tokens of docs (doc_id, text) for the shards (kind 1), and what needs no shard (kind 2).

    Kind 1 has in `words` the words beyond the head, in `grams`, `refs` and `docs` the tokens: hash of the pair,
    place of the second word in `words` or in the head, and number of the text; the first `ones` tokens have words
    beyond the head. Kind 2 has a column after another in `grams`: ids, whether they are null, tokens, known, base, own.
    """
    key = uuid.uuid4().hex
    names = ["shard", "kind", "batch", "ones", "words", "grams", "refs", "docs"]

    def deal(head: Head, batch: int, doc: np.ndarray, v: np.ndarray, w: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        in_v, in_w, near, gram, shard = head.dealt(v, w)
        tail = in_w < 0
        own, ref = np.unique(w[tail], return_inverse=True)
        of = head.shard_of(own)
        order = np.argsort(of, kind="stable")
        inside = np.searchsorted(of[order], np.arange(head.shards + 1))
        if np.diff(inside).max(initial=0) > 65_535:  # more words than a place can name
            half = len(doc) // 2
            yield from deal(head, batch, doc[:half], v[:half], w[:half], sums)
            yield from deal(head, batch, doc[half:], v[half:], w[half:], sums)
            return
        place = np.empty(len(own), np.int64)
        place[order] = np.arange(len(own)) - inside[of[order]]
        refs = in_w.copy()
        refs[tail] = place[ref]
        # what needs no shard
        n_w, n_v = head.counts[in_w], head.counts[in_v]
        gain = np.where(in_v >= 0, -np.log10(n_v + PRIOR), 0.0)
        gain[near] += _near[key].gain[head.classes[in_v[near]], head.classes[in_w[near]]]
        size = sums.shape[1]
        sums[0] += np.bincount(doc, minlength=size)
        sums[1] += np.bincount(doc, ~tail & (n_w > 0), size)
        sums[2] += np.bincount(doc, np.where(tail, 0.0, np.log10(n_w + 1)) - head.norm, size)
        sums[3] += np.bincount(doc, gain, size)
        # tokens by shard, those with words beyond the head first
        far = np.flatnonzero(~near)
        far = far[np.argsort(2 * shard[far] + ~tail[far], kind="stable")]
        there, first = np.unique(shard[far], return_index=True)
        bounds = np.append(first, len(far))
        ones = np.add.reduceat(tail[far], first) if len(first) else np.zeros(0, np.int64)
        words = np.append(inside[there], len(own))
        n = len(there)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(there.astype(np.int32)),
                pa.array(np.ones(n, np.int32)),
                pa.array(np.full(n, batch, np.int64)),
                pa.array(ones.astype(np.int32)),
                common.ragged(_pack(own[order], 8), words * 8),
                common.ragged(_pack(gram[far], GRAM_BYTES), bounds * GRAM_BYTES),
                common.ragged(refs[far].astype("<u2"), bounds * 2),
                common.ragged(doc[far].astype("<u2"), bounds * 2),
            ],
            names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        head = head_of.value
        if key not in _near:
            _near.clear()
            _near[key] = Near(head, filters_of.value)
        batch = TaskContext.get().partitionId() << 32
        for whole in batches:
            for at in range(0, whole.num_rows, 1 << 16):
                b = whole.slice(at, 1 << 16)
                batch += 1
                sums, held, n = np.zeros((4, b.num_rows)), [], 0
                for x in steps(b.column(1)):
                    held.append(x)
                    n += len(x[0])
                    if n >= HELD:
                        yield from deal(head, batch, *map(np.concatenate, zip(*held, strict=True)), sums)
                        held, n = [], 0
                if n:
                    yield from deal(head, batch, *map(np.concatenate, zip(*held, strict=True)), sums)
                ids = b.column(0)
                rest = np.concatenate(
                    [ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), *sums[:2]],
                ).astype(np.int64)
                raw = rest.tobytes() + sums[2:].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch % head.shards], pa.int32()),
                        pa.array([2], pa.int32()),
                        pa.array([batch], pa.int64()),
                        pa.array([0], pa.int32()),
                        *(pa.array([x], pa.binary()) for x in (b"", raw, b"", b"")),
                    ],
                    names,
                )

    return docs.mapInArrow(run, "shard int, kind int, batch long, ones int, words binary, grams binary, refs binary, docs binary")


def _answer(asked: DataFrame, model: DataFrame, head_of) -> DataFrame:
    """Sums by batch and text, packed: docs and own; tails, known and base of the texts with words beyond the head; kind 2 goes on as `whole`."""
    names = ["batch", "docs", "own", "tails", "known", "base", "whole"]
    none = np.zeros(0, np.uint8)

    def probe(head: Head, shard: tuple | None, b: pa.RecordBatch, i: int, j: int) -> pa.RecordBatch:
        """Some rows of one shard."""
        ones = b.column(3).to_numpy()[i:j]
        (raw_words, word_sizes), (raw_grams, sizes), (refs, _), (docs, _) = (_raw(c, i, j) for c in b.columns[4:])
        own, gram = _unpack(raw_words, 8), _unpack(raw_grams, GRAM_BYTES)
        ref, doc = (np.frombuffer(x.tobytes(), "<u2").astype(np.int64) for x in (refs, docs))
        sizes = sizes // GRAM_BYTES
        row = np.repeat(np.arange(j - i), sizes)
        tail = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) < ones[row]
        seen, many = np.zeros(len(gram)), np.zeros(len(own))
        if shard is not None:
            known, counts, bits = shard
            if len(known):
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                many = np.where(known[at] == own, counts[at], 0).astype(np.float64)
            seen = LOW[bits.levels(gram)]
        first = (np.cumsum(word_sizes) - word_sizes) // 8
        n = np.empty(len(gram))
        n[tail] = many[first[row[tail]] + ref[tail]]
        n[~tail] = head.counts[ref[~tail]]
        # a word beyond the head stands before the next token as often as behind the last one
        gain = np.log10(np.minimum(seen, n) + head.alone(n)) - np.where(tail, np.log10(n + PRIOR), 0.0)
        code = row << 16 | doc
        texts, at = np.unique(code, return_inverse=True)
        bounds = np.searchsorted(texts >> 16, np.arange(j - i + 1))
        tails, at_tail = np.unique(code[tail], return_inverse=True)
        inside = np.searchsorted(tails >> 16, np.arange(j - i + 1))
        return pa.RecordBatch.from_arrays(
            [
                b.column(2).slice(i, j - i),
                common.ragged((texts & 65_535).astype("<u2"), bounds * 2),
                common.ragged(np.bincount(at, gain, len(texts)).astype("<f4"), bounds * 4),
                common.ragged((tails & 65_535).astype("<u2"), inside * 2),
                common.ragged(np.bincount(at_tail, n[tail] > 0, len(tails)).astype("<u4"), inside * 4),
                common.ragged(np.bincount(at_tail, np.log10(n[tail] + 1), len(tails)).astype("<f4"), inside * 4),
                common.ragged(none, np.zeros(j - i + 1, np.int64)),
            ],
            names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, last, now = head_of.value, None, None
        for b in batches:
            shard, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, j in _runs(shard, kind):
                if shard[i] != last:
                    last, now = shard[i], None
                if kind[i] == 0:
                    own, bits, counts = (_raw(b.column(k), i, j)[0].copy() for k in (4, 5, 6))
                    now = own.view(np.uint64), counts.view(np.int64), Filter(bits)
                elif kind[i] == 1:
                    yield probe(head, now, b, i, j)
                else:
                    empty = common.ragged(none, np.zeros(j - i + 1, np.int64))
                    yield pa.RecordBatch.from_arrays([b.column(2).slice(i, j - i), *[empty] * 5, b.column(5).slice(i, j - i)], names)

    blank = F.lit(b"").cast("binary")
    shards = model.filter("shard >= 0").select(
        "shard",
        F.lit(0).alias("kind"),
        F.lit(0).cast("long").alias("batch"),
        F.lit(0).alias("ones"),
        "words",
        F.col("bits").alias("grams"),
        F.col("counts").alias("refs"),
        blank.alias("docs"),
    )
    dealt = shards.union(asked).repartition("shard").sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(run, "batch long, docs binary, own binary, tails binary, known binary, base binary, whole binary")


def _finish(answers: DataFrame, train_tokens: int) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score from all that belongs to a batch of texts."""
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def out(sums: np.ndarray, whole: bytes) -> pa.RecordBatch:
        size = len(whole) // 48
        ids, null, tokens, known = np.frombuffer(whole[: 32 * size], np.int64).reshape(4, -1)
        base, own = np.frombuffer(whole[32 * size :], np.float64).reshape(2, -1)
        known = known + sums[0, :size].astype(np.int64)
        columns = [
            pa.array(ids, mask=null.astype(bool)),
            pa.array(tokens),
            pa.array(known),
            pa.array(np.full(size, train_tokens)),
            pa.array(base + sums[1, :size]),
            pa.array(own + sums[2, :size]),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sums, whole = None, np.zeros((3, 1 << 16)), b""
        for b in batches:
            batch = b.column(0).to_numpy()
            for i, j in _runs(batch):
                if batch[i] != last:
                    if last is not None:
                        yield out(sums, whole)
                    last, whole = batch[i], b""
                    sums[:] = 0
                docs, own, tails, known, base, rest = (_raw(c, i, j)[0].tobytes() for c in b.columns[1:])
                tails = np.frombuffer(tails, "<u2")
                np.add.at(sums[0], tails, np.frombuffer(known, "<u4"))
                np.add.at(sums[1], tails, np.frombuffer(base, "<f4"))
                np.add.at(sums[2], np.frombuffer(docs, "<u2"), np.frombuffer(own, "<f4"))
                whole += rest
        if last is not None:
            yield out(sums, whole)

    dealt = answers.repartition("batch").sortWithinPartitions("batch")
    return dealt.mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; training: a condition on doc_id."""
    spark = docs.sparkSession
    common.text_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    trained = rows.filter(training)
    counted = common.saved(count_words(trained), "words")
    tokens, distinct, once = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count(F.when(F.col("n") == 1, 1))).first()
    end = counted.filter(F.col("word") == int(END)).select("n").first()
    head = Head(most_frequent(counted) | ({int(END): end[0]} if end else {}), tokens, distinct, once)
    model = build(trained, head)
    filters = {-1 - r.shard: bytes(r.bits) for r in model.filter("shard < 0").select("shard", "bits").collect()}
    head_of, filters_of = (spark.sparkContext.broadcast(x) for x in (head, filters))
    asked = _ask(rows.withColumn("doc_id", F.col("doc_id").cast("long")), head_of, filters_of)
    found = _finish(_answer(asked, model, head_of), tokens)
    return found.select("doc_id", (~training).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
