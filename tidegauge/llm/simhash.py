"""Near-duplicate detection by SimHash fingerprints, with candidates from the binary Golay code.

A fingerprint has 64 bits: bit i is set if it is set in over half of the XXH64 hashes (seed 42) of the
text's shingles. Two fingerprints link if they differ in at most 4 bits.

Candidates: the 64 bits are cut into three segments of at most 23 bits. The perfect (23, 12, 7) Golay
code puts every segment within 3 bits of exactly one codeword; a segment 3 bits away has five more
codewords 4 bits away. A segment's keys are the indices of its nearest codeword and, at distance 3, of
those five. Two segments that differ in at most 2 bits share a key. Of 4 differing bits at most 2 fall
into the two best segments together, so linked fingerprints share a pair of keys in one of the three
pairs of segments: nothing is missed, and every candidate is verified on its 64 bits.

With `blocks` over 1 a fingerprint has so many blocks of 64 bits, whose hashes come from the shingles' by
mixing. Every block gives keys of its own, and links are verified on all blocks together: `bits` of them may
differ. Beyond 4 the keys no longer promise every link, but each block is another chance.

With `similarity` the fingerprints only propose: two texts link if the sets of their shingles' hashes have an
exact Jaccard similarity of `similarity` or more and their fingerprints lie in one component. A cosine c of two
sets makes a share of arccos(c) / pi of the bits differ: 0.15 for sets of similarity 0.8. One block's keys meet
there with probability 0.71, five blocks' with 0.998 (simulated), beside the paths over further copies; and
VERIFIED_BITS of 320 is three standard deviations above the differing bits that are expected. Texts of one set
are one. The sets of a large component are first held against one of them, where they lie, which settles a group of
copies of one text. What isn't settled of a component meets in one task, or, if it has over CHUNK bytes, two of its
chunks do.

Keys travel packed, a row for each batch of fingerprints and shard. Shards follow the number of fingerprints.
Only distinct fingerprints get keys. Inside a bucket, a link is reported only if it connects two parts
that aren't connected yet, so a bucket of n reports at most n - 1 links; components are unchanged by this.

A null or blank text has fingerprint zero and links like any other. Rows that share an id have one row
each. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import common
from tidegauge.llm.chunks import release
from tidegauge.llm.components import components

WORDS, BITS = 4, 4
WIDTHS = (22, 21, 21)
#: Generator polynomial of the Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0xC75
#: Blocks, and bits that may differ, where similarity is verified.
VERIFIED_BLOCKS, VERIFIED_BITS = 5, 70
#: Sets of a component from which on they are first held against a pivot where they lie.
MANY = 256
#: Bytes of the sets that are verified in one task, but for a pair of chunks; least shards of keys, and keys of one.
CHUNK, SHARDS, SHARD_KEYS = 16 << 20, 64, 1 << 20
#: Buckets up to this size are compared all at once, larger ones by pivots.
SMALL = 12
#: Linked fingerprints that a task holds before it reports and forgets them.
HELD = 200_000


def _mixed(h: np.ndarray, block: int) -> np.ndarray:
    """The hashes of a further block."""
    if block:
        h = (h ^ (h >> np.uint64(31))) * (np.uint64(0x9E3779B97F4A7C15) + np.uint64(2 * block))
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """The hashes of the text's shingles in order, repeats included; none without words."""
    own = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    joined, n = b" ".join(own), max(1, len(own) - words + 1)
    ends = np.cumsum([len(w) + 1 for w in own]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(words, len(own)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)), np.uint64, n)


def fingerprint_of(hashes: np.ndarray, blocks: int = 1) -> int:
    """The blocks of 64 bits, the first one highest; 0 for no hashes."""
    out, n = 0, len(hashes)
    for block in range(blocks if n else 0):
        votes = np.zeros(64, np.int64)
        for k in range(0, n, 1 << 16):
            part = _mixed(hashes[k : k + (1 << 16)], block).astype("<u8")
            votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out = out << 64 | int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])
    return out


def fingerprint(text: str | None, words: int = WORDS, blocks: int = 1) -> int:
    return fingerprint_of(shingle_hashes(text, words), blocks)


@cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits; by syndrome: error patterns to near codewords and their number."""

    def remainder(x: int) -> int:
        for k in range(22, 10, -1):
            if x >> k & 1:
                x ^= GENERATOR << (k - 11)
        return x

    unit = [remainder(1 << k) for k in range(23)]
    low, high = np.zeros(1 << 12, np.int64), np.zeros(1 << 11, np.int64)
    for k in range(12):
        low[1 << k : 2 << k] = low[: 1 << k] ^ unit[k]
    for k in range(11):
        high[1 << k : 2 << k] = high[: 1 << k] ^ unit[12 + k]
    near, many = np.zeros((1 << 11, 6), np.int64), np.zeros(1 << 11, np.int64)
    weight = np.zeros(1 << 11, np.int64)
    for w in range(5):
        for at in combinations(range(23), w):
            s = 0
            for k in at:
                s ^= unit[k]
            if w < 4 or weight[s] == 3:
                near[s, many[s]] = sum(1 << k for k in at)
                many[s] += 1
                weight[s] = min(w, 3) if w < 4 else 3
    return low, high, near, many


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Up to six 12-bit codeword indices of each 23-bit word, and how many of them count."""
    low, high, near, many = _golay()
    s = low[words & 4095] ^ high[words >> 12]
    return (words[:, None] ^ near[s]) >> 11, many[s]


def pair_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, index of the fingerprint that each key belongs to); prints: uint64."""
    segments, at = [], 0
    for width in WIDTHS:
        segments.append(segment_keys(((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)))
        at += width
    keys, owners = [], []
    for p, (i, j) in enumerate(combinations(range(len(WIDTHS)), 2)):
        (a, na), (b, nb) = segments[i], segments[j]
        for x in range(6):
            for y in range(6):
                use = np.flatnonzero((na > x) & (nb > y))
                keys.append(p << 24 | a[use, x] << 12 | b[use, y])
                owners.append(use)
    return np.concatenate(keys).astype(np.int32), np.concatenate(owners)


class Forest:
    """Union-find over fingerprints; keeps the smallest as root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (y := up.get(top, top)) != top:
            top = y
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def join(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.up.setdefault(min(a, b), min(a, b))

    def links(self) -> list[tuple[int, int]]:
        return [(x, r) for x in list(self.up) if (r := self.root(x)) != x]


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints [row, block]."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def _whole(prints: np.ndarray) -> list[int]:
    """Fingerprints [row, block] as integers."""
    out = prints[:, 0].tolist()
    for k in range(1, prints.shape[1]):
        out = [a << 64 | b for a, b in zip(out, prints[:, k].tolist(), strict=True)]
    return out


def link_bucket(prints: np.ndarray, bits: int, forest: Forest) -> None:
    """Connects the fingerprints of one bucket, pivot by pivot, until they are one component or all pairs are seen."""
    part, names = np.arange(len(prints)), _whole(prints)
    for i in range(len(prints) - 1):
        apart = np.flatnonzero(part[i + 1 :] != part[i]) + i + 1
        if not len(apart):
            if (part == part[0]).all():
                return
            continue
        for j in apart[_differ(prints[apart], prints[i]) <= bits]:
            if part[j] != part[i]:
                part[part == part[j]] = part[i]
                forest.join(names[i], names[j])


def link_runs(keys: np.ndarray, prints: np.ndarray, bits: int, forest: Forest) -> None:
    """Connects the fingerprints [row, block] of whole buckets, given as rows sorted by key."""
    edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(edge, len(keys)))
    small = np.repeat(sizes <= SMALL, sizes)
    k, p = keys[small], prints[small]
    for step in range(1, min(SMALL, int(sizes.max(initial=1)))):
        same = np.flatnonzero(k[step:] == k[:-step])
        near = same[_differ(p[same], p[same + step]) <= bits]
        for a, b in zip(_whole(p[near]), _whole(p[near + step]), strict=True):
            forest.join(a, b)
    for a, n in zip(edge[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        link_bucket(prints[a : a + n], bits, forest)


def fingerprints(
    docs: DataFrame,
    words: int = WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    blocks: int = 1,
    sets: bool = False,
) -> DataFrame:
    """doc_id, print (the fingerprint in hex); with `sets` the fingerprint of the set of hashes, and digest, the set's XXH3 in hex."""
    common.text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            hashes = [shingle_hashes(x, words) for x in b.column(1).to_pylist()]
            if sets:
                hashes = [np.unique(h) for h in hashes]
            columns = [b.column(0), pa.array([f"{fingerprint_of(h, blocks):0{16 * blocks}x}" for h in hashes], pa.string())]
            if sets:
                columns.append(pa.array([digest_of(h) for h in hashes], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "print", "digest"][: len(columns)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, print string" + ", digest string" * sets)


def digest_of(own: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(own.tobytes())


def links(prints: DataFrame, bits: int = BITS, blocks: int = 1) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints that share a key and differ in at most `bits`, directly or in steps."""
    distinct = common.saved(prints.select("print").distinct(), "distinct")
    shards = max(SHARDS, 85 * blocks * distinct.count() // SHARD_KEYS)
    # a fingerprint's keys of one codeword index lie side by side, and so in one shard, while there are enough of these
    shift = 12 if shards <= 4096 * blocks else 0

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                raw = bytes.fromhex("".join(whole.column(0).slice(at, 4096).to_pylist()))
                own = np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, blocks)
                keys, owners = (
                    np.concatenate(x) for x in zip(*((k | j << 26, o) for j in range(blocks) for k, o in [pair_keys(own[:, j])]), strict=True)
                )
                shard = (_mixed((keys >> shift).astype(np.uint64), 1) >> np.uint64(20)) % np.uint64(shards)
                order = np.lexsort((owners, shard))
                keys, owners, shard = keys[order].astype("<i4"), owners[order], shard[order].astype(np.int32)
                # each fingerprint goes once to a shard
                new = np.concatenate(([True], (shard[1:] != shard[:-1]) | (owners[1:] != owners[:-1])))
                there, first = np.unique(shard, return_index=True)
                bounds = np.append(first, len(keys))
                place = np.cumsum(new) - 1
                inside = np.append(place[first], new.sum())
                refs = (place - np.repeat(inside[:-1], np.diff(bounds))).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(there),
                        common.ragged(keys, bounds * 4),
                        common.ragged(refs, bounds * 2),
                        common.ragged(own[owners[new]].astype("<u8"), inside * 8 * blocks),
                    ],
                    ["shard", "keys", "refs", "prints"],
                )

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, last = Forest(), None
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            found = forest.links()
            forest.up.clear()
            return pa.RecordBatch.from_arrays([pa.array([f"{x[k]:0{16 * blocks}x}" for x in found], pa.string()) for k in (0, 1)], ["a", "b"])

        def link() -> None:
            keys, own = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(keys, kind="stable")
            link_runs(keys[order], own[order], bits, forest)

        for b in batches:
            for shard, keys, refs, own in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if shard != last and held:
                    link()
                    held = []
                    if len(forest.up) > HELD:
                        yield out()
                last = shard
                held.append((np.frombuffer(keys, "<i4"), np.frombuffer(own, "<u8").reshape(-1, blocks)[np.frombuffer(refs, "<u2")]))
        if held:
            link()
        yield out()

    keyed = distinct.mapInArrow(key, "shard int, keys binary, refs binary, prints binary")
    return keyed.repartition("shard").sortWithinPartitions("shard").mapInArrow(sweep, "a string, b string")


def _labels(nodes: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """name, component_id from nodes (name, least) and the components found (node, root)."""
    rooted = common.saved(
        nodes.join(found, F.col(name) == F.col("node"), "left").select(name, "least", F.coalesce("root", name).alias("root")),
        "rooted",
    )
    tops = common.saved(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "tops")
    return common.saved(rooted.join(tops, "root").select(name, "component_id"), "labels")


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    blocks: int = 1,
) -> DataFrame:
    """doc_id, fingerprint (hex), component_id (smallest id reachable over links) for every row."""
    prints = common.saved(fingerprints(docs, words, id_col, text_col, blocks), "prints")
    found = components(links(prints, bits, blocks))
    label = _labels(prints.groupBy("print").agg(F.min("doc_id").alias("least")), found, "print")
    return prints.join(label, "print").select(
        "doc_id", F.col("print").alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def link_sets(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links that connect the sorted sets of similarity `similarity` or more, directly or in steps; pivot by pivot."""
    part, sizes, out = np.arange(len(sets)), np.array([len(s) for s in sets]), []
    for i in range(len(sets) - 1):
        small, large = np.minimum(sizes, sizes[i]), np.maximum(sizes, sizes[i])
        apart = i + 1 + np.flatnonzero((part[i + 1 :] != part[i]) & (small[i + 1 :] >= similarity * large[i + 1 :] - 1e-9) & (small[i + 1 :] > 0))
        if not len(apart):
            if (part == part[0]).all():
                break
            continue
        for k in range(0, len(apart), 512):
            own = apart[k : k + 512]
            flat = np.concatenate([sets[j] for j in own])
            at = np.minimum(np.searchsorted(sets[i], flat), sizes[i] - 1)
            both = np.bincount(np.repeat(np.arange(len(own)), sizes[own]), sets[i][at] == flat, len(own))
            for j in own[both >= similarity * (sizes[own] + sizes[i] - both) - 1e-9]:
                if part[j] != part[i]:
                    part[part == part[j]] = part[i]
                    out.append((i, int(j)))
    return out


def against_pivots(sets: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(links, sets that are still to be compared) of saved sets (root, digest, hashes), after one pivot for each large component.

    A component of MANY sets or more has the set of its smallest digest as pivot, and every set is held against it where
    it lies. Distances 1 - similarity obey the triangle inequality: a set that isn't linked to the pivot can be linked
    to one that is only if its similarity to the pivot is 2 * similarity - 1 or more. Without such a set the linked ones
    are done, and only the others are compared among themselves.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for own, pivot in zip(b.column(2).to_pylist(), b.column(4).to_pylist(), strict=True):
                x, y = np.frombuffer(own, np.uint64), np.frombuffer(pivot, np.uint64)
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) and len(y) else 0
                out.append(both / max(len(x) + len(y) - both, 1))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(out, pa.float64())], ["root", "digest", "hashes", "pivot", "s"])

    large = common.saved(sets.groupBy("root").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MANY).select("root"), "large")
    if large.isEmpty():
        return sets.select(F.col("digest").alias("a"), F.col("digest").alias("b")).limit(0), sets
    pivots = sets.join(large, "root", "left_semi").groupBy("root").agg(F.min(F.struct("digest", "hashes")).alias("p"))
    pivots = common.saved(pivots.select("root", F.col("p.digest").alias("pivot"), F.col("p.hashes").alias("held")), "pivots")
    joined = sets.join(pivots, "root").select("root", "digest", "hashes", "pivot", "held")
    judged = common.saved(joined.mapInArrow(judge, "root string, digest string, hashes binary, pivot string, s double"), "judged")
    linked, reach = F.col("s") >= similarity - 1e-9, F.col("s") >= 2 * similarity - 1 - 1e-9
    open_ = common.saved(judged.filter(~linked & reach).select("root").distinct(), "open")
    rest = judged.filter(~linked).select("root", "digest", "hashes").unionByName(
        judged.filter(linked).join(open_, "root", "left_semi").select("root", "digest", "hashes"),
    )
    links = judged.filter(linked & (F.col("digest") != F.col("pivot"))).select(F.col("digest").alias("a"), F.col("pivot").alias("b"))
    return links, sets.join(large, "root", "left_anti").select("root", "digest", "hashes").unionByName(rest)


def verified_links(rows: DataFrame, prints: DataFrame, loose: DataFrame, words: int, similarity: float) -> DataFrame:
    """Links (a, b) of digests that connect the texts of rows (doc_id, text) of one loose component (node, root) by their sets."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [np.unique(shingle_hashes(x, words)) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest_of(s) for s in own], pa.string()), pa.array([s.tobytes() for s in own], pa.binary())],
                ["digest", "hashes"],
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, names, sets = None, [], []

        def out() -> pa.RecordBatch:
            found = link_sets(sets, similarity)
            return pa.RecordBatch.from_arrays([pa.array([names[x[k]] for x in found], pa.string()) for k in (0, 1)], ["a", "b"])

        for b in batches:
            for root, i, j, name, own in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (root, i, j) != last:
                    if len(sets) > 1:
                        yield out()
                    last, names, sets = (root, i, j), [], []
                names.append(name)
                sets.append(np.frombuffer(own, np.uint64))
        if len(sets) > 1:
            yield out()

    nodes = prints.groupBy("print", "digest").agg(F.min(F.coalesce("doc_id", F.lit(0))).alias("id"))
    rooted = nodes.join(loose, F.col("print") == F.col("node"), "left").select("digest", "id", F.coalesce("root", "print").alias("root"))
    rooted = common.saved(rooted, "rooted")
    # saved, so that the join has shuffles of its own, which adaptive execution can split
    several = common.saved(rooted.groupBy("root").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("root"), "several")
    members = common.saved(rooted.join(several, "root", "left_semi"), "members")
    # one row has the text of a digest; rows that share its id may come along
    near = common.bit_filter(members, F.col("id"), "near")
    texts = common.maybe_in(rows, F.coalesce("doc_id", F.lit(0).cast("long")), near).select("text")
    wanted = members.select("digest").distinct()
    sets = texts.mapInArrow(gather, "digest string, hashes binary").join(wanted, "digest", "left_semi").dropDuplicates(["digest"])
    links, sets = against_pivots(common.saved(members.select("root", "digest").join(sets, "digest"), "sets"), similarity)
    chunks = sets.groupBy("root").agg(F.greatest(F.lit(1), F.ceil(F.sum(F.length("hashes")) / CHUNK)).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("digest"), F.col("chunks")).cast("int")
    dealt = sets.join(common.saved(chunks, "chunks"), "root").withColumn("own", own).withColumn(
        "other",
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)),
    )
    dealt = dealt.select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "digest", "hashes")
    return links.unionByName(dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(compare, "a string, b string"))


def near_copies(
    docs: DataFrame,
    words: int,
    similarity: float,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int = VERIFIED_BITS,
    blocks: int = VERIFIED_BLOCKS,
) -> DataFrame:
    """doc_id, component_id (smallest id reachable over links of similarity `similarity` or more) for every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prints = common.saved(fingerprints(rows, words, blocks=blocks, sets=True), "prints")
    loose = common.saved(components(links(prints, bits, blocks)), "loose")
    found = components(verified_links(rows, prints, loose, words, similarity))
    label = _labels(prints.groupBy("digest").agg(F.min("doc_id").alias("least")), found, "digest")
    return prints.join(label, "digest").select("doc_id", F.coalesce("component_id", "doc_id").alias("component_id"))


def drop_near_copies(
    docs: DataFrame,
    words: int = WORDS,
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float | None = None,
) -> DataFrame:
    """The rows of docs that stay, with all their columns: those whose id is the smallest of its component.

    With `similarity` the components are those of near_copies, else of near_duplicates. Rows that share an id
    stay or go together; rows with a null id stay. Rows that the filter of dropped ids rules out pass unmoved.
    """
    if similarity is None:
        label = near_duplicates(docs, words, bits, id_col, text_col)
    else:
        label = near_copies(docs, words, similarity, id_col, text_col)
    stays = label.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"))
    return common.without_ids(docs, id_col, stays.filter("not stays").select("doc_id"))
