"""Canonical exact fingerprints of documents.

The canonical form of a text is its NFKC form with case folded (and normalised again, since folding
can undo it), runs of white space made one space and the ends stripped. The fingerprint is the 128-bit
XXH3 of its UTF-8 bytes, in hex. Documents are grouped by fingerprint; inside a bucket of several the
canonical bytes themselves are grouped, so that a collision can't join different texts. The likeness
of two fingerprints is exact: 1 if they and the bytes behind them are equal, else 0.

Neighbours (the next document in descending order of id) need no global sort in one task: rows are
range-partitioned by id and text and sorted, each task looks one row ahead, and only the last row of each task waits
for the first row of the next one.

A null text is empty. Rows that share an id are ordered by their texts. Null ids come last. A document
without a successor takes the first one; a single document is its own successor. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import common

NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
ENDS = SCHEMA + ", part int, first binary, last binary"
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary()]


def canonical(text: str) -> bytes:
    folded = text.casefold() if text.isascii() else unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split()).encode("utf-8", "surrogatepass")


def fingerprint(canon: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(canon)


def edited(text: str, other: str) -> str:
    """The last half of the code points replaced by the first as many of the other text."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def _row(doc_id: int | None, text: str, canon: bytes, other: str, other_canon: bytes) -> tuple:
    new = edited(text, other)
    new_canon = canonical(new)
    return doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), fingerprint(canon), fingerprint(new_canon), float(canon == new_canon), float(canon == other_canon)


def _columns(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(TYPES)], [*NAMES, "part", "first", "last"])


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, its edited text's, and the likeness to the edited text and the next document."""
    spark = docs.sparkSession
    common.text_batches(spark)

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            texts = [x or "" for x in b.column(1).to_pylist()]
            order = [xxhash.xxh64_intdigest(x) >> 1 for x in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(order, pa.int64()), pa.array([z.compress(x.encode()) for x in texts], pa.binary())],
                ["doc_id", "tie", "z"],
            )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, unz = TaskContext.get().partitionId(), zstandard.ZstdDecompressor()
        before, first = None, None
        for b in batches:
            rows = []
            for doc_id, z in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                text = unz.decompress(z).decode()
                canon = canonical(text)
                if before is None:
                    first = z
                else:
                    rows.append((*_row(*before[:3], text, canon), None, None, None))
                before = doc_id, text, canon, z
            if rows:
                yield _columns(rows)
        if before:
            yield _columns([(before[0], *[None] * 6, part, first, before[3])])

    key = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
    ).mapInArrow(squeeze, "doc_id long, tie long, z binary")
    walked = common.saved(texts.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(walk, ENDS), "walked")

    # one row for each task: who follows whom, without the texts
    ends = [r[0] for r in walked.filter("part is not null").select("part").orderBy("part").collect()]
    if not ends:
        return walked.select(*NAMES)
    link = spark.createDataFrame([(p, ends[(k + 1) % len(ends)]) for k, p in enumerate(ends)], "part int, after int")
    edge = walked.filter("part is not null").select("doc_id", "part", "first", "last")
    pairs = edge.join(link, "part").join(
        edge.select(F.col("part").alias("after"), F.col("first").alias("head")),
        "after",
    ).select("doc_id", "last", "head")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unz = zstandard.ZstdDecompressor()
        for b in batches:
            rows = []
            for doc_id, own, head in zip(*(c.to_pylist() for c in b.columns), strict=True):
                text, other = unz.decompress(own).decode(), unz.decompress(head).decode()
                rows.append((*_row(doc_id, text, canonical(text), other, canonical(other)), None, None, None))
            yield _columns(rows)

    return walked.filter("part is null").select(*NAMES).unionByName(pairs.mapInArrow(close, ENDS).select(*NAMES))


def groups(docs: DataFrame, prints: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=fingerprint) -> DataFrame:
    """doc_id, fingerprint, class_id, class_size of documents in groups; class_id is the smallest id of the equal canonical texts.

    prints holds the fingerprint of each row. Only documents whose fingerprint may be shared are read
    again in full, and copies combine by their bytes before the shuffle. doc_id is null in rows that hold
    for all documents of a fingerprint; where one fingerprint has different bytes, each document has a row.
    """
    common.text_batches(docs.sparkSession)
    shared = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    filtered = common.bit_filter(shared, F.col("fingerprint"), "shared")

    def canon(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            own = [canonical(x or "") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([digest(x) for x in own], pa.string()), pa.array([z.compress(x) for x in own], pa.binary())],
                ["doc_id", "fingerprint", "canon"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
    ).mapInArrow(canon, "doc_id long, fingerprint string, canon binary")
    hits = common.maybe_in(rows, F.col("fingerprint"), filtered)
    same = hits.groupBy("fingerprint", "canon").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    found = common.saved(
        same.groupBy("fingerprint").agg(
            F.min("class_id").alias("class_id"),
            F.sum("class_size").alias("class_size"),
            F.count(F.lit(1)).alias("texts"),
        ), "classes"
    )
    whole = found.filter("texts = 1").select(F.lit(None).cast("long").alias("doc_id"), "fingerprint", "class_id", "class_size")
    torn = found.filter("texts > 1").select("fingerprint")
    if torn.isEmpty():
        return whole
    apart = hits.join(torn, "fingerprint", "left_semi").join(same, ["fingerprint", "canon"])
    return whole.unionByName(apart.select("doc_id", "fingerprint", "class_id", "class_size").distinct())


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`neighbours` with class_id and class_size of each document's group of equal canonical texts."""
    prints = common.saved(neighbours(docs, id_col, text_col), "prints")
    same = groups(docs, prints, id_col, text_col)
    torn = same.filter("doc_id is not null").select(
        "doc_id",
        F.col("fingerprint"),
        F.col("class_id").alias("own_id"),
        F.col("class_size").alias("own_size"),
    )
    joined = prints.join(same.filter("doc_id is null").drop("doc_id"), "fingerprint", "left").join(torn, ["doc_id", "fingerprint"], "left")
    return joined.select(
        *NAMES, F.coalesce("own_id", "class_id", "doc_id").alias("class_id"), F.coalesce("own_size", "class_size", F.lit(1)).alias("class_size")
    )
