"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

A document's ids are those of the tokenizer's whole text and one end id. Documents longer than a
sequence are cut into whole sequences; the last piece may be shorter. Pieces are then placed by
bulk-synchronous best fit: pieces and gaps are kept sorted by size, longest pieces first; in each
superstep all pieces of one length look up their successor among the gaps (the smallest gap that
holds them), the k-th piece by rank takes the k-th such gap, gaps are updated, and the sweep repeats
until the pieces of that length are placed; pieces without a gap open sequences.

Sizes are integers up to the capacity, so the two sorted lists have at most `capacity` distinct sizes.
They are held as runs (size, how many, which sequences), whose number is bounded by the capacity and
not by the input. The supersteps work on the runs and give a plan: intervals of ranks -> intervals of
sequences. Ranks and placement of the pieces are computed where the pieces are.

A null or empty text gives one piece: the end id. Repeated rows are separate documents; ties are
broken by document id and piece. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import common
from tidegauge.llm.chunks import ChunkTable

CAPACITY = 4096
END_ID = 1
#: Ranks are counted in this many shares of each length, so that a length that many pieces have isn't one task.
SHARES = 64

#: Chunks that a worker's table holds (some 200 MB), and those that are tokenised together.
WORDS_HELD, TOGETHER = 800_000, 1000
#: Bytes of texts whose new chunks are tokenised together.
BATCH_BYTES = 8 << 20
#: Lines of letters below the combining marks, then perhaps punctuation: one or two of the vocabulary's words. Other lines give two empty parts.
PLAIN = re.compile("^([A-Za-z\u00e0-\u00f6\u00f8-\u00ff\u00c0-\u00d6\u00d8-\u00de]+)([.,;:!?|]+)?$|^.*$", re.M)

_tokenizers: dict[str, ChunkTable] = {}


def token_table(path: str) -> ChunkTable:
    """Chunk between blanks -> its ids as little-endian 32-bit bytes. Blanks bound every token of this vocabulary."""
    if path not in _tokenizers:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        last = np.zeros(t.get_vocab_size(), bool)
        for token, k in t.get_vocab().items():
            last[k] = token.endswith("</w>")

        def many(words: list[str]) -> dict[str, bytes]:
            """The ids of words of one kind of characters, which go to the tokenizer many at a time."""
            out = {}
            for at in range(0, len(words), TOGETHER):
                own = words[at : at + TOGETHER]
                ids = np.array(t.encode(" ".join(own), add_special_tokens=False).ids, "<u4")
                ends = (4 * (np.flatnonzero(last[ids]) + 1)).tolist()
                flat = ids.tobytes()
                out.update(zip(own, [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
            return out

        def segment(chunks: list[str]) -> list[bytes]:
            # letters and what stands behind them are words of their own, and case is dropped
            parts = PLAIN.findall("\n".join(chunks))
            known = _tokenizers[path]
            words = {w.lower() for w, _ in parts}
            words.update(p for _, p in parts)
            own = many([w for w in words if w and w not in known])
            own.update((w, known[w]) for w in words if w not in own and w)
            own[""] = b""
            out = [own[w.lower()] + own[p] for w, p in parts]
            rest = [k for k, (w, _) in enumerate(parts) if not w]
            for k, e in zip(rest, t.encode_batch_fast([chunks[k] for k in rest], add_special_tokens=False), strict=True):
                out[k] = np.array(e.ids, "<u4").tobytes()
            return out

        _tokenizers[path] = ChunkTable(segment, WORDS_HELD)
    return _tokenizers[path]


def chunked(text: str) -> list[str]:
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def ids_of(texts: list[str | None], table: ChunkTable) -> Iterator[bytes]:
    parts = [chunked(x or "") for x in texts]
    table.fill(parts)
    end = np.array([END_ID], "<u4").tobytes()
    for p in parts:
        yield b"".join([*map(table.__getitem__, p), end])


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 [, ids] for each piece of each document."""
    common.text_batches(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(tokenizer)
        for b in common.together(batches, BATCH_BYTES):
            out: list[list] = [[] for _ in range(5 + with_ids)]
            for doc_id, ids in zip(b.column(0).to_pylist(), ids_of(b.column(1).to_pylist(), table), strict=True):
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    row = (doc_id, k, at // 4, len(own) // 4, zlib.crc32(own), np.frombuffer(own, "<i4"))
                    for column, x in zip(out, row, strict=False):
                        column.append(x)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=False)],
                schema.replace(" array<int>", "").replace(" long", "").replace(" int", "").split(", "),
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(cut, schema)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Moves (length, first rank, first sequence, how many, offset) that place counts[length] pieces, and the number of sequences.

    gaps[g]: intervals of sequences that have g places left. Every interval is the result of whole moves,
    so their number doesn't depend on the counts.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes = np.zeros(capacity + 1, bool)
    moves, used = [], 0
    for length in sorted((n for n, k in counts.items() if k), reverse=True):
        rank, left = 0, counts[length]
        while left:
            up = np.flatnonzero(sizes[length:])
            if len(up):
                g = length + int(up[0])
                first, many = gaps[g].pop()
                take = min(many, left)
                if many > take:
                    gaps[g].append((first + take, many - take))
                elif not gaps[g]:
                    sizes[g] = False
            else:
                # as many new sequences as their repeated filling with this length needs
                g, first = capacity, used
                take = -(-left // (capacity // length))
                used += take
            moves.append((length, rank, first, take, capacity - g))
            rank, left = rank + take, left - take
            if g > length:
                gaps.setdefault(g - length, []).append((first, take))
                sizes[g - length] = True
    return moves, used


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to the pieces (doc_id, piece, length and any other columns)."""
    from pyspark.sql import Window

    cut = cut.withColumn("_share", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SHARES)).cast("int"))
    # at most capacity x SHARES rows, of which only the capacity sums over shares reach the driver
    tally = common.saved(cut.groupBy("length", "_share").agg(F.count(F.lit(1)).alias("_n")), "tally")
    counts = {r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    bases = tally.select("length", "_share", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    moves, _ = best_fit(counts, capacity)
    table = np.array(moves or np.zeros((0, 5)), np.int64).reshape(-1, 5)
    # one sorted key of length and rank: a rank is below 2**48
    shared = cut.sparkSession.sparkContext.broadcast(table[np.lexsort((table[:, 1], table[:, 0]))])
    names = [c for c in cut.columns if c != "_share"]
    schema = cut.drop("_share").schema.add("sequence_id", "long").add("offset", "long")
    ranked = cut.withColumn(
        "_rank",
        F.row_number().over(Window.partitionBy("length", "_share").orderBy("doc_id", "piece")),
    ).join(bases, ["length", "_share"])
    ranked = ranked.select(*names, (F.col("_base") + F.col("_rank") - 1).cast("long").alias("_rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, ranks, firsts, _, offsets = shared.value.T
        keys = (lengths << 48) + ranks
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in ("length", "_rank"))
            k = np.searchsorted(keys, (length << 48) + rank, "right") - 1
            columns = [b.column(b.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(firsts[k] + rank - ranks[k]), pa.array(offsets[k])],
                [*names, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 [, ids], sequence_id, offset for every piece."""
    cut = common.saved(pieces(docs, tokenizer, capacity, id_col, text_col, with_ids), "pieces")
    return pack(cut, capacity)
