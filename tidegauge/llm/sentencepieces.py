"""SentencePiece encoding and decoding by a table of distinct marked words.

In this kind of vocabulary no piece has the whitespace marker behind another character, so a text
falls into chunks, a run of markers and what follows up to the next one, that the library segments
independently. Each distinct chunk is encoded and decoded once by a worker's table, by the library
itself; ids and decoded texts are joined back by position. `chunkable` checks the condition, and the
whole texts go to the library where it doesn't hold.

A null text is empty and has no ids. Ties and repeated rows are separate rows with equal results; an
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import common
from tidegauge.llm.chunks import ChunkTable

MARK = "▁"
CHUNK = re.compile(" *[^ ]+| +$")

_models: dict[str, tuple] = {}


def chunkable(model: str) -> bool:
    """Whether pieces can't cross markers and the model changes no characters of its own."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(model, "rb") as f:
        m.ParseFromString(f.read())
    n = m.normalizer_spec
    plain = not n.precompiled_charsmap and n.add_dummy_prefix and not n.remove_extra_whitespaces and n.escape_whitespaces
    own = any(p.type == pb.ModelProto.SentencePiece.USER_DEFINED for p in m.pieces)
    return plain and not own and not any(MARK in p.piece.lstrip(MARK) for p in m.pieces)


def _load(model: str):
    if model not in _models:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)

        def segment(chunks: list[str]) -> Iterator[tuple[str, int, str]]:
            # the first marker of a chunk is the one that the library puts before a text
            ids = sp.encode([c[1:] for c in chunks], num_threads=1)
            for c, own, back in zip(chunks, ids, sp.decode(ids, num_threads=1), strict=True):
                if len(c) == 1:
                    # the library puts no marker before an empty text: a lone marker comes from a longer one
                    own, back = [sp.piece_to_id(MARK)], ""
                yield ",".join(map(str, own)), len(own), back

        _models[model] = sp, ChunkTable(segment), chunkable(model)
    return _models[model]


def chunks_of(text: str) -> list[str]:
    return CHUNK.findall(" " + text.replace(MARK, " ")) if text else []


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """doc_id, n_tokens and ids (array), decoded; or with `digest` their SHA-256 as ids_sha256, decoded_sha256."""
    common.text_batches(docs.sparkSession)
    schema = "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string")
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.int64(), *([pa.string(), pa.string()] if digest else [pa.list_(pa.int32()), pa.string()])]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, table, split = _load(model)
        for b in batches:
            texts = [x or "" for x in b.column(1).to_pylist()]
            rows = []
            if split:
                parts = [chunks_of(x) for x in texts]
                table.fill(parts)
                for p in parts:
                    own = [table[c] for c in p]
                    rows.append((sum(x[1] for x in own), ",".join([x[0] for x in own]), " ".join([x[2] for x in own])))
            else:
                for x in texts:
                    ids = sp.encode(x)
                    rows.append((len(ids), ",".join(map(str, ids)), sp.decode(ids)))
            n, ids, back = zip(*rows, strict=True) if rows else ((), (), ())
            out = [n, [sha(x) for x in ids], [sha(x) for x in back]] if digest else [n, [[int(i) for i in x.split(",") if i] for x in ids], back]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(out, types[1:], strict=True))], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
