"""Token counts of sections by offsets: a document is encoded once, as a whole, and its tokens are attributed.

Token spans and sections are both sorted intervals of one text, so their interval join is one merge: the
token ends are searched for the section ends. Tokens here cover the text's UTF-8 bytes without gaps or
overlaps, so intervals are kept in bytes, and every byte belongs to one token and one section. A token
that crosses a boundary is allocated whole, to the section that holds most of its bytes, and of equal ones
to the first; the sections' counts therefore add up to the document's.

Sections are given by a splitter: text -> names and lengths in characters, which cover the text. `lines`
is one section per line, its line end (LF, CR LF or CR) included, named `blank`, `table` (a vertical bar in
it) or `text`.

A null or empty text has one empty section named `blank` with no tokens. Texts are read whole, however long; a
run of LONG_RUN white-space characters or more, for which the tokenizer's pattern would need a stack as deep, is
set apart first, where the pattern can't cross. Repeated rows are treated alike. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import common

Sections = tuple[list[str], list[int]]

_encodings: dict[tuple[str, str], tuple] = {}


#: White-space runs from this length on are encoded as pieces of their own.
LONG_RUN = 10_000
#: White space as tokenizers' patterns have it.
SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
RUN = re.compile(SPACE + "{%d,}" % LONG_RUN)
#: The end of the patterns for which this is right: a run of white space but for its last character is one piece, the whole one at the text's end.
RUN_RULE = r"|\s+(?!\S)|\s+"
LINE = re.compile("[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+")


def lines(text: str) -> Sections:
    if "\r" in text:
        own = LINE.findall(text)
    else:
        own = [x + "\n" for x in text.split("\n")]
        own[-1] = own[-1][:-1]
        if not own[-1] and len(own) > 1:
            own.pop()
    return ["table" if "|" in x else "text" if not x.isspace() and x else "blank" for x in own], [len(x) for x in own]


def encode(encoder, text: str) -> np.ndarray:
    """The ids of a whole text."""
    runs = list(RUN.finditer(text)) if len(text) >= LONG_RUN else []
    if not runs:
        return encoder.encode_to_numpy(text, disallowed_special=()) if text else np.zeros(0, np.uint32)
    if not encoder._pat_str.endswith(RUN_RULE):
        raise ValueError(f"a run of {LONG_RUN} white-space characters needs a pattern that ends in {RUN_RULE}")
    out, at = [], 0
    for m in runs:
        end = m.end() - (m.end() < len(text))
        if at < m.start():
            out.append(encoder.encode_to_numpy(text[at : m.start()], disallowed_special=()))
        out.append(np.array(encoder._encode_single_piece(text[m.start() : end]), np.uint32))
        at = end
    if at < len(text):
        out.append(encoder.encode_to_numpy(text[at:], disallowed_special=()))
    return np.concatenate(out)


def encoding(path: str, pattern: str) -> tuple:
    """(tokenizer, bytes of each token) of a file of ranks."""
    if (path, pattern) not in _encodings:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, k in ranks.items():
            sizes[k] = len(token)
        _encodings[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes
    return _encodings[path, pattern]


def attribute(token_sizes: np.ndarray, section_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens allocated to each section, and tokens that cross each section's end; both intervals given by their sizes in bytes."""
    ends, bounds = np.cumsum(token_sizes), np.cumsum(section_sizes)
    starts = ends - token_sizes
    first = np.searchsorted(bounds, starts, "right")
    last = np.searchsorted(bounds, ends, "left")
    best = first.copy()
    for k in np.flatnonzero(last > first):
        own = np.arange(first[k], last[k] + 1)
        inside = np.minimum(bounds[own], ends[k]) - np.maximum(bounds[own] - section_sizes[own], starts[k])
        best[k] = own[inside.argmax()]
    crossing = np.zeros(len(section_sizes) + 1, np.int64)
    np.add.at(crossing, first[last > first], 1)
    np.add.at(crossing, last[last > first], -1)
    return np.bincount(best, minlength=len(section_sizes)), np.cumsum(crossing)[: len(section_sizes)]


def count(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    splitter: Callable[[str], Sections] = lines,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, section (from 0), kind, start, end (characters), n_tokens, n_crossing (tokens over its end), doc_tokens."""
    common.text_batches(docs.sparkSession)
    names = ["doc_id", "section", "kind", "start", "end", "n_tokens", "n_crossing", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sizes = encoding(ranks, pattern)
        for b in batches:
            ids, sections, kinds, starts, ends, many, over, total = ([] for _ in range(8))
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                text = text or ""
                tokens = encode(encoder, text)
                own, chars = splitter(text)
                bounds = np.cumsum(chars)
                if text.isascii():
                    inside = np.array(chars, np.int64)
                else:
                    at = [0, *bounds.tolist()]
                    inside = np.array([len(text[a:z].encode()) for a, z in zip(at, at[1:], strict=False)], np.int64)
                n, crossing = attribute(sizes[tokens], inside)
                ids += [doc_id] * len(own)
                sections += range(len(own))
                kinds += own
                starts += (bounds - chars).tolist()
                ends += bounds.tolist()
                many += n.tolist()
                over += crossing.tolist()
                total += [len(tokens)] * len(own)
            types = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip((ids, sections, kinds, starts, ends, many, over, total), types, strict=True)],
                names,
            )

    schema = "doc_id long, section long, kind string, start long, end long, n_tokens long, n_crossing long, doc_tokens long"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
