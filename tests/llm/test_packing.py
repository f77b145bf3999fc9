import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidegauge.llm import packing
from tidegauge.llm.chunks import ChunkTable

PATH = public_tokenizers.path("word_bpe_49k.json")


def random_texts(n):
    rng = random.Random(3)
    parts = list("ab c  \n\t.,é▁ü1日🙂́'") + ["the ", "And, ", "\x1c", "\xa0", "\x85", "<|endoftext|>", "'s", "Σ", "İ", "ﬁ", "xyz|", "straße ", "ÀÉ! "]
    return ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(n)]


def test_ids_are_the_librarys():
    t, table = Tokenizer.from_file(PATH), packing.token_table(PATH)
    texts = random_texts(3000)
    for text, ids in zip(texts, packing.ids_of(texts, table), strict=True):
        assert list(np.frombuffer(ids, "<u4")) == t.encode(text, add_special_tokens=False).ids + [1], text


def test_a_full_table_starts_afresh():
    table = ChunkTable(lambda own: [c * 2 for c in own], limit=3)
    for chunks in (["a", "b"], ["b", "c", "d"], ["a", "e", "f", "g"]):
        table.fill(c for c in chunks)
        assert all(table[c] == c * 2 for c in chunks)


def test_best_fit_places_every_piece_once():
    rng = random.Random(1)
    counts = {rng.randint(1, 64): rng.randint(1, 50) for _ in range(40)}
    moves, used = packing.best_fit(counts, 64)
    seen, filled = {n: 0 for n in counts}, {}
    for length, rank, first, many, offset in moves:
        assert rank == seen[length]
        seen[length] += many
        for s in range(first, first + many):
            assert filled.get(s, 0) == offset and offset + length <= 64
            filled[s] = offset + length
    assert seen == counts and len(filled) == used

    # what best fit decreasing does one piece at a time
    gaps = []
    for n in sorted((n for n, k in counts.items() for _ in range(k)), reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((64 if fit is None else fit) - n)
    assert used == len(gaps)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_packed_documents(spark, capacity):
    texts = [*random_texts(150), None, "", "word " * 100, "word " * 100, "word " * 31, "a" * 3000]
    rows = [(k if k != 3 else 2, t, k) for k, t in enumerate(texts)] + [(None, "no id", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = packing.pack_documents(docs, PATH, capacity, with_ids=True).collect()
    t = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text, _ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            want.append((str(doc_id), k, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), own))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got) == sorted(want)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


def test_only_the_table_in_use_stays_filled():
    a, b = (ChunkTable(lambda own: [c * 2 for c in own]) for _ in range(2))
    a.fill(["x"])
    b.fill(["y"])
    assert not a and b == {"y": "yy"}
    b.fill(["z"])
    assert len(b) == 2
    a.fill(["x"])
    assert a == {"x": "xx"} and not b
