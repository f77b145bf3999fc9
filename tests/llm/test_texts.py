"""Fingerprints, exact deduplication, SentencePiece, token counts: against brute force on small tables."""

import hashlib
import random

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken  # noqa: F401
import xxhash
from pyspark.sql import functions as F

from tidegauge.llm import common, exact_dedup, fingerprints, sentencepieces, tokencounts

SCHEMA = "doc_id long, text string, digest string, row int, norm string, _hit int, rank int, piece int"


def texts(n, seed=1):
    rng = random.Random(seed)
    parts = list("ab c  \n\t.,é▁ü1日🙂́'|") + ["the ", "Word ", "\x0b", "\x1c", "\xa0", "<s>", "<0x0A>", "Σ", "İ", "ﬁ"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "d", k, "n", 1, 2, 3) for k, (i, t) in enumerate(rows)], SCHEMA)


def cases(spark):
    own = texts(120) + [None, "", " \t", "a b", "ab", "a  b", "A b", "x" * 50_000, "x " * 20_000]
    return [(500 - 2 * k, t) for k, t in enumerate(own)] + [(3, "a b"), (3, "a b"), (5, "same"), (7, "sa me"), (None, "a b")]


def brute_dedup(rows):
    blank = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(blank), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        norm = (t or "").translate(blank)
        best = min(groups[norm])[3]
        out.append((str(i), str(best), len(groups[norm]), i == best, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out)


def test_exact_dedup(spark):
    rows = cases(spark)
    docs = table(spark, rows)
    as_rows = lambda df: sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in df.collect())
    want = brute_dedup(rows)
    got = exact_dedup.deduplicate(docs)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got.collect()) == want
    # a digest of four values: only the comparison of bytes can tell texts apart
    weak = exact_dedup.deduplicate(docs, digest=lambda norm: (F.length(norm) % 4).cast("string"))
    assert as_rows(weak) == [w[:4] for w in want]
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({w[1] for w in want if w[3]})
    assert exact_dedup.deduplicate(docs.limit(0)).count() == 0 and exact_dedup.drop_copies(docs.limit(0)).count() == 0


def test_index_grows_by_runs_and_holds_batches_against_all_earlier_ones(spark):
    rows = cases(spark)
    random.Random(2).shuffle(rows)
    weak = lambda norm: (F.length(norm) % 4).cast("string")
    for digest, batches in ((exact_dedup.sha256, 6), (weak, 3)):
        index, earlier, seen = exact_dedup.Index(), None, []
        for k in range(batches):
            own = rows[k::batches]
            docs = table(spark, own)
            got = exact_dedup.deduplicate(docs, digest=digest, index=index, earlier=earlier)
            seen += own
            want = {(w[0], w[1], w[2], w[3]) for w in brute_dedup(seen)}
            found = [(str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got.collect()]
            assert len(found) == len(own) and set(found) <= want
            earlier = docs if earlier is None else earlier.unionByName(docs)
        levels = sorted(r.level for r in index.runs)
        assert levels == ([0, 0, 1] if batches == 6 else [0, 0, 0])
        assert sum(r.rows.agg(F.sum("size")).first()[0] for r in index.runs) == len(rows)
    assert exact_dedup.deduplicate(table(spark, rows).limit(0), index=index).count() == 0


def test_fingerprints(spark):
    rows = cases(spark)
    docs = table(spark, rows).repartition(3)
    got = fingerprints.fingerprint_documents(docs).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), xxhash.xxh64_intdigest(r[1] or "") >> 1))
    canon = {k: fingerprints.canonical(t or "") for k, (_, t) in enumerate(order)}
    want = []
    for k, (i, t) in enumerate(order):
        n = (k + 1) % len(order)
        text, other = t or "", order[n][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + other[:half]
        new_canon = fingerprints.canonical(new)
        same = [j for m, (j, _) in enumerate(order) if canon[m] == canon[k] and j is not None]
        class_id = min(same) if same else None
        want.append((str(i), len(text), hashlib.sha256(new.encode()).hexdigest(), float(new_canon == canon[k]), float(canon[n] == canon[k]), str(class_id)))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.near_edited, r.near_next, str(r.class_id)) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.fingerprint, set()).add(r.class_id)
    assert all(len(x) == 1 for x in by.values())
    assert fingerprints.fingerprint_documents(docs.limit(0)).count() == 0
    one = fingerprints.fingerprint_documents(docs.filter("doc_id = 5")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_torn_buckets_are_told_apart_by_bytes(spark):
    docs = table(spark, [(1, "aa"), (2, "bb"), (3, "AA"), (4, "ccc")])
    weak = lambda x: str(len(x))
    prints = spark.createDataFrame([("2",), ("2",), ("2",), ("3",)], "fingerprint string")
    got = {r.doc_id: (r.class_id, r.class_size) for r in fingerprints.groups(docs, prints, digest=weak).collect()}
    assert got == {1: (1, 2), 3: (1, 2), 2: (2, 1)}


def test_canonical_form():
    c = fingerprints.canonical
    assert c("ＡＢＣ  x\n") == c("abc x") == b"abc x"
    assert c("é") == c("é") == c("É") and c("straße") == c("STRASSE")


def test_sentencepieces(spark):
    model = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    assert sentencepieces.chunkable(model)
    rows = [(k, t) for k, t in enumerate(texts(300, 2))] + [(900, None), (901, " "), (902, "  "), (903, "a" * 5000), (904, "x  " * 3000), (None, "a")]
    docs = table(spark, rows)
    got = {r.doc_id: r for r in sentencepieces.encode(docs, model).collect()}
    hashed = {r.doc_id: r for r in sentencepieces.encode(docs, model, digest=True).collect()}
    for i, t in rows:
        ids = sp.encode(t or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids) and got[i].decoded == sp.decode(ids), t
        assert hashed[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert hashed[i].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    assert sentencepieces.encode(docs.limit(0), model).count() == 0


def test_token_counts(spark):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoder, sizes = tokencounts.encoding(path, pattern)
    rows = [(k, t) for k, t in enumerate(texts(200, 3))] + [(900, None), (901, ""), (902, "\n\n\n"), (903, "a\r\nb\n\n c|d"), (904, "word " * 3000), (None, "a")]
    got = {}
    for r in tokencounts.count(table(spark, rows), path, pattern).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        own, text = sorted(got[i], key=lambda r: r.section), t or ""
        assert own[0].start == 0 and own[-1].end == len(text) and all(a.end == b.start for a, b in zip(own, own[1:]))
        tokens = encoder.encode_ordinary(text)
        assert sum(r.n_tokens for r in own) == len(tokens) == own[0].doc_tokens
        # token by token: the section with most bytes, the first of equal ones
        want, at = [0] * len(own), 0
        bounds = [(len(text[: r.start].encode()), len(text[: r.end].encode())) for r in own]
        for k in tokens:
            a, b = at, at + int(sizes[k])
            inside = [max(0, min(b, z) - max(a, y)) for y, z in bounds]
            want[inside.index(max(inside))] += 1
            at = b
        assert [r.n_tokens for r in own] == want
        assert all(r.kind == ("table" if "|" in text[r.start : r.end] else "text" if text[r.start : r.end].strip() else "blank") for r in own)
    assert tokencounts.count(table(spark, []), path, pattern).count() == 0


def test_attribution_of_long_tokens():
    n, crossing = tokencounts.attribute(np.array([5, 1, 6]), np.array([2, 3, 1, 3, 3]))
    assert n.tolist() == [0, 1, 1, 1, 0] and crossing.tolist() == [1, 0, 0, 1, 0]


def test_lines_end_at_line_feeds_and_carriage_returns_only():
    assert tokencounts.lines("a\x0bb c\x1c\u2028d") == (["text"], [8])
    assert tokencounts.lines("a\x0bb c\r") == (["text"], [6])
    assert tokencounts.lines("a\r\nb|\rc\n\n") == (["text", "table", "text", "blank"], [3, 3, 2, 1])
    assert tokencounts.lines("\n") == (["blank"], [1]) and tokencounts.lines("") == (["blank"], [0])
    for x in texts(400, 9):
        names, sizes = tokencounts.lines(x.replace("z", "\r"))
        assert sum(sizes) == len(x) and len(names) == len(sizes)


def test_long_runs_of_blanks_are_encoded_as_short_ones(monkeypatch):
    encoder, sizes = tokencounts.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for big in ("a" + " " * 3_000_000 + "b", "\n" * 1_200_000, "x" * 500_000, " \t" * 700_000):
        assert sizes[tokencounts.encode(encoder, big)].sum() == len(big)
    monkeypatch.setattr(tokencounts, "LONG_RUN", 5)
    monkeypatch.setattr(tokencounts, "RUN", tokencounts.re.compile(tokencounts.SPACE + "{5,}"))
    rng = random.Random(3)
    for _ in range(5000):
        x = "".join(rng.choices(["a", "b1", " ", "     ", "\n", "\t", "\r", "é", ".", "'s", "\x85", "\x1c", "\u3000", " " * 7], k=rng.randint(0, 14)))
        assert list(tokencounts.encode(encoder, x)) == encoder.encode_ordinary(x), repr(x)
