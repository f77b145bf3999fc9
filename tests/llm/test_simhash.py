from itertools import combinations

import numpy as np
import xxhash

from tidegauge.llm import simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints):
    near = {i: {j for j in range(len(ids)) if bin(prints[i] ^ prints[j]).count("1") <= 4} for i in range(len(ids))}
    out = {}
    for i in range(len(ids)):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        out[ids[i]] = min(ids[j] for j in seen)
    return out


def test_every_word_within_two_bits_shares_a_key():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 300)
    for w in (0, 1, 2):
        for at in combinations(range(23), w):
            e = sum(1 << k for k in at)
            (a, na), (b, nb) = simhash.segment_keys(words), simhash.segment_keys(words ^ e)
            for i in range(0, 300, 7):
                assert set(a[i, : na[i]]) & set(b[i, : nb[i]])


def test_pairs_within_four_bits_share_a_pair_of_keys():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2)
    flips = np.zeros(2000, np.uint64)
    for _ in range(4):
        flips |= np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64)
    (ka, oa), (kb, ob) = simhash.pair_keys(x), simhash.pair_keys(x ^ flips)
    a, b = set(zip(ka.tolist(), oa.tolist())), set(zip(kb.tolist(), ob.tolist()))
    assert {o for _, o in a & b} == set(range(2000))


def test_fingerprint_is_the_brute_one():
    for text in (None, "", " \t\n", "One", "a b c", "A b c D", "a b c d e f A B C D é Ü ß\x0bx\x1cy", "x " * 500, "w%d " * 40 % tuple(range(40))):
        assert simhash.fingerprint(text) == brute_print(text)


def test_components_match_brute_force(spark):
    rng = np.random.default_rng(3)
    base = " ".join(f"w{k}" for k in rng.integers(0, 10**6, 400))
    texts = [base]
    for k in range(30):
        words = base.split()
        for at in rng.integers(0, 400, k % 4 + 1):
            words[at] = f"z{at}"
        texts.append(" ".join(words))
    texts += [base, base, None, "", "  ", "one two", "ONE two", "one two three four five"]
    texts += [" ".join(f"u{x}" for x in rng.integers(0, 10**6, 50)) for _ in range(20)]
    rows = [(100 - i, t, 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, print int, key string")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [brute_print(t) for t in texts]
    ids = [r[0] for r in rows]
    assert {i: got[i].fingerprint for i in ids} == {i: f"{p:016x}" for i, p in zip(ids, prints)}
    want = brute_components(ids, prints)
    assert {i: got[i].component_id for i in ids} == want
    kept = {r.doc_id for r in simhash.drop_near_copies(docs).collect()}
    assert kept == {i for i in ids if want[i] == i}


def test_large_buckets_connect_what_small_ones_do():
    rng = np.random.default_rng(4)
    center = int(rng.integers(0, 1 << 62))
    prints = np.array(sorted({center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (200, 2))} | {0, 1, 3}), np.uint64)
    forest = simhash.Forest()
    simhash.link_runs(np.zeros(len(prints), np.int32), prints[:, None], 4, forest)
    want = brute_components(prints.tolist(), prints.tolist())
    assert {p: forest.root(p) for p in prints.tolist()} == want


def test_empty_table_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (2, "a b")], schema)
    assert sorted(str(r.component_id) for r in simhash.near_duplicates(docs).collect()) == ["1"] * 4
    assert sorted(str(r.doc_id) for r in simhash.drop_near_copies(docs).collect()) == ["1", "1", "None"]


def test_more_blocks_find_most_copies_of_similarity_09(spark):
    rng = np.random.default_rng(5)
    rows, pairs = [], []
    for k in range(60):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 300)]
        other = list(words)
        for at in range(0, 300, 100):  # every change costs five of the shingles: a similarity of about 0.9
            other[at + int(rng.integers(0, 90))] = f"z{k}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, 5, 19, blocks=2).collect()}
    assert all(got[i] in (i, i - 1) for i in got) and all(got[2 * k] == 2 * k for k in range(60))
    assert sum(got[2 * k + 1] == 2 * k for k in range(60)) > 50
