import numpy as np
import pytest

import corpus_pipeline
from tidegauge.llm import simhash


def similarity(a, b):
    a, b = ({tuple(t.split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))} for t in (a, b))
    return len(a & b) / len(a | b)


def test_the_stage_joins_all_copies_of_similarity_08_and_no_others(spark):
    """Pairs just above 0.8 go, pairs just below stay."""
    rng = np.random.default_rng(6)
    rows, same = [], []
    for k in range(120):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 304)]
        other = list(words)
        n = 6 if k % 2 else 7 + k % 7  # six changes of five shingles each: 270 of 330 are shared, 0.818; from seven on it is 0.79 at most
        for at in range(n):
            other[20 + 22 * at] = f"z{k}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        same.append(similarity(rows[-1][1], rows[-2][1]) >= 0.8)
    rows += [(1000, None), (1001, "  "), (1002, "A b c"), (1003, "a  B c"), (None, "a b c"), (1005, "one two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r.doc_id for r in corpus_pipeline.without_near_copies(spark, docs, "").collect()]
    assert {i for i in kept if i is not None and i < 1000} == set(range(0, 240, 2)) | {2 * k + 1 for k in range(120) if not same[k]}
    assert sum(same) == 60 and sorted(str(i) for i in kept if i is None or i >= 1000) == ["1000", "1002", "1005", "None"]
    assert corpus_pipeline.without_near_copies(spark, docs.limit(0), "").count() == 0


def test_links_go_on_over_members_that_are_no_neighbours():
    sets = [np.arange(k, k + 100, dtype=np.uint64) for k in (20, 0, 10, 30, 500)]  # 0.82 in steps of 10, 0.67 in steps of 20
    assert sorted(sorted(x) for x in simhash.link_sets(sets, 0.8)) == [[0, 2], [0, 3], [1, 2]]


@pytest.mark.parametrize("many", [256, 4])
def test_copies_between_chunks_of_a_large_component_are_found(spark, monkeypatch, many):
    """A chain in which only neighbours are copies, over more bytes than one task compares, with and without a pivot."""
    monkeypatch.setattr(simhash, "CHUNK", 20_000)
    monkeypatch.setattr(simhash, "MANY", many)
    rng = np.random.default_rng(7)
    words = [f"w{x}" for x in rng.integers(0, 10**6, 1600)]
    rows = [(k, " ".join(words[30 * k : 30 * k + 400])) for k in range(40)]  # 366 of 426 shingles are shared with the next: 0.86
    rows += [(100 + k, " ".join(f"q{x}" for x in rng.integers(0, 10**6, 80))) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_copies(docs, 5, 0.8).collect()}
    assert got == {k: 0 if k < 40 else k for k, _ in rows}
    apart = spark.createDataFrame([r for r in rows if r[0] % 2 == 0], docs.schema)  # 332 of 460: 0.72
    assert all(r.doc_id == r.component_id for r in simhash.near_copies(apart, 5, 0.8).collect())


def test_a_pivot_settles_a_group_of_copies_and_loses_no_link(spark, monkeypatch):
    """Random families of sets in one loose component: links and what is left give the components of all pairs."""
    monkeypatch.setattr(simhash, "MANY", 3)
    rng = np.random.default_rng(9)
    for family in range(6):
        base = np.unique(rng.integers(1, 1 << 60, 120))
        sets = []
        for _ in range(24):
            own = base.copy()
            at = rng.random(len(own)) < rng.choice([0.02, 0.08, 0.2])
            own[at] = rng.integers(1, 1 << 60, int(at.sum()))
            sets.append(np.unique(own).astype(np.uint64))
        names = [simhash.digest_of(x) for x in sets]
        df = spark.createDataFrame([(f"r{family}", n, bytearray(x.tobytes())) for n, x in zip(names, sets)], "root string, digest string, hashes binary")
        links, rest = simhash.against_pivots(df, 0.8)
        found = [(r.a, r.b) for r in links.collect()]
        left = {r.digest: np.frombuffer(bytes(r.hashes), np.uint64) for r in rest.collect()}
        order = list(left)
        found += [(order[i], order[j]) for i, j in simhash.link_sets([left[n] for n in order], 0.8)]

        def parts(pairs, names=names):
            up = {n: n for n in names}

            def root(x):
                while up[x] != x:
                    x = up[x]
                return x

            for a, b in pairs:
                up[max(root(a), root(b))] = min(root(a), root(b))
            return {n: root(n) for n in names}

        every = [(names[i], names[j]) for i in range(24) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))]
        assert parts(found) == parts(every) and set(found) <= set(every) | {(b, a) for a, b in every}
