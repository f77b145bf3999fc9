"""Language-model scores, language identification, quality and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidegauge.llm import common, langid, lmscore, quality


def corpus(n, seed=1):
    """Texts in which every word has a few likely successors."""
    rng = np.random.default_rng(seed)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), int(k))) for k in rng.integers(1, 7, 400)]
    after = rng.integers(0, 400, (400, 4))
    texts = []
    for _ in range(n):
        k, words = int(rng.integers(0, 400)), []
        for _ in range(int(rng.integers(0, 60))):
            words.append(vocabulary[k])
            k = int(rng.choice(after[k])) if rng.random() < 0.9 else int(rng.integers(0, 400))
        texts.append(" ".join(words))
    return texts


def test_base_scores_are_exact_and_the_model_is_close(spark):
    rows = [(k, t, 0) for k, t in enumerate(corpus(300))] + [(900, None, 0), (901, "", 0), (902, "Abc ABC\x0babc\x1cabc", 0), (903, "zz " * 4000, 0), (2, "twice", 0), (None, "no id", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    trained = common.crc_mod(F.col("doc_id"), 7) != 2
    got = lmscore.score(docs, trained).collect()
    is_trained = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2
    tokens = lambda t: (t or "").encode().lower().split() + ["end"]
    c = Counter(w for i, t, _ in rows if is_trained(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), not is_trained(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    held = [r for r in got if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)
    assert lmscore.score(docs.limit(0), trained).count() == 0


def test_words_are_read_in_blocks_as_in_plain_python():
    texts = ["a b", None, "", "Abc ABC\x0babc\x1cabc  ", "x" * 2_500_000 + " y " + "z" * 10, " ", "é ü q", "w1 W1 " * 300_000, "\u2003a\u00a0b c\td"]
    got, ids = [[] for _ in texts], {}
    for doc, h in lmscore.words(pa.array(texts)):
        for k, x in zip(doc.tolist(), h.tolist(), strict=True):
            got[k].append(x)
    for text, own in zip(texts, got, strict=True):
        plain = (text or "").encode().lower().split()
        assert len(own) == len(plain)
        assert all(ids.setdefault(w, h) == h for w, h in zip(plain, own, strict=True))
    assert len(set(ids.values())) == len(ids)
    sliced = pa.array(["q", "a b", None, "c"]).slice(1, 2)
    assert [(d.tolist(), len(h)) for d, h in lmscore.words(sliced)] == [([0, 0], 2)]
    steps = [(d, v, w) for x in lmscore.steps(pa.array(["a b", "", None])) for d, v, w in zip(*(c.tolist() for c in x), strict=True)]
    x, y, end = lmscore.hash_of("a"), lmscore.hash_of("b"), int(lmscore.END)
    assert sorted(steps) == sorted([(0, end, x), (0, x, y), (0, y, end), (1, end, end), (2, end, end)])


def test_the_filter_gives_levels_back():
    rng = np.random.default_rng(0)
    grams = rng.integers(0, 2**40, 20000).astype(np.uint64)
    n = rng.integers(1, 100000, 20000)
    f = lmscore.Filter.of(grams, n)
    found, true = f.levels(grams), lmscore.level_of(n)
    assert (found >= true).all() and (found == true).mean() > 0.99
    assert (f.levels(rng.integers(2**40, 2**41, 20000).astype(np.uint64)) > 0).mean() < 0.02
    assert (lmscore.LOW[true] <= n).all() and (n / lmscore.LOW[true]).max() < 1.5
    assert lmscore.LOW[lmscore.level_of(np.array([1, 2, 3, 4]))].tolist() == [1, 2, 3, 4]
    assert lmscore.Filter.of(grams[:0], n[:0]).levels(grams).max() == 0


def test_counts_over_a_byte_and_packing():
    own, n = lmscore._bytes_of_counts(np.array([5, 6, 7, 8], np.uint64), np.array([1, 255, 256, 1000]))
    back = lmscore._tally([own], [n])
    assert back[0].tolist() == [5, 6, 7, 8] and back[1].tolist() == [1, 255, 256, 1000]
    x = np.array([0, 1, 2**40 - 1], np.uint64)
    assert lmscore._unpack(lmscore._pack(x, 5), 5).tolist() == x.tolist()


def test_most_frequent_words_are_whole_levels(spark):
    words = spark.createDataFrame([(k, 1 + k // 3) for k in range(300)], "word long, n long")
    got = lmscore.most_frequent(words, 50)
    assert 30 < len(got) <= 50 and min(got.values()) > max(1 + k // 3 for k in range(300) if k not in got)
    assert len(lmscore.most_frequent(words, 1000)) == 300 and lmscore.most_frequent(words.limit(0)) == {}


def test_scores_are_those_of_a_distribution(spark):
    """With counts up to 4 nothing is lost in quantising: p sums to 1 over known words, the end and the unknown word."""
    training = ["a b c", "a b", "a c", "b a b", "d"] + ["e a"] * 3
    seq = lambda t: ["$", *t.split(), "$"]
    c = Counter(w for t in training for w in seq(t)[1:])
    c2 = Counter(x for t in training for x in zip(seq(t)[:-1], seq(t)[1:], strict=True))
    once, n = sum(x == 1 for x in c.values()), sum(c.values())
    low = lambda x: float(lmscore.LOW[lmscore.level_of(np.array([x]))[0]]) if x else 0.0
    p = lambda w, v: (low(c2[v, w]) + 20 * (c[w] or max(once, 1e-9)) / (n + once)) / (c[v] + 20)
    for v in [*c, "unknown"]:
        total = sum(p(w, v) for w in c) + p("unknown", v)
        assert abs(total - 1) < 1e-9 if v not in ("$",) else total <= 1 + 1e-9
    held = ["a b", "b a c d", "x a", "", "e e e", "a x x b"]
    docs = spark.createDataFrame(list(enumerate(training)) + [(100 + k, t) for k, t in enumerate(held)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in lmscore.score(docs, F.col("doc_id") < 100).collect()}
    for k, t in [*enumerate(training), *[(100 + k, t) for k, t in enumerate(held)]]:
        want = sum(math.log10(p(w, v)) for v, w in zip(seq(t)[:-1], seq(t)[1:], strict=True))
        assert abs(got[k] - want) < 1e-4, (t, got[k], want)


def test_pairs_of_rare_words_count_as_pairs(spark):
    """Words beyond the classes, and beyond the head, against a model of exact pairs."""
    common_, mid = [f"c{k}" for k in range(2500)], [f"m{k}" for k in range(40)]
    rare = [f"r{k}" for k in range(70000)]  # of one count, and too many for the head
    texts = [" ".join(rare[k : k + 1000]) for k in range(0, 70000, 1000)] * 2 + [" ".join(common_)] * 12
    texts += [" ".join(x for k in range(j, 70000, 4000) for x in (rare[k], mid[k % 40])) for j in range(20)]
    rows = list(enumerate(texts))
    held = [" ".join(rare[7:60]), " ".join(rare[7:60:2]), " ".join(common_[2100:2200]), " ".join(common_[2100:2200][::-1]), "zz " + rare[0] + " " + mid[0] + " zz zz zz", f"{rare[4]} {mid[4]} {rare[5]} c1 {rare[9]}", ""]
    rows += [(10_000 + k, t) for k, t in enumerate(held)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id - 10_000: r.score for r in lmscore.score(docs, F.col("doc_id") < 10_000).collect() if r.doc_id >= 10_000}
    seq = lambda t: ["$", *t.split(), "$"]
    c, c2 = Counter(w for t in texts for w in seq(t)[1:]), Counter(x for t in texts for x in zip(seq(t)[:-1], seq(t)[1:], strict=True))
    once = sum(x == 1 for x in c.values())
    total = sum(c.values()) + once
    for k, t in enumerate(held):
        s = seq(t)
        want = sum(math.log10((c2[v, w] + 20 * (c[w] or max(once, 1e-9)) / total) / (c[v] + 20)) for v, w in zip(s[:-1], s[1:], strict=True))
        assert abs(got[k] - want) <= 0.18 * (len(s) - 1), (k, got[k], want)
    assert got[0] / 54 > got[1] / 28 + 1 and got[2] > got[3] + 50


def test_repeated_rows_long_and_clashing_texts(spark):
    text = "p q r " * 200_000
    docs = spark.createDataFrame([(1, text, 0.0), (1, text, 1.0), (None, text, None), (3, None, None)], "doc_id long, text string, score double")
    got = lmscore.score(docs, F.col("doc_id") == 1).collect()
    own = [r for r in got if r.n_tokens > 1]
    assert len(got) == 4 and {r.n_tokens for r in own} == {600_001} and len({round(r.score, 3) for r in own}) == 1
    assert {r.train_tokens for r in got} == {1_200_002}


def test_languages(spark):
    rng = np.random.default_rng(2)
    sounds = {"xx": ["ka", "to", "mi", "ra"], "yy": ["sch", "en", "ung", "ver"], "zz": ["eau", "tion", "que", "ment"]}
    rows = []
    for k in range(240):
        lang = ("xx", "yy", "zz")[k % 3]
        words = ["".join(rng.choice(sounds[lang], int(rng.integers(1, 4)))) for _ in range(int(rng.integers(3, 40)))]
        rows.append((k, " ".join(words), lang, 0.0))
    rows += [(900, None, "xx", 0.0), (901, "123 !", "xx", 0.0), (902, "", None, 0.0), (903, "schenung " * 3000, None, 0.0), (903, "tion", "zz", 0.0), (None, "que eau", "zz", 0.0), (904, "日本語", "xx", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    learn = common.crc_mod(F.col("doc_id"), 4) != 2
    got = langid.predict(docs, learn, sample=60).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    held = [(r[2], by[r[0]]) for r in rows[:240] if by[r[0]].held_out]
    assert len(held) > 30 and np.mean([a == b.lang_pred for a, b in held]) > 0.95
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (900, 901, 902))
    assert all(0 <= r.score <= 1 for r in got) and by[904].rejected and not np.mean([b.rejected for _, b in held]) > 0.1
    none = langid.predict(docs.withColumn("lang", F.lit(None).cast("string")), learn).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert langid.predict(docs.limit(0), learn).count() == 0


class SlowKneserNey:
    """Interpolated Kneser-Ney over the characters of words, from dictionaries of strings."""

    def __init__(self, words, alphabet, order=langid.ORDER):
        counts = [Counter() for _ in range(order)]
        for w, m in words.items():
            s = f"\x01{w}\x01"
            for i in range(1, len(s)):
                for k in range(min(i + 1, order)):
                    counts[k][s[i - k : i + 1]] += m
        self.alphabet, self.n, self.d = alphabet, [], []
        for k in range(order):
            before = Counter(g[1:] for g in counts[k + 1]) if k + 1 < order else {}
            n = {g: before.get(g) or c for g, c in counts[k].items()}
            ones, twos = (sum(x == j for x in n.values()) for j in (1, 2))
            self.n.append(n)
            self.d.append(ones / (ones + 2 * twos) if ones and twos else 0.5)

    def p(self, context, c):
        p = 1 / self.alphabet
        for k in range(min(len(context) + 1, len(self.n))):
            h = context[len(context) - k :]
            after = {g: n for g, n in self.n[k].items() if g[:-1] == h}
            if total := sum(after.values()):
                p = max(after.get(h + c, 0) - self.d[k], 0) / total * (h + c in after) + self.d[k] * len(after) / total * p
        return p

    def log2(self, word):
        s = f"\x01{word}\x01"
        return sum(math.log2(self.p(s[:i], s[i])) for i in range(1, len(s)))


def test_kneser_ney_is_that_of_plain_dictionaries_and_a_distribution():
    own = [{"aba": 3, "ab": 2, "abba": 1, "cab": 4, "bac": 1}, {"zz": 2, "zab": 1, "abc": 5}]
    alphabet = len({c for x in own for w in x for c in w}) + 2
    languages = [langid.Language(list(x), np.array([float(n) for n in x.values()])) for x in own]
    model, slow = langid.Model(["x", "y"], languages, alphabet), [SlowKneserNey(x, alphabet) for x in own]
    words = ["aba", "a", "cabab", "zz", "q", "abcabcabc", "bacc", "zabz"]
    for w, got in zip(words, model.log2(words), strict=True):
        assert np.allclose(got, [x.log2(w) for x in slow], atol=1e-3), w
    for x in slow:
        for context in ("\x01", "\x01a", "\x01ab", "\x01abba", "\x01zq", "\x01cabab"):
            assert abs(sum(x.p(context, c) for c in "abcz\x01?") - 1) < 1e-9, context


def test_equal_languages_go_to_the_first_name(spark):
    rows = [(k, f"same words here {'abcd'[k % 4]}", ("yy", "xx")[k % 2], "z") for k in range(0, 200)]
    rows = [(2 * k + j, f"same words number {'abcdefgh'[k % 8]}", lang, "z") for k in range(100) for j, lang in enumerate(("yy", "xx"))]
    docs = spark.createDataFrame(rows + [(1000, "same words", None, "z")], "doc_id long, text string, lang string, lang_pred string")
    got = langid.predict(docs, F.col("doc_id") < 200, sample=1000).filter("doc_id = 1000").collect()
    assert got[0].lang_pred in ("xx", "yy") and abs(got[0].score - 0.5) < 0.1
    long = spark.createDataFrame([(1, "wort " * 300_000, "xx"), (2, "mot " * 300_000, "yy"), (3, "wort", None)], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in langid.predict(long, F.col("doc_id") < 3).collect()} == {1: "xx", 2: "yy", 3: "xx"}


def test_quality(spark):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for k in range(400):
        words = ["".join(rng.choice(list("aeinorst"), int(rng.integers(2, 9)))) for _ in range(80)]
        bad = k % 5 == 0
        if bad:
            words[20:60] = [words[20]] * 40
        rows.append((k, " ".join(words), f"s{k % 7}", "en", 0.0, "x"))
        if k % 2 == 0:
            labels.append((k, int(not bad)))
    rows += [(900, None, "s1", "en", 0.0, "x"), (901, "  ", None, None, 0.0, "x"), (902, "fine words here", None, None, 0.0, "x"), (None, "fine", "s1", "en", 0.0, "x"), (None, "", "s1", "en", 0.0, "x"), (3, rows[3][1], "s3", "en", 0.0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, keep double, host string")
    known = spark.createDataFrame(labels + [(5000, 1), (None, 0)], "doc_id long, quality int")
    host, path = F.col("source"), F.concat_ws("/", "source", "lang")
    got = quality.classify(docs, known, host, path).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    right = [by[k].keep == (k % 5 > 0) for k in range(400) if k % 2]
    assert np.mean(right) > 0.98
    assert not by[900].keep and not by[901].keep
    kept = quality.reject(docs, known, host, path)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 2 and ids.count(None) == 1 and 900 not in ids
    assert quality.classify(docs.limit(0), known, host, path).count() == 0
    free = quality.classify(docs, known.limit(0), host, path).collect()
    assert all(r.keep == (r.doc_id not in (900, 901)) for r in free if r.doc_id is not None)


def test_site_rates_and_posteriors_by_brute_force(spark):
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for k in range(500):
        words = ["".join(rng.choice(list("aeinorst"), int(rng.integers(2, 9)))) for _ in range(int(rng.integers(5, 60)))]
        host = None if k % 11 == 0 else f"h{int(rng.zipf(1.6)) % 9}"
        bad = rng.random() < (0.7 if host == "h1" else 0.2)
        if bad:
            words = words[:3] * 12
        rows.append((k, " ".join(words) if k % 29 else "  ", host, None if k % 7 == 0 else f"p{k % 3}"))
        if k % 3:
            labels.append((k, int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.classify(docs, known, F.col("host"), F.col("path")).collect()}
    own = [(k, host, path, got[k].evidence) for k, text, host, path in rows if text.split()]
    said = dict(labels)
    base = np.mean([said[k] for k, *_ in own if k in said])
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    logit = lambda p: math.log(p / (1 - p))
    p = {k: sigmoid(e + logit(base)) for k, _, _, e in own}

    def strength(groups):
        """(sum, n, parent's rate) of each group: the parent's worth in documents by moments."""
        n = sum(g[1] for g in groups)
        each = sum(m * q * (1 - q) for _, m, q in groups) / n
        spread = (sum(m * (s / m - q) ** 2 for s, m, q in groups) - len(groups) * each) / n
        return min(max(each / spread - 1, 1.0), quality.STRONGEST) if spread > 0 else quality.STRONGEST

    rate = np.mean(list(p.values()))
    sums = lambda key: {g: (sum(p[x[0]] for x in own if key(x) == g), sum(key(x) == g for x in own)) for g in {key(x) for x in own}}
    hosts, paths = sums(lambda x: x[1]), sums(lambda x: (x[1], x[2]))
    k_host = strength([(s, n, rate) for s, n in hosts.values()])
    host_rate = {h: (s + k_host * rate) / (n + k_host) for h, (s, n) in hosts.items()}
    k_path = strength([(s, n, host_rate[g[0]]) for g, (s, n) in paths.items()])
    path_rate = {g: (s + k_path * host_rate[g[0]]) / (n + k_path) for g, (s, n) in paths.items()}
    for k, host, path, e in own:
        want = sigmoid(e + logit(path_rate[host, path]))
        assert np.allclose([got[k].host_rate, got[k].path_rate, got[k].posterior], [host_rate[host], path_rate[host, path], want], atol=1e-9)
        assert got[k].keep == (want >= 0.5)
    # the evidence is that of a regression fitted to the labelled rows
    x = np.array([quality.features(t) for k, t, _, _ in rows if k in said and t.split()])
    y = np.array([said[k] for k, t, _, _ in rows if k in said and t.split()], float)
    mean, spread, w = quality.fit(x, y)
    for k, text, _, _ in rows[:60]:
        if text.split():
            z = quality._expand(np.clip((np.array([quality.features(text)]) - mean) / spread, -5, 5))
            assert abs(float((z @ w)[0]) - logit(base) - got[k].evidence) < 1e-6
    twice = quality.classify(docs.union(docs), known, F.col("host"), F.col("path"))
    assert twice.count() == 1000
    big = spark.createDataFrame([(1, "word " * 400_000, "h", "p"), (2, "other words", "h", "p")], docs.schema)
    assert quality.classify(big, known, F.col("host"), F.col("path")).count() == 2


def test_sparse_sites_stay_near_their_parent(spark):
    groups = spark.createDataFrame([("a", 90.0, 100), ("b", 10.0, 100), ("c", 0.0, 1)], "host string, s double, n long")
    k = quality._strength(groups, F.lit(0.5))
    assert 1 <= k < 10
    same = spark.createDataFrame([(str(i), 50.0, 100) for i in range(20)], "host string, s double, n long")
    assert quality._strength(same, F.lit(0.5)) == quality.STRONGEST


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(4)
    text = lambda: " ".join("".join(rng.choice(list("aeinorst"), int(rng.integers(2, 9)))) for _ in range(60))
    rows = [(k, text(), "en", f"s{k % 3}", 0) for k in range(60)]
    rows += [(100, rows[0][1], "en", "s1", 0), (101, rows[1][1] + "  ", "en", "s1", 0), (102, "write to joe@site.org or " + text(), "en", "s1", 0), (103, None, "en", "s1", 0)]
    rows += [(200 + k, f"bad{k} " * 60, "en", "s2", 0) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("n_chars", F.length("text").cast("long"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, 0) for k in range(30)] + [(200 + k, 0, 0) for k in range(10)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = common.documents(spark, str(tmp_path))
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = common.saved(stage(spark, docs, str(tmp_path)), name)
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "packing":
            assert docs.columns == df.columns
    good, exact, near, private, packed = seen
    assert good == {*range(60), 100, 101, 102}
    assert exact == good - {100, 1}
    assert near == private == packed == exact


def test_pipeline_with_odd_tables(spark, tmp_path):
    """Null and repeated ids, columns named as the operators' own, and an empty table pass through every stage."""
    import corpus_pipeline

    rng = np.random.default_rng(5)
    text = lambda: " ".join("".join(rng.choice(list("aeinorst"), int(rng.integers(2, 9)))) for _ in range(40))
    rows = [(k, text(), "en", f"s{k % 3}") for k in range(30)]
    rows += [(None, text(), None, None), (None, text(), "en", None), (7, text(), "en", "s1"), (None, None, None, None), (40, "", "en", "s1"), (41, "call 555-0123 " * 20_000, "en", "s2")]
    clash = ["row", "id", "digest", "norm", "print", "hashes", "root", "spans", "_hit", "_page", "keep", "host", "path", "length", "piece", "_share"]
    df = spark.createDataFrame([(*r, len(r[1] or ""), *[f"x{j}" for j in range(len(clash))]) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clash))
    for name, own in (("some", df), ("none", df.limit(0))):
        folder = tmp_path / name
        own.write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(0, 30, 2)], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        docs, n = common.documents(spark, str(folder)), []
        for stage, f in corpus_pipeline.STAGES:
            docs = common.saved(f(spark, docs, str(folder)), stage)
            n.append(docs.count())
            if stage != "packing":
                assert docs.columns == df.columns
        if name == "none":
            assert n == [0] * 5
        else:
            assert n[0] >= n[1] >= n[2] == n[3] <= n[4] and n[3] > 10
            placed = docs.collect()
            assert sum(r.doc_id is None for r in placed) >= 1 and all(1 <= r.length <= 4096 for r in placed)
            ends = {}
            for r in sorted(placed, key=lambda r: (r.sequence_id, r.offset)):
                assert r.offset == ends.get(r.sequence_id, 0)
                ends[r.sequence_id] = r.offset + r.length
            assert max(ends.values()) <= 4096
