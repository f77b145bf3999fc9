"""Boundary rows of the flag rules, scalar functions and audits, by hand."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.functions import flags as R
from tidegauge.functions import scalars as S
from tidegauge.operators import annotate, asof, audit, checks, features, kernels, quality, runs, stats, timewin
from tidegauge.sources import media

SEC = 1_000_000


def flagged(spark, schema, rows, rules):
    df = spark.createDataFrame(rows, schema)
    return [(r.quality_flag, r.problem_flag) for r in df.select(*R.flags(rules)).collect()]


def test_lattice(spark):
    c = F.col
    rows = [(61 / 64,), (60 / 64,), (51 / 64,)]
    assert flagged(spark, "x double", rows, R.at_least(c("x"), 0.95, 0.8)) == [("GOOD", "NONE"), ("NOISY", "ARTIFACT"), ("BAD", "ARTIFACT")]
    assert flagged(spark, "n int", [(1,), (2,), (3,), (None,)], R.at_most(c("n"), 1, 2, "CLIPPING", "CLIPPING")) == [("GOOD", "NONE"), ("NOISY", "CLIPPING"), ("BAD", "CLIPPING"), ("GOOD", "NONE")]
    both = R.acc(F.lit(1.0), F.lit(0.0), c("n"), F.lit(True))
    assert flagged(spark, "n int", [(2,)], both) == [("BAD", "FLAT")]
    gaps = R.ibi(c("n"), F.lit(0.0), c("g"))
    assert flagged(spark, "n int, g double", [(8, 2.0), (7, 2.0), (5, 4.0), (4, 4.1), (8, 4.1)], gaps) == [("GOOD", "NONE"), ("NOISY", "ARTIFACT"), ("NOISY", "ARTIFACT"), ("BAD", "ARTIFACT"), ("BAD", "ARTIFACT")]
    warm = R.temp(F.lit(1.0), F.lit(0.0), c("m"), F.lit(1.0), F.lit(0.0))
    assert flagged(spark, "m double", [(24.9,), (25.0,), (28.0,), (None,)], warm) == [("GOOD", "NONE"), ("NOISY", "NONE"), ("GOOD", "NONE"), ("GOOD", "NONE")]
    pulse = R.hr(F.lit(1.0), c("m"), F.lit(1.0), F.lit(0.0))
    assert flagged(spark, "m double", [(40.0,), (39.0,), (221.0,)], pulse) == [("GOOD", "NONE"), ("NOISY", "NONE"), ("BAD", "ARTIFACT")]


def test_windows(spark):
    df = spark.createDataFrame([(0,), (SEC,), (1_999_000,), (2_100_000,)], "t long")
    assert sorted(r.window_id for r in timewin.tumbling(df, F.col("t"), SEC, 2).collect()) == [0, 1, 1]
    rng = np.random.default_rng(1)
    times = [int(x) for x in rng.integers(-5 * SEC, 12 * SEC, 400)] + [0, 3 * SEC, 5 * SEC]
    df = spark.createDataFrame([(t,) for t in times], "t long")
    got = sorted((r.t, r.window_id) for r in timewin.lookback(df, F.col("t"), SEC, 3 * SEC, 8).collect())
    assert got == sorted((t, k) for t in times for k in range(8) if (k + 1) * SEC - 3 * SEC <= t < (k + 1) * SEC)
    got = sorted((r.t, r.window_id) for r in timewin.lookback(df, F.col("t"), SEC, 3 * SEC, 8, whole_only=True).collect())
    assert got == sorted((t, k) for t in times for k in range(2, 8) if (k + 1) * SEC - 3 * SEC <= t < (k + 1) * SEC)
    got = sorted((r.t, r.window_id) for r in timewin.forward(df, F.col("t"), SEC, 3 * SEC, 8).collect())
    assert got == sorted((t, k + 1) for t in times for k in range(8) if k * SEC <= t < k * SEC + 3 * SEC)


def test_ids(spark):
    df = spark.createDataFrame([(x,) for x in ("p3", "p1_p2", "P4", "7", "e07", "pX", "p1_x", None)], "id string")
    got = {r.id: r.ids for r in df.select("id", S.resolve_id(F.col("id")).alias("ids")).collect()}
    assert got["p3"] == ["e03"] and got["p1_p2"] == ["e01", "e02"] and got["P4"] == ["e04"] and got["7"] == ["e07"]
    assert not got["e07"] and not got["pX"] and not got["p1_x"]
    assert [r.f for r in df.filter("id = 'e07'").select(S.id_format(F.col("id")).alias("f")).collect()] == ["canonical"]
    path = spark.createDataFrame([("raw/entity=p3/modality=eeg/x_1.csv",)], "p string").select(S.rewritten_path(F.col("p"), "raw/", "clean/", F.lit("e03")).alias("a"), S.path_part(F.col("p"), "modality").alias("b"), S.file_stem(F.col("p")).alias("c")).first()
    assert tuple(path) == ("clean/entity=e03/modality=eeg/x_1.csv", "eeg", "x_1")


def test_status_and_agreement(spark):
    df = spark.createDataFrame([(0, 0), (98, 0), (99, 0), (100, 0), (100, 1)], "n int, z int")
    got = [r[0] for r in df.select(S.status(F.col("n"), F.lit(100), F.col("z"))).collect()]
    assert got == ["total_missing", "partial_missing", "complete", "complete", "partial_missing"]
    df = spark.createDataFrame([(1, 3, 5), (1, 2, 5), (3, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(S.raters_agree(F.col("a"), F.col("b"), F.col("c"))).collect()] == [False, True, False]
    df = spark.createDataFrame([(0.0, 0.0), (None, 1.0), (-1.0, 0.0), (1.0, -1.0), (-1.0, -1.0)], "v double, a double")
    assert [r[0] for r in df.select(S.quadrant(F.col("v"), F.col("a"))).collect()] == ["Happiness", None, "Anger", "Calm", "Sadness"]
    df = spark.createDataFrame([(0.0,), (None,), (2.0,), (9.0,)], "s double")
    assert [r[0] for r in df.select(S.aligned(F.col("s"), F.lit(1), F.lit(5))).collect()] == [False, True, True, False]
    df = spark.createDataFrame([(2, 0, 3), (1, 0, 2), (1, 1, 3), (0, 0, 0)], "b int, m int, n int")
    assert [r[0] for r in df.select(R.majority(F.col("b"), F.col("m"), F.col("n"))).collect()] == ["BAD", "GOOD", "NOISY", None]


def test_dominant_emotion(spark):
    names = ["cheerful", "happy", "angry", "nervous", "sad"]
    cases = {
        (0, 0, 0, 0, 0): "Neutral, Calm, Happiness, Anger, Sadness",
        (3, 3, 3, 9, 3): "Sadness",
        (3, 3, 9, 9, 3): "Anger, Sadness",
        (3, 6, 3, 3, 3): "Calm, Happiness",
        (3, 7, 3, 3, 3): "Happiness",
        (3, 3, 3, 3, 6): "Calm, Sadness",
        (6, 3, 3, 3, 3): "Happiness",
        (4, 3, 3, 3, 3): "Neutral, Happiness",
        (3, 3, 4, 3, 3): "Neutral, Anger",
    }
    df = spark.createDataFrame([tuple(map(float, c)) for c in cases], ", ".join(f"{n} double" for n in names))
    labels, top = annotate.dominant_of({n: F.col(n) for n in names})
    assert [tuple(r) for r in df.select(labels, top).collect()] == [(want, float(max(c))) for c, want in cases.items()]


def test_runs_and_asof(spark):
    df = spark.createDataFrame([(1, k, v) for k, v in enumerate("aabbbcaa")], "k int, t int, v string")
    row = runs.run_stats(df, ["k"], "t", F.col("v"), over=2).first()
    assert (row.longest_run, row.longest_run_value, row.n_runs_over_2) == (3, "b", 1)
    assert runs.longest_true_run(df, ["k"], "t", F.col("v") == "z").first().l_max == 0
    left = spark.createDataFrame([(1, 0.5), (1, 1.0), (1, 2.6), (2, 1.0)], "k int, t double")
    right = spark.createDataFrame([(1, 1.0, "x"), (1, 3.0, "y"), (1, 0.0, None)], "k int, s double, v string")
    assert {(r.k, r.t): r.n for r in asof.backward(left, right, ["k"], "t", "s", "v", "n").collect()} == {(1, 0.5): None, (1, 1.0): "x", (1, 2.6): "x", (2, 1.0): None}
    assert {(r.k, r.t): r.n for r in asof.nearest(left, right, ["k"], "t", "s", "v", "n").collect()} == {(1, 0.5): "x", (1, 1.0): "x", (1, 2.6): "y", (2, 1.0): None}


def test_attention_edges(spark):
    def one(values):
        df = spark.createDataFrame([(1, k * SEC, float(v)) for k, v in enumerate(values)], "k int, t long, value double")
        r = quality.attention(df, ["k"], quality.Windows(10 * SEC, 1)).first()
        return r.quality_flag, r.problem_flag

    assert one([50] * 10) == ("BAD", "FLAT")
    assert one([100] * 10) == ("BAD", "FLAT")
    assert one([0, 30, 40, 50, 60, 70, 60, 50, 40, 30]) == ("BAD", "ARTIFACT")
    assert one([20, 30, 40, 50, 60, 70, 60, 50, 40, 30]) == ("GOOD", "NONE")


def test_robust_z_and_missingness(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (2, 3.0), (3, 1.0), (3, 2.0), (3, 9.0)], "k int, x double")
    got = quality.robust_z(df, ["k"], "x", "z").collect()
    assert all(r.z is None for r in got if r.k < 3)
    assert {r.x: round(r.z, 4) for r in got if r.k == 3} == {1.0: -0.6745, 2.0: 0.0, 9.0: 4.7214}
    expected = spark.createDataFrame([("a", 10), ("b", 10)], "k string, expected int")
    actual = spark.createDataFrame([("a", 9, 0, 0)], "k string, actual int, zeros int, nulls int")
    got = {r.k: r for r in audit.missingness(expected, actual, ["k"], expected.filter("k = 'b'")).collect()}
    assert (got["a"].status, got["a"].missing, got["a"].missing_pct, got["a"].known) == ("complete", 1, 10.0, True)
    assert (got["b"].status, got["b"].expected, got["b"].known) == ("total_missing", 0, True)


def test_checks(spark):
    ids = spark.createDataFrame([("e01",), ("x",), (None,)], "entity_id string")
    assert {r.entity_id for r in checks.not_canonical(ids).collect()} == {"x", None}
    assert checks.too_few(ids, "entity_id", 3).count() == 1 and checks.too_few(ids, "entity_id", 2).count() == 0
    assert [x["status"] for x in checks.gate([("a", ids.limit(0)), ("b", ids), ("c", ids)])] == ["PASS", "FAIL"]
    files = spark.createDataFrame([("a", None), ("b", 0), ("c", 5), ("d", 50)], "path string, length long")
    got = {r.path: r.issues for r in checks.file_issues(files, [("small", F.col("length") < 10)]).collect()}
    assert got == {"a": ["missing"], "b": ["zero_byte"], "c": ["small"], "d": []}


def test_media():
    wav = b"RIFF\0\0\0\0WAVE" + b"LIST" + struct.pack("<I", 3) + b"abc\0" + b"fmt " + struct.pack("<IHHIIHH", 16, 1, 2, 8000, 32000, 4, 16) + b"data" + struct.pack("<I", 400) + b"\0" * 400
    assert media.wav_header(wav) == {"rate": 8000, "channels": 2, "bits": 16, "frames": 100}
    assert media.wav_header(b"RIFF") is None
    box = lambda name, body: struct.pack(">I4s", 8 + len(body), name) + body
    mvhd = box(b"mvhd", b"\0" * 12 + struct.pack(">II", 1000, 2500))
    stts = box(b"stts", b"\0" * 4 + struct.pack(">III", 1, 75, 40))
    trak = box(b"trak", box(b"mdia", box(b"mdhd", b"\0" * 12 + struct.pack(">II", 1000, 3000)) + box(b"hdlr", b"\0" * 8 + b"vide") + box(b"minf", box(b"stbl", stts))))
    assert media.mp4_header(box(b"ftyp", b"x") + box(b"moov", mvhd + trak)) == {"duration_s": 2.5, "frames": 75, "fps": 25.0}
    assert media.mat_kind(b"MATLAB 5.0 MAT-file") == "mat5"


def test_kernels():
    assert kernels.find_peaks(np.array([0, 1, 0, 3, 3, 0, 2, 0.0]), 1).tolist() == [1, 3, 6]
    assert kernels.find_peaks(np.array([0, 1, 0, 3, 0, 2, 0.0]), 3).tolist() == [3]
    t = np.arange(1024) / 256
    powers = kernels.band_powers(np.sin(2 * np.pi * 10 * t), 256)
    assert np.argmax(powers) == 2
    f, p = kernels.welch(np.sin(2 * np.pi * 20 * t), 256, 256)
    assert f[p.argmax()] == 20 and abs(p.sum() * (f[1] - f[0]) - 0.5) < 0.02
    slow = kernels.highpass(np.sin(2 * np.pi * 0.2 * t) + np.sin(2 * np.pi * 20 * t), 256, 1.0)
    assert abs(slow[200:-200].std() - np.sqrt(0.5)) < 0.05
    rng = np.random.default_rng(0)
    y = np.repeat([0, 1, 2], 50)
    x = rng.normal(0, 1, (150, 5)) + np.eye(3, 5)[y] * 6
    z = kernels.discriminant(x, y)
    assert z.shape == (150, 2)
    centres = np.stack([z[y == k].mean(0) for k in range(3)])
    assert (np.linalg.norm(z[:, None] - centres, axis=2).argmin(1) == y).mean() > 0.95


def test_hmm():
    from itertools import product

    rng = np.random.default_rng(0)
    seqs = []
    for _ in range(10):
        y = np.repeat(rng.integers(0, 2, 10), 5)
        seqs.append((y, [rng.normal(0, 1, (50, 2)) + 4 * y[:, None]], [np.ones(50)]))
    model = kernels.QualityHmm().fit(seqs, 2)
    assert np.allclose(model.trans.sum(1), 1) and abs(model.prior.sum() - 1) < 1e-12
    y, xs, qs = seqs[0]
    assert (model.decode(xs, qs) == y).mean() > 0.95
    assert np.allclose(np.exp(model.posteriors(xs, qs)).sum(1), 1)
    p, t, e = rng.normal(size=3), rng.normal(size=(3, 3)), rng.normal(size=(6, 3))
    score = lambda s: p[s[0]] + e[0, s[0]] + sum(t[a, b] + e[k + 1, b] for k, (a, b) in enumerate(zip(s, s[1:])))
    assert tuple(kernels.viterbi(p, t, e)) == max(product(range(3), repeat=6), key=score)


def test_models(spark):
    from tidegauge.operators import ml

    rng = np.random.default_rng(0)
    rows = [(k, *(rng.normal(0, 0.1, 2) + 5 * np.array([k % 3 == 1, k % 3 == 2])).tolist()) for k in range(18)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    out, k, scores = ml.kmeans(df, "id", ["x", "y"], range(2, 4), starts=2)
    assert k == 3 and scores[3] > 0.8 and out.count() == 18
    holes = spark.createDataFrame([(1.0, None), (3.0, None), (None, 5.0)], "a double, b double")
    assert [r.a for r in ml.impute(holes, holes, ["a"]).collect()] == [1.0, 3.0, 2.0]


def test_streaming(spark, tmp_path):
    from tidegauge.streaming import windows

    spark.createDataFrame([("u", k * 10, float(k)) for k in range(30)], "u string, s int, v double").selectExpr("u", "timestamp_seconds(s) AS ts", "v").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("u string, ts timestamp, v double").parquet(str(tmp_path / "in"))
    q = windows.tumbling_flags(stream, ["u"], "ts", "v", "1 minute", "0 seconds", 6, 1, 100).writeStream.format("memory").queryName("flags").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert {r.quality_flag for r in spark.table("flags").collect()} == {"GOOD"}


def test_percentages(spark):
    df = spark.createDataFrame([("s", "GOOD"), ("s", "BAD"), ("s", "NOISY"), ("t", "OTHER")], "signal string, quality_flag string")
    r = quality.summary(df, ["signal"]).collect()
    assert len(r) == 1 and (r[0].total_windows, r[0].good_pct) == (3, pytest.approx(33.33))
    assert stats.bad_rate(df, ["signal"]).filter("signal = 't'").first().bad == 1


def test_no_frame_is_left_out_of_video_flags(spark, tmp_path):
    """A user with more rows than six windows of 15 frames has as many windows as they fill."""
    from tidegauge.plans.queries import QUERIES

    rows = [(k, 1, k, 1.0) for k in range(200)] + [(200 + k, 2, k, 1.0) for k in range(20)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, s long, value double")
    events.select("event_id", "user_id", F.timestamp_seconds(F.col("s") + 1704067200).alias("ts"), F.lit("a").alias("event_type"), "value").write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["q_video_flags"](spark, str(tmp_path)).collect()
    assert sorted(r.window_id for r in got if r.user_id == 1) == list(range(14)) and sorted(r.window_id for r in got if r.user_id == 2) == list(range(6))
    assert all((r.window_blur is not None) == (r.window_id < (14 if r.user_id == 1 else 2)) for r in got)


def test_models_read_all_components_and_every_k(spark, monkeypatch):
    from tidegauge.operators import ml
    from tidegauge.plans.queries import QUERIES

    seen = {}
    # what each operator is asked for, without its fits
    monkeypatch.setattr(ml, "kmeans", lambda points, key, columns, ks, seed=42, starts=10, good=0.5: seen.update(kmeans=(len(columns), points.count(), ks, starts)) or (points, 0, {}))
    monkeypatch.setattr(ml, "pca", lambda df, train, columns, most=3: seen.update(pca=len(columns)) or df.withColumn("pc", F.array()))
    monkeypatch.setattr(ml, "lda", lambda df, group, label, columns, keep, most=3: seen.update(lda=len(columns)))
    for name in ("q_kmeans", "q_pca", "q_lda"):
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert seen == {"kmeans": (64, 40, range(2, 42), 10), "pca": 64, "lda": 64}


def test_kmeans_query_makes_all_fits_in_few_jobs(spark):
    from tidegauge.plans.queries import QUERIES

    before = spark.sparkContext.getLocalProperty("spark.jobGroup.id")
    spark.sparkContext.setJobGroup("kmeans", "all fits")
    got = QUERIES["q_kmeans"](spark, "/root/testdata/sf0.001").collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", before)
    assert sorted(r.id for r in got) == list(range(40)) and len({r.cluster for r in got}) > 1
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("kmeans")) <= 12


def test_kmeans_against_all_partitions():
    from itertools import product

    rng = np.random.default_rng(4)
    for _ in range(5):
        x = rng.normal(size=(8, 2))
        for k in (2, 3):
            cost = lambda y: sum(((x[y == c] - x[y == c].mean(0)) ** 2).sum() for c in set(y.tolist()))
            fits = [kernels.kmeans(x, k, 42 + s) for s in range(10)]
            assert all(c == pytest.approx(cost(y)) for y, c in fits)
            assert min(c for _, c in fits) == pytest.approx(min(cost(np.array(y)) for y in product(range(k), repeat=8)))
    copies = np.repeat([[0.0, 0.0], [1.0, 5.0]], 4, 0)
    y, cost = kernels.kmeans(copies, 3, 42)
    assert cost == 0 and len(set(y[:4])) == len(set(y[4:])) == 1 and y[0] != y[4]
    assert np.array_equal(kernels.standardised(np.array([[0.1, 1.0]] * 3 + [[0.1, 5.0]])).round(6)[:, 0], np.zeros(4))


def test_an_empty_cluster_takes_the_farthest_row(monkeypatch):
    x = np.array([[0.0], [1.0], [10.0], [30.0]])
    monkeypatch.setattr(kernels, "first_centres", lambda x, k, rng: np.array([[5.0], [1000.0], [2000.0]]))
    y, cost = kernels.kmeans(x, 3, 42)
    assert len(set(y.tolist())) == 3 and cost == pytest.approx(0.5)


def test_silhouettes_of_all_k_against_plain_loops(spark, monkeypatch):
    from tidegauge.operators import ml

    rng = np.random.default_rng(5)
    x = np.concatenate((rng.normal(size=(17, 3)), np.ones((3, 3))))
    labels = np.stack([rng.integers(0, 4, 20), np.arange(20) // 7, np.where(np.arange(20) == 0, 0, 1), np.zeros(20, int), np.where(np.arange(20) < 19, 0, 5)])
    plain = np.zeros(labels.shape)
    for r, y in enumerate(labels):
        for i in range(20):
            to = {c: np.mean([np.linalg.norm(x[i] - x[j]) for j in range(20) if j != i and y[j] == c]) for c in set(y.tolist()) if any(j != i and y[j] == c for j in range(20))}
            a, b = to.pop(y[i], None), min(to.values(), default=None)
            plain[r, i] = 0 if a is None or b is None or max(a, b) == 0 else (b - a) / max(a, b)
    assert np.allclose(np.concatenate([kernels.silhouettes(x, np.arange(a, min(20, a + 6)), labels) for a in range(0, 20, 6)], 1), plain, atol=1e-12)

    monkeypatch.setattr(ml, "DISTANCES", 100)  # several blocks of rows
    x = x[:17]
    df = spark.createDataFrame([(f"e{i:02}", *map(float, v)) for i, v in enumerate(x)], "id string, a double, b double, c double").repartition(5)
    out, k, scores = ml.kmeans(df, "id", ["a", "b", "c"], range(2, 42))
    again, *same = ml.kmeans(df.repartition(2), "id", ["a", "b", "c"], range(2, 42))
    assert list(scores) == list(range(2, 17)) and [k, scores] == same and sorted(out.collect()) == sorted(again.collect())
    assert k == (max([j for j in scores if scores[j] > 0.5], default=0) or max(scores, key=scores.get))
    z = kernels.standardised(x)
    own = spark.createDataFrame([(r.id, z[int(r.id[1:])].tolist(), r.cluster) for r in out.collect()], "id string, x array<double>, c int")
    assert ml.silhouette(own, "id", "x", "c").first()[0] == pytest.approx(scores[k])


def test_kmeans_of_odd_points(spark, monkeypatch):
    from tidegauge.operators import ml

    rows = [(k, float(k % 2), 7.0) for k in range(6)] + [(6, None, 1.0), (7, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    out, k, scores = ml.kmeans(df, "id", ["x", "y"], range(2, 42))
    got = {r.id: r.cluster for r in out.collect()}
    assert set(got) == set(range(6)) and scores[2] == 1 and len(set(got.values())) == 2
    assert len({got[k] for k in (0, 2, 4)}) == len({got[k] for k in (1, 3, 5)}) == 1
    same, k, scores = ml.kmeans(df.filter("x = 1"), "id", ["x", "y"], range(2, 42))
    assert scores == {2: 0} and same.count() == 3
    for n in (0, 1, 2):
        out, k, scores = ml.kmeans(df.filter(f"id < {n}"), "id", ["x", "y"], range(2, 42))
        assert [(r.id, r.cluster) for r in out.orderBy("id").collect()] == [(i, 0) for i in range(n)] and (k, scores) == (min(n, 1), {})
    monkeypatch.setattr(ml, "POINTS", 5)
    with pytest.raises(ValueError, match="5 entities"):
        ml.kmeans(df, "id", ["x", "y"], range(2, 42))


def test_percentiles_are_exact_without_a_sort(spark, monkeypatch):
    from tidegauge.operators import stats

    monkeypatch.setattr(stats, "FEW", 5)
    monkeypatch.setattr(stats, "BINS", 7)
    rng = np.random.default_rng(1)
    for x in (rng.lognormal(0, 3, 1500), np.repeat([1.0, 5.0], [900, 100]), np.array([3.0]), np.concatenate((rng.normal(0, 1e-12, 300), [1e9, -1e9]))):
        df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "v double")
        got = stats.percentiles(df, "v").first()
        assert np.allclose(list(got), np.percentile(x, [50, 75, 90, 95, 99]), rtol=1e-12, atol=1e-15)
    assert stats.percentiles(spark.createDataFrame([], "v double"), "v").first().p50 is None


def test_kernels_against_plain_loops():
    rng = np.random.default_rng(2)
    for n in (3, 10, 60, 200):
        x = np.round(rng.normal(size=n), 1)
        for distance in (1, 3, 9):
            tops = [(i + j) // 2 for i in range(1, n - 1) for j in [next(k for k in range(i, n) if k == n - 1 or x[k + 1] != x[i])] if x[i - 1] < x[i] and j < n - 1 and x[j + 1] < x[i] and (i == 0 or x[i - 1] != x[i])]
            keep, gone = [], set()
            for k in sorted(range(len(tops)), key=lambda k: x[tops[k]], reverse=False)[::-1]:
                if k not in gone:
                    keep.append(tops[k])
                    gone |= {j for j in range(len(tops)) if j != k and abs(tops[j] - tops[k]) < distance}
            assert sorted(keep) == kernels.find_peaks(x, distance).tolist()
        y = rng.normal(size=n)
        r = 0.2 * y.std()

        def phi(m, y=y, r=r):
            v = [y[i : i + m] for i in range(len(y) - m + 1)]
            return np.mean([np.log(np.mean([np.abs(a - b).max() <= r for b in v])) for a in v])

        if n > 3:
            assert kernels.approximate_entropy(y) == pytest.approx(phi(2) - phi(3), abs=1e-12)
    x, rate = rng.normal(size=64), 32.0
    f, p = kernels.welch(x, rate, 64)
    w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(64) / 64)
    y = (x - x.mean()) * w
    for k in range(33):
        z = sum(y[t] * np.exp(-2j * np.pi * k * t / 64) for t in range(64))
        want = abs(z) ** 2 / (rate * (w**2).sum()) * (1 if k in (0, 32) else 2)
        assert f[k] == k / 2 and p[k] == pytest.approx(want, abs=1e-12)


def test_windows_are_handed_over_together(spark):
    rows = [(k, w, i, float((7 * i + 3 * w + k) % 11)) for k in range(2) for w in (0, 1, 255, 256, 700) for i in range(12)]
    df = spark.createDataFrame(rows, "user_id int, window_id long, idx int, value double").repartition(3)
    got = {(r.user_id, r.window_id): (r.first, r.n) for r in features.per_window(df, ["user_id", "window_id"], "idx", ["first", "n", "gone"], lambda x: {"first": x[0], "n": float(len(x))}).collect()}
    assert got == {(k, w): (float((3 * w + k) % 11), 12.0) for k in range(2) for w in (0, 1, 255, 256, 700)}
