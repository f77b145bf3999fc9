"""Whole stages over made-up sessions."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge.operators import annotate, timewin
from tidegauge.plans import pipelines

SEC = 1_000_000


def test_all_signals_of_a_session(spark):
    rng = np.random.default_rng(0)
    rows = lambda rate, f: [(e, int(k * SEC / rate), float(f(k))) for e in ("e01", "e02") for k in range(int(40 * rate))]
    make = lambda data: spark.createDataFrame(data, "entity_id string, t long, value double")
    samples = {
        "E4_BVP": make(rows(64, lambda k: 50 * np.sin(k / 10))),
        "E4_EDA": make(rows(4, lambda k: 1 + 0.1 * np.sin(k))),
        "E4_HR": make(rows(1, lambda k: 70 + k % 3)),
        "E4_TEMP": make(rows(4, lambda k: 33 + 0.05 * np.sin(k))),
        "E4_IBI": make(rows(1, lambda k: 800 + rng.normal())),
        "Attention": make(rows(1, lambda k: 50 + k % 5)),
    }
    skipped = spark.createDataFrame([("e02", "E4_HR")], "entity_id string, signal_type string")
    flags = pipelines.signal_flags(samples, 1.0, 40, skipped)
    assert set(flags) == set(samples)
    assert flags["E4_BVP"].count() == 80 and flags["E4_HR"].count() == 40
    assert "bvp_quality_flag" in flags["E4_HR"].columns
    labels = spark.createDataFrame([("e01", 10.0, "Calm"), ("e01", 20.0, "Anger")], "entity_id string, seconds double, emotion string")
    summary, report = pipelines.flag_report(flags, labels, 1.0)
    totals = {r.signal_type: r.total_windows for r in summary.collect()}
    assert totals["E4_EDA"] == 80 and totals["E4_HR"] == 40
    got = {r.window_id: r.window_emotion for r in report.filter("entity_id = 'e01'").collect()}
    assert got[5] is None and got[10] == "Calm" and got[25] == "Anger" and len(got) == 40
    late = flags["E4_EDA"].filter("entity_id = 'e01' and window_id = 35").first()
    early = flags["E4_EDA"].filter("entity_id = 'e01' and window_id = 3").first()
    assert late.quality_flag == "GOOD" and early.problem_flag == "ARTIFACT"


def test_raw_layer(spark):
    manifest = spark.createDataFrame([("a", "d", 10, "x"), ("b", "d", 5, "y"), ("c", "d", 7, "z")], "path string, dataset string, size long, md5 string")
    inventory = spark.createDataFrame([("a", 10, "x"), ("b", 4, "y")], "path string, length long, md5 string")
    out = pipelines.raw_to_metadata(manifest, inventory, [("short", F.col("length") < 5)])
    assert {r.path: r.outcome for r in out["integrity"].collect()} == {"a": "ok", "b": "size_mismatch", "c": "missing"}
    assert {r.path for r in out["to_upload"].collect()} == {"b", "c"}
    assert {r.path: r.issues for r in out["issues"].collect()} == {"a": [], "b": ["short"], "c": ["missing"]}
    assert out["status"].first().status == "FAIL"


def test_sequences_over_seeds(spark):
    rng = np.random.default_rng(1)
    rows = []
    for trial in range(12):
        state = trial % 2
        for t in range(10):
            rows.append(("e01", trial, t, state, (rng.normal(0, 1, 2) + 4 * state).tolist(), 0.9))
    df = spark.createDataFrame(rows, "entity_id string, trial_id long, t long, state long, x array<double>, q double")
    found, scores = pipelines.sequence_labels(df, ["x"], ["q"], [1, 2])
    assert found.select("seed").distinct().count() == 2
    assert scores.first().accuracy_mean > 0.9


def test_annotations(spark):
    meta = spark.createDataFrame([(k + 1, int(k < 10), int(k >= 10)) for k in range(20)], "Index int, Neutral int, Anger int")
    got = annotate.conversations(meta, ["Neutral", "Anger"]).collect()
    assert {r.conversation: r.dominant for r in got} == {0: None, 1: "Anger"} and {r.occurrence for r in got if r.dominant} == {1}
    cells = spark.createDataFrame([(1, 0, "Calm", None), (1, 1, None, 2.0), (1, 2, None, 3.0), (1, 3, "Anger", None), (1, 4, None, 1.0)], "subject int, row int, label string, v double")
    got = sorted((r.emotion_class, r.k, r.v) for r in annotate.questionnaire(cells, ["subject"], "row", "label").collect())
    assert got == [("Anger", 1, 1.0), ("Calm", 1, 2.0), ("Calm", 2, 3.0)]
    scores = ["arousal", "valence", "cheerful", "happy", "angry", "nervous", "sad"]
    rows = []
    for rater, n in (("self", 5), ("partner", 4), ("external", 6)):
        rows += [("e01", rater, k, *[float(3 + (c == "sad"))for c in scores], "x", None) for k in range(n)]
    df = spark.createDataFrame(rows, "entity_id string, rater string, row int, " + ", ".join(f"{c} double" for c in scores) + ", boredom string, none_1 string")
    out = annotate.session_annotations(df, ["entity_id"], scores, [["boredom", "none_1"]]).orderBy("seconds").collect()
    assert [r.seconds for r in out] == [0, 5, 10, 15]
    assert all(r.quality_flag == "GOOD" and r.dominant_emotion == "Sadness" and r.check_0_agree == "AGREE" for r in out)


def test_features_of_every_signal(spark):
    """Each signal's features for all windows of two entities, those of skin on lookbacks numbered from 1."""
    rng = np.random.default_rng(4)
    rows = [(f"e0{e}", w, i, w + i / 64, float(60 + 10 * np.sin(i / 5 + e) + rng.normal())) for e in (1, 2) for w in range(3) for i in range(64)]
    df = spark.createDataFrame(rows, "entity_id string, window_id long, idx int, t double, value double")
    axes = df.withColumns({"x": F.col("value"), "y": F.col("value") / 2, "z": F.lit(60.0)})
    own = {"E4_ACC": axes, "E4_BVP": df, "E4_TEMP": df, "E4_HR": df, "Polar_HR": df, "E4_IBI": df.withColumn("value", F.col("value") * 12), "EEG": df, "odd": df}
    late = timewin.lookback(df.select("entity_id", "idx", "value", (F.col("t") * 1_000_000).cast("long").alias("us"), "t"), F.col("us"), 1_000_000, 2_000_000, 3, base=1)
    own["E4_EDA"] = late.withColumn("idx", F.row_number().over(Window.partitionBy("entity_id", "window_id").orderBy("t")) - 1)
    found = pipelines.entity_features(own, {"EEG": 64.0})
    assert set(found) == set(own) - {"odd"}
    got = {s: {(r.entity_id, r.window_id): r for r in f.collect()} for s, f in found.items()}
    assert all(set(v) == {(e, w) for e in ("e01", "e02") for w in range(3)} for s, v in got.items() if s != "E4_EDA")
    assert set(got["E4_EDA"]) == {(e, w) for e in ("e01", "e02") for w in (1, 2, 3)}
    values = np.array([r[4] for r in rows if r[0] == "e01" and r[1] == 1])
    assert abs(got["E4_TEMP"]["e01", 1]["mean"] - values.mean()) < 1e-9 and abs(got["E4_ACC"]["e01", 1].x_std - values.std(ddof=1)) < 1e-9
    assert got["E4_ACC"]["e01", 1].z_std == 0 and got["E4_HR"]["e01", 1].hr_mean == got["Polar_HR"]["e01", 1].hr_mean
    assert abs(got["E4_TEMP"]["e01", 1].slope - np.polyfit(np.arange(64) / 4, values, 1)[0]) < 1e-9
    longer = np.array([r[4] for r in rows if r[0] == "e01" and r[1] in (0, 1)])
    assert abs(got["E4_EDA"]["e01", 2]["mean"] - longer.mean()) < 1e-9 and got["E4_EDA"]["e01", 2].scr_count >= 1
    assert got["E4_BVP"]["e01", 0].n_peaks >= 1 and got["EEG"]["e01", 0].entropy > 0 and got["E4_IBI"]["e02", 2].n == 64


def test_three_layers_as_tables(spark):
    manifest = spark.createDataFrame([("a", "s", 5, "m1"), ("b", "s", 6, "m2"), ("c", "t", 7, "m3")], "path string, dataset string, size long, md5 string")
    inventory = spark.createDataFrame([("a", 5, "m1"), ("b", 6, "other")], "path string, length long, md5 string")
    out = pipelines.raw_to_metadata(manifest, inventory, [("small", F.col("length") < 6)])
    assert {r.path: list(r.issues) for r in out["issues"].collect()} == {"a": ["small"], "b": [], "c": ["missing"]}
    assert {r.dataset: r.status for r in out["status"].collect()} == {"s": "FAIL", "t": "FAIL"}
    assert [r.path for r in out["to_upload"].collect()] == ["c"]
    assert {r.path: r.outcome for r in out["integrity"].collect()} == {"a": "ok", "b": "hash_mismatch", "c": "missing"}
