"""Readers, manifests, media and sinks on real files, and the way from files to flags."""

import io
import json
import struct
import wave
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.functions import scalars as S
from tidegauge.operators import audit, checks, quality
from tidegauge.plans import pipelines
from tidegauge.session import Config
from tidegauge.sources import manifest, media, readers, sinks


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text) if isinstance(text, str) else path.write_bytes(text)


def test_tables_with_schemas_and_missing_ones(spark, tmp_path):
    write(tmp_path / "a.csv", "timestamp,value\n1,2.5\nx,y\n")
    got = readers.csv(spark, str(tmp_path / "a.csv"), readers.SCALAR).collect()
    assert [(r.timestamp, r.value) for r in got] == [(1, 2.5), (None, None)]
    none = readers.csv(spark, str(tmp_path / "no.csv"), readers.AXES)
    assert none.count() == 0 and none.columns == ["timestamp", "x", "y", "z"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.table(spark, str(tmp_path / "none.parquet"))
    spark.range(3).write.json(str(tmp_path / "j"))
    assert readers.table(spark, str(tmp_path / "j"), "id long", "json").count() == 3
    write(tmp_path / "subjects.csv", "pid,startTime,endTime\n3,1000,61500\n")
    assert [tuple(r) for r in readers.subjects(spark, str(tmp_path / "subjects.csv")).collect()] == [("e03", 1.0, 61.5)]


def test_inventory_and_entities(spark, tmp_path):
    for e, m, f in (("e01", "eeg", "1_x.csv"), ("e01", "audio", "002_y.wav"), ("e02", "eeg", "z.csv")):
        write(tmp_path / f"files/entity={e}/modality={m}/{f}", "a,b\n1,2\n")
    write(tmp_path / "other/readme.txt", "x")
    files = readers.inventory(spark, str(tmp_path))
    assert files.count() == 4 and readers.inventory(spark, str(tmp_path), "*.csv").count() == 2
    assert sorted(r[0] for r in readers.entities(files).collect()) == ["e01", "e02"]
    assert sorted(r[0] for r in readers.top_folders(files, f"file:{tmp_path}").collect()) == ["files", "other"]
    names = files.select(F.regexp_extract("path", "[^/]*$", 0).alias("n"), S.trial_unit(F.regexp_extract("path", "[^/]*$", 0)).alias("u"), S.trial_id(F.regexp_extract("path", "[^/]*$", 0)).alias("t"))
    assert {r.n: (r.u, r.t) for r in names.collect()} == {"1_x.csv": ("1", 1), "002_y.wav": ("002", 2), "z.csv": ("z", None), "readme.txt": ("readme", None)}
    notes = spark.createDataFrame([("a/self_annotations/P3.self.csv",), ("a/partner_annotations/P3.partner.csv",), ("a/x/P12.external.csv",)], "path string")
    got = {r.entity_id: (r["self"], r.partner, r.external) for r in readers.annotation_files(notes).collect()}
    assert got["e03"][0].endswith("P3.self.csv") and got["e03"][2] is None and got["e12"][2].endswith("external.csv")
    odd = spark.createDataFrame([(1, 2.0, "x")], "`('a', 'mean')` int, `b` double, c string")
    assert readers.flat_names(odd).columns == ["a_mean", "b", "c"] and readers.feature_columns(readers.flat_names(odd), {"b"}) == ["a_mean"]


def test_signals_of_files(spark):
    rows = spark.createDataFrame([("e01", "1000", "1.5"), ("e01", "x", "2"), ("e01", "1250.5", ""), ("e02", "3000", "oops")], "entity_id string, timestamp string, value string")
    got = [(r.entity_id, r.t, round(r.t_s, 9), r.value) for r in readers.signal(rows, ["entity_id"], ["value"]).orderBy("entity_id", "t").collect()]
    assert got == [("e01", 0, 0.0, 1.5), ("e01", 250_500, 0.2505, None), ("e02", 0, 0.0, None)]
    steps = spark.createDataFrame([("a", float(k) / 4) for k in range(9)] + [("b", 1.0), ("b", None)], "k string, t double")
    own = readers.regular(steps, ["k"]).collect()
    assert {(r.k, r.rate) for r in own} == {("a", 4.0), ("b", 1.0)} and sorted(r.idx for r in own if r.k == "a") == list(range(9))


def test_from_files_to_flags(spark, tmp_path):
    """CSV files of two entities, one with other column order, a start before the session and a missing file."""
    rng = np.random.default_rng(1)
    root = tmp_path / "files"
    for e, start in (("e01", 1_000_000), ("e02", 2_000_000)):
        hr = "".join(f"{start + 1000 * k},{80 + rng.normal():.3f},d\n" for k in range(-12, 20))
        write(root / f"entity={e}/modality=biosignal/E4_HR.csv", "timestamp,value,device\n" + hr)
        eda = "".join(f"{1 + 0.1 * np.sin(k):.4f},{start + 250 * k}\n" for k in range(-130, 80))
        write(root / f"entity={e}/modality=biosignal/E4_EDA.csv", "value,timestamp\n" + eda)
        acc = "".join(f'"{start + 31.25 * k}",{rng.integers(-20, 20)},{rng.integers(-20, 20)},60\r\n' for k in range(640))
        write(root / f"entity={e}/modality=biosignal/E4_ACC.csv", "timestamp,x,y,z\r\n" + acc)
        if e == "e01":
            bands = "".join(f"{start + 1000 * k}," + ",".join(str(int(x)) for x in rng.integers(5, 50, 8)) + "\n" for k in range(-2, 20))
            write(root / f"entity={e}/modality=eeg/BrainWave.csv", "timestamp," + ",".join(readers.BANDS) + "\n" + bands)
    write(root / "entity=e02/modality=eeg/Attention.csv", "time,value\n1,2\n")
    sessions = spark.createDataFrame([("e01", 1000.0), ("e02", 2000.0), ("e03", 0.0)], "entity_id string, session_start_s double")
    samples = pipelines.signals_from_files(spark, str(root), sessions)
    assert set(samples) == {"E4_HR", "E4_EDA", "E4_ACC", "BrainWave", "Attention"}
    hr = samples["E4_HR"].agg(F.count("value"), F.min("t"), F.max("t")).first()
    assert tuple(hr) == (64, -12_000_000, 19_000_000) and samples["Attention"].count() == 0
    flags = pipelines.signal_flags(samples, 0.5, 40)
    got = {s: {(r.entity_id, r.quality_flag): r.n for r in f.groupBy("entity_id", "quality_flag").agg(F.count(F.lit(1)).alias("n")).collect()} for s, f in flags.items() if s != "Attention"}
    assert got["E4_ACC"] == {("e01", "GOOD"): 40, ("e02", "GOOD"): 40} and sum(got["E4_HR"].values()) == 80
    assert got["E4_EDA"] == {("e01", "GOOD"): 40, ("e02", "GOOD"): 40}
    wave_ = {r.window_id: r.power for r in flags["BrainWave"].filter("entity_id = 'e01'").collect()}
    assert len(wave_) == 40 and wave_[0] == wave_[1] != wave_[2]  # half-second windows of one-second metrics
    less = pipelines.signal_flags(samples, 1.0, 20, config=Config(start_from="e02", signals=("E4_HR",), thresholds={"E4_HR": {"inner": (100, 180)}}))
    assert set(less) == {"E4_HR"} and {r.entity_id for r in less["E4_HR"].collect()} == {"e02"}
    assert {r.quality_flag for r in less["E4_HR"].collect()} <= {"NOISY", "BAD"}
    one = pipelines.signal_flags(samples, 1.0, 20, only={"E4_EDA"}, first=1)
    assert {r.entity_id for r in one["E4_EDA"].collect()} == {"e01"}
    summary, report = pipelines.flag_report(flags, spark.createDataFrame([("e01", 3.0, "Calm")], "entity_id string, seconds double, emotion string"), 0.5)
    assert {r.signal_type for r in summary.collect()} >= {"E4_ACC", "E4_EDA", "E4_HR", "BrainWave"}
    assert {r.window_emotion for r in report.filter("entity_id = 'e01' and window_id >= 6").collect()} == {"Calm"}


def test_manifests(spark):
    paths = ["/d/EAV/subject1/Audio/001_a.wav", "/d/EAV/subject1/EEG/x.mat", "/d/EAV/subject1/EEG/.hidden", "/d/EAV/other/Audio/1.wav", "/d/meta_data.csv", "/d/questionnaire.xlsx", "/d/notes.txt"]
    inventory = spark.createDataFrame([(p, 1) for p in paths], "path string, length long")
    got = {r.local_path: (r.s3_path, r.entity_id, r.modality, r.table) for r in manifest.trials(inventory, {"Audio": "audio", "Video": "video", "EEG": "eeg"}, "t").collect()}
    assert got == {
        paths[0]: ("t/files/entity=subject1/modality=audio/001_a.wav", "subject1", "audio", "files"),
        paths[1]: ("t/files/entity=subject1/modality=eeg/x.mat", "subject1", "eeg", "files"),
        paths[4]: ("t/auxiliary/metadata/meta_data.csv", "global", "metadata", "aux"),
        paths[5]: ("t/auxiliary/annotations/questionnaire.xlsx", "global", "annotations", "aux"),
    }
    more = ["/k/audio/P1.P2.wav", "/k/video/P1_cam.mp4", "/k/e4_data/7/HR.csv", "/k/neurosky_polar_data/7/Attention.csv", "/k/readme.md"]
    got = {r.local_path: (r.entity_id, r.modality, r.table) for r in manifest.sessions(spark.createDataFrame([(p,) for p in more], "path string"), "k").collect()}
    assert got == {more[0]: ("P1_P2", "audio", "files"), more[1]: ("P1", "video", "files"), more[2]: ("7", "biosignal", "files"), more[3]: ("7", "eeg", "files"), more[4]: (None, None, "aux")}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s", "e01", "a", 1), ("s", "e02", "a", 2)], "dataset string, participant_id string, category string, v int")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).count() == 2
    sinks.write_parquet(df, str(tmp_path / "p"), "participant_id")
    sinks.overwrite_partitions(df.filter("v = 2").withColumn("v", F.lit(9)), str(tmp_path / "p"), "participant_id")
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "p")).collect()) == [1, 9]
    sinks.by_participant(df, str(tmp_path / "b"))
    assert (tmp_path / "b/dataset=s/participant_id=e01").is_dir()
    paths = ["/d/subject1/Audio/1.wav", "/d/meta_data.csv"]
    rows = manifest.trials(spark.createDataFrame([(p,) for p in paths], "path string"), {"Audio": "audio"}, "t")
    for _ in range(2):
        sinks.route(rows, str(tmp_path / "files"), str(tmp_path / "aux"))
    files, aux = spark.read.parquet(str(tmp_path / "files")), spark.read.parquet(str(tmp_path / "aux"))
    assert files.count() == aux.count() == 2 and files.filter("ingest_ts <> ingestion_time").count() == 0
    assert not checks.missing_columns(files, [c.split()[0] for c in readers.FILES.split(", ")]) and not checks.missing_columns(aux, [c.split()[0] for c in readers.AUX.split(", ")])
    assert (files.select("file_id").distinct().count(), aux.first().category) == (2, "metadata")
    assert checks.readable(files) and checks.readable(files.limit(0))
    place = sinks.report(df.select("participant_id", "v"), str(tmp_path), "raw", "FAIL")
    [text] = [r[0] for r in spark.read.text(place).collect()]
    found = json.loads(text)
    assert found["stage"] == "raw" and found["status"] == "FAIL" and sorted(f["v"] for f in found["findings"]) == [1, 2]


def wav_bytes(x, width, rate, channels=1):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        top = 2 ** (8 * width - 1)
        own = np.round(np.asarray(x) * (top - 1)).astype(np.int64)
        raw = (own + 128).astype(np.uint8).tobytes() if width == 1 else b"".join(int(v).to_bytes(width, "little", signed=True) for v in own)
        w.writeframes(raw)
    return out.getvalue()


def box(name, *parts):
    data = b"".join(parts)
    return struct.pack(">I4s", 8 + len(data), name) + data


def mp4_bytes(version):
    times = (lambda scale, d: struct.pack(">B3xQQIQ", 1, 0, 0, scale, d)) if version else (lambda scale, d: struct.pack(">B3xIIII", 0, 0, 0, scale, d))
    trak = lambda kind, scale, d, table: box(b"trak", box(b"mdia", box(b"hdlr", struct.pack(">II4s12x", 0, 0, kind)), box(b"mdhd", times(scale, d)), box(b"minf", box(b"stbl", box(b"stts", struct.pack(">II", 0, len(table)), *[struct.pack(">II", *t) for t in table])))))
    return box(b"ftyp", b"isom") + box(b"moov", box(b"mvhd", times(1000, 20_000)), trak(b"soun", 44100, 882_000, [(9, 1024)]), trak(b"vide", 30_000, 600_000, [(500, 1000), (100, 1000)]))


def mat_bytes(arrays, compressed=False):
    def element(kind, data):
        return struct.pack("<II", kind, len(data)) + data + b"\0" * (-len(data) % 8)

    out = b"MATLAB 5.0 MAT-file".ljust(124) + struct.pack("<H", 0x0100) + b"IM"
    for name, x in arrays:
        small = struct.pack("<HH", 1, len(name)) + name.encode().ljust(4, b"\0") if len(name) <= 4 else element(1, name.encode())
        body = element(6, struct.pack("<II", 6, 0)) + element(5, struct.pack(f"<{x.ndim}i", *x.shape)) + small + element(9, x.astype("<f8").tobytes(order="F"))
        own = struct.pack("<II", 14, len(body)) + body
        if compressed:
            z = zlib.compress(own)
            own = struct.pack("<II", 15, len(z)) + z
        out += own
    return out


def test_media_files(spark, tmp_path):
    x = np.sin(np.arange(4000) / 7) * 0.8
    for width in (1, 2, 3, 4):
        write(tmp_path / f"w{width}.wav", wav_bytes(x, width, 2000))
    write(tmp_path / "stereo.wav", wav_bytes(np.repeat(x, 2), 2, 2000, 2))
    write(tmp_path / "broken.wav", b"RIFFxxxx")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(str(tmp_path))
    heads = {r.path.split("/")[-1]: r for r in media.headers(files, "wav").collect()}
    assert all(heads[f"w{w}.wav"].duration_s == 2.0 and heads[f"w{w}.wav"].bits == 8 * w for w in (1, 2, 3, 4))
    assert heads["stereo.wav"].channels == 2 and heads["stereo.wav"].frames == 4000 and heads["broken.wav"].duration_s is None
    got = media.wav_samples(files.filter("path not like '%broken%'")).toPandas()
    for name, own in got.groupby(got.path.str.split("/").str[-1]):
        assert np.abs(own.sort_values("idx").value.to_numpy() - x).max() < (0.02 if name == "w1.wav" else 1e-3)
    for version in (0, 1):
        write(tmp_path / f"v{version}.mp4", mp4_bytes(version))
    write(tmp_path / "none.mp4", b"nothing here")
    found = {r.path.split("/")[-1]: (r.duration_s, r.frames, r.fps) for r in media.headers(spark.read.format("binaryFile").option("pathGlobFilter", "*.mp4").load(str(tmp_path)), "mp4").collect()}
    assert found["v0.mp4"] == found["v1.mp4"] == (20.0, 600.0, 30.0) and found["none.mp4"] == (None, None, None)
    timed = audit.media_timing(media.headers(files, "wav").select("path", "duration_s"), ["path"])
    assert timed.count() == 5 and {(r.start_rel_s, r.end_rel_s) for r in timed.collect()} == {(0.0, 2.0)}


def test_mat_arrays(spark, tmp_path):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(50, 3, 4)), rng.normal(size=(7, 2))
    for name, own, z in (("a", [("seg1", x), ("b", y)], False), ("c", [("_hidden", y), ("a_long_name", x)], True), ("two", [("y", y)], True)):
        write(tmp_path / f"{name}.mat", mat_bytes(own, z))
    write(tmp_path / "bad.mat", mat_bytes([("x", x)], True)[:200])
    write(tmp_path / "h5.mat", b"\x89HDF\r\n\x1a\n" + b"0" * 200)
    files = spark.read.format("binaryFile").load(str(tmp_path))
    shapes = {r.path.split("/")[-1]: (r.name, r["shape"]) for r in media.mat_shapes(files).collect()}
    assert shapes == {"a.mat": ("seg1", [50, 3, 4]), "c.mat": ("a_long_name", [50, 3, 4]), "two.mat": ("y", [7, 2]), "bad.mat": (None, None), "h5.mat": (None, None)}
    long = media.mat_signals(files.filter("path like '%c.mat'")).toPandas()
    assert len(long) == x.size
    back = np.empty_like(x)
    back[long.t, long.channel, long.instance] = long.value
    assert (back == x).all()
    arrays = media.mat_shapes(files).select(F.regexp_extract("path", "([^/]+)[.]mat$", 1).alias("entity_id"), "shape")
    timed = {(r.entity_id, r.unit_id): r.duration_s for r in audit.instance_timing(arrays, ["entity_id"], 500.0).collect()}
    assert timed == {**{(e, f"00{k}"): 0.1 for e in ("a", "c") for k in range(4)}, ("two", "000"): 7 / 500}
    kinds = [media.mat_kind((tmp_path / n).read_bytes()) for n in ("a.mat", "h5.mat")] + [media.mat_kind(b"MATLAB 7.3".ljust(128) + b"\x89HDF\r\n\x1a\n"), media.mat_kind(b"zip")]
    assert kinds == ["mat5", "hdf5", "mat73", None]


def test_frame_metrics():
    flat = np.full((20, 30), 100, np.uint8)
    assert media.frame_metrics(flat) == (0.0, 0.0)
    half = flat.copy()
    half[:, :15] = 0
    blur, clipped = media.frame_metrics(half)
    assert clipped == 0.5 and blur == pytest.approx(2 * 20 * 100**2 / 600)


def test_trial_drivers(spark):
    rng = np.random.default_rng(3)
    rows = [("e01", f"{k:03d}", i, float(v), 40.0) for k in (1, 2, 3) for i, v in enumerate(rng.uniform(-0.9, 0.9, 40 * 22))]
    sound = spark.createDataFrame(rows, "entity_id string, trial_id string, idx long, value double, rate double")
    frames = spark.createDataFrame([("e01", "002", i, 80.0, 0.0, 1) for i in range(130)], "entity_id string, trial_id string, frame long, lap_var double, clipped_ratio double, face int")
    eeg = spark.createDataFrame([("e01", "000", c, t, float(v)) for c in range(2) for t, v in enumerate(rng.normal(0, 10, 64))], "entity_id string, trial string, channel int, t long, value double")
    skipped = spark.createDataFrame([("e01", "003", "audio"), ("e01", "000", "video")], "entity_id string, unit_id string, signal_type string")
    got = pipelines.trial_flags({"audio": sound, "video": frames, "eeg": eeg}, 10, 32.0, skipped=skipped)
    assert got["audio"].groupBy("trial_id").count().orderBy("trial_id").collect() == [("001", 20), ("002", 20)]
    video = got["video"].orderBy("window_id").collect()
    assert len(video) == 20 and [r.quality_flag for r in video] == ["GOOD"] * 13 + ["BAD"] * 7
    assert got["eeg"].count() == 4
    long = sound.filter("trial_id = '001'").select("entity_id", F.lit("a").alias("file_id"), "idx", "value", "rate")
    sessions = spark.createDataFrame([("e01", 7.5), ("e02", 3.0)], "entity_id string, duration_s double")
    assert pipelines.session_audio(long, sessions).count() == 7
    assert pipelines.session_video(frames.drop("trial_id"), sessions, 10).count() == 7
    by_constant = quality.audio(sound.filter("trial_id = '001'"), ["trial_id"], 40.0, 1.0).drop("trial_id")
    assert by_constant.count() == 22


def test_configuration(tmp_path):
    write(tmp_path / "c.yaml", "start_from: e05\nsignals: [E4_HR]\nthresholds: {E4_HR: {still: [1, 2]}}\n")
    try:
        own = Config.load(str(tmp_path / "c.yaml"))
    except ModuleNotFoundError:
        pytest.skip("no YAML reader")
    assert own.start_from == "e05" and own.signals == ("E4_HR",)
