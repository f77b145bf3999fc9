"""Queries of the operators around the signals: paths, manifests, audits, annotations, labels, features and models.

Roles are made from the shared tables: documents are files, events are samples, trials or rows of an inventory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions import scalars as S
from tidegauge.operators import annotate, audit, checks, features, fusion, ml, quality, stats, timewin
from tidegauge.plans import pipelines
from tidegauge.plans.queries import DAY, DAYS, FLAG_SQL, KEYS, E, query, samples, sql_runs, table


def flag() -> Column:
    return F.when(F.col("value") > 120, "BAD").when(F.col("value") > 60, "NOISY").otherwise("GOOD")


def cents() -> Column:
    return F.round(F.col("value") * 100).cast("long")


def entity(number: Column) -> Column:
    return F.concat(F.lit("e"), F.lpad(number.cast("string"), 2, "0"))


def rounded(df: DataFrame, names: list[str], places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in names})


# -- paths ----------------------------------------------------------------------------------------

NAMES = (
    "e05_biosignal_bvp_quality_flags.csv",
    "e05_biosignal_polar_hr_quality_flags.csv",
    "audio_quality_flags.csv",
    "012_x_quality_flags.csv",
    "biosignal_eeg_quality_flags.csv",
    "e1_video_quality_flags.csv",
    "notes.txt",
    "7_biosignal_hr_quality_flags.csv",
)
PATH_SQL = f"SELECT doc_id, 'silver/q/' || source || '/files/entity=e' || lpad((doc_id % 40)::VARCHAR, 2, '0') || CASE WHEN doc_id % 3 > 0 THEN '/modality=' || lang ELSE '' END || '/' || {list(NAMES)}[doc_id % 8 + 1] AS path FROM documents"


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.element_at(F.array(*[F.lit(n) for n in NAMES]), (F.col("doc_id") % 8 + 1).cast("int"))
    mode = F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("/modality="), "lang")).otherwise("")
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("silver/q/"), "source", F.lit("/files/entity="), entity(F.col("doc_id") % 40), mode, F.lit("/"), names).alias("path"))


@query(f"""WITH p AS ({PATH_SQL}), n AS (SELECT *, regexp_extract(path, '[^/]*$') AS name, nullif(regexp_extract(path, 'modality=([^/]+)', 1), '') AS modality FROM p)
    SELECT doc_id, regexp_extract(path, 'entity=([^/]+)', 1) AS entity_id, modality, split_part(path, '/', 3) AS dataset,
      CASE name WHEN 'e05_biosignal_bvp_quality_flags.csv' THEN 'E4_BVP' WHEN 'e05_biosignal_polar_hr_quality_flags.csv' THEN 'Polar_HR' WHEN 'audio_quality_flags.csv' THEN 'audio' WHEN 'biosignal_eeg_quality_flags.csv' THEN 'eeg'
        WHEN 'e1_video_quality_flags.csv' THEN 'video' WHEN '7_biosignal_hr_quality_flags.csv' THEN 'E4_HR' ELSE coalesce(modality, 'unknown') END AS signal_type,
      CASE doc_id % 8 WHEN 3 THEN '012' WHEN 7 THEN '7' ELSE regexp_replace(name, '[.][^.]*$', '') END AS unit_id, CASE doc_id % 8 WHEN 3 THEN 12 WHEN 7 THEN 7 END AS trial_id, (doc_id % 40)::INT AS pid,
      'gold/r' || substr(regexp_replace(path, 'entity=[^/]+', 'entity=e99'), 9) AS moved, regexp_replace(name, '[.][^.]*$', '') AS stem FROM n""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, name = F.col("path"), F.regexp_extract("path", "[^/]*$", 0)
    return paths(spark, sf_dir).select(
        "doc_id",
        S.path_part(path, "entity").alias("entity_id"),
        S.path_part(path, "modality").alias("modality"),
        S.dataset_of_path(path, "silver/q").alias("dataset"),
        S.signal_of_path(path).alias("signal_type"),
        S.trial_unit(name).alias("unit_id"),
        S.trial_id(name).alias("trial_id"),
        S.participant_number(S.path_part(path, "entity")).alias("pid"),
        S.rewritten_path(path, "silver/q", "gold/r", F.lit("e99")).alias("moved"),
        S.file_stem(path).alias("stem"),
    )


@query("""SELECT c_custkey, lpad((c_custkey % 250)::VARCHAR, 3, '0') || '_' || lpad((c_nationkey * 5)::VARCHAR, greatest(2, length((c_nationkey * 5)::VARCHAR))::INT, '0') AS key, (c_custkey % 250)::INT AS trial, (c_nationkey * 5)::INT AS win,
    'e07_' || CASE c_custkey % 3 WHEN 0 THEN 'biosignal_polar_hr' WHEN 1 THEN 'audio' ELSE 'biosignal_odd' END || '_quality_flags.csv' AS file_name FROM customer""")
def composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = S.trial_window_key((F.col("c_custkey") % 250).cast("int"), (F.col("c_nationkey") * 5).cast("int"))
    name = lambda s: S.flags_file_name(F.lit("e07"), s)
    file_name = F.when(F.col("c_custkey") % 3 == 0, name("Polar_HR")).when(F.col("c_custkey") % 3 == 1, name("audio")).otherwise(name("Odd"))
    return table(spark, sf_dir, "customer").select("c_custkey", key.alias("key"), S.trial_of_key(key).alias("trial"), S.window_of_key(key).alias("win"), file_name.alias("file_name"))


@query("SELECT c_custkey, lpad((c_nationkey + 3 * k)::VARCHAR, 3, '0') AS unit_id FROM customer, range(4) r(k)")
def expected_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = S.expected_trials(F.col("c_nationkey"), 3, 4)
    return table(spark, sf_dir, "customer").select("c_custkey", F.explode(units).alias("unit_id"))


# -- missing data ---------------------------------------------------------------------------------

MISS = """CASE WHEN small THEN 'size_anomaly' WHEN n = 0 THEN 'total_missing' WHEN n < expected - 1 OR bad > 0 THEN 'partial_missing' ELSE 'complete' END AS status"""
MISS_OUT = """want AS expected, n AS actual, miss AS missing, CASE WHEN want > 0 THEN round(miss * 100 / want::DOUBLE, 4) ELSE 0 END::DOUBLE AS missing_pct, status, known OR status = 'complete' AS known,
    CASE WHEN n > 0 THEN round(bad * 100 / n::DOUBLE, 4) ELSE 0 END::DOUBLE AS zero_or_null_pct, miss + bad AS effective_missing, CASE WHEN want > 0 THEN round((miss + bad) * 100 / want::DOUBLE, 4) ELSE 0 END::DOUBLE AS effective_missing_pct"""
MISS_STEPS = f"""s AS (SELECT *, {MISS} FROM r), w AS (SELECT *, CASE WHEN status = 'total_missing' THEN 0 ELSE coalesce(expected, 0) END AS want FROM s), m AS (SELECT *, CASE WHEN want > 0 THEN greatest(want - n, 0) ELSE 0 END AS miss FROM w)"""


@query(f"""WITH g AS (SELECT 'audio' AS signal_type, 'mic' AS device, 'a' AS modality, 1 AS first, 2 AS step, 6 AS many, 10.0 AS duration_s, NULL AS expected, NULL AS min_bytes UNION ALL VALUES ('video', 'cam', 'v', 2, 2, 5, 12.5, NULL, NULL), ('eeg', 'amp', 'e', 0, 1, 8, NULL, 45, 110)),
    x AS (SELECT DISTINCT 'e' || lpad((user_id % 5)::VARCHAR, 2, '0') AS entity_id FROM events),
    f AS (SELECT 'e' || lpad((user_id % 5)::VARCHAR, 2, '0') AS entity_id, CASE event_type WHEN 'view' THEN 'audio' WHEN 'click' THEN 'video' ELSE 'eeg' END AS signal_type, lpad((event_id % 9)::VARCHAR, 3, '0') AS unit_id,
      4.0::DOUBLE + any_value(event_id % 9) % 3 AS rate, sum(event_id) % 60 AS actual, 100 + sum(event_id) % 50 AS length FROM events WHERE event_id % 4 > 0 GROUP BY ALL),
    j AS (SELECT x.entity_id, g.*, lpad((first + k * step)::VARCHAR, 3, '0') AS unit_id FROM x, g, range(8) r(k) WHERE k < many),
    r AS (SELECT j.* EXCLUDE (expected), rate AS sample_rate_hz, coalesce(j.expected, CASE WHEN actual IS NOT NULL THEN round_even(duration_s * rate, 0) END)::BIGINT AS expected, coalesce(length < min_bytes, false) AS small,
      CASE WHEN coalesce(length < min_bytes, false) THEN 0 ELSE coalesce(actual, 0) END::BIGINT AS n, 0 AS bad, (entity_id, signal_type) IN (('e02', 'audio'), ('e03', 'eeg')) AS known FROM j LEFT JOIN f USING (entity_id, signal_type, unit_id)),
    {MISS_STEPS} SELECT entity_id, signal_type, unit_id, device, modality, sample_rate_hz, {MISS_OUT} FROM m""")
def trial_missingness(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("entity_id", entity(F.col("user_id") % 5))
    signal = F.when(F.col("event_type") == "view", "audio").when(F.col("event_type") == "click", "video").otherwise("eeg")
    unit = (F.col("event_id") % 9).cast("int")
    found = e.filter("event_id % 4 > 0").groupBy("entity_id", signal.alias("signal_type"), unit.alias("_u")).agg((F.sum("event_id") % 60).alias("actual"), (100 + F.sum("event_id") % 50).alias("length"))
    found = found.select("entity_id", "signal_type", F.format_string("%03d", "_u").alias("unit_id"), (4.0 + F.col("_u") % 3).alias("sample_rate_hz"), "actual", "length")
    schema = "signal_type string, device string, modality string, first int, step int, many int, digits int, duration_s double, expected long, min_bytes long"
    signals = spark.createDataFrame([("audio", "mic", "a", 1, 2, 6, 3, 10.0, None, None), ("video", "cam", "v", 2, 2, 5, 3, 12.5, None, None), ("eeg", "amp", "e", 0, 1, 8, 3, None, 45, 110)], schema)
    known = audit.known_missing(spark.createDataFrame([(["e02"], ["audio"]), (["e03"], ["eeg"])], "people array<string>, signals array<string>"), "people", "signals").toDF("entity_id", "signal_type")
    return audit.trial_missingness(e.select("entity_id"), signals, found, known)


@query(f"""WITH g AS (SELECT 'view' AS signal_type, 'd1' AS device, 'm1' AS modality, 4.0::DOUBLE AS hz UNION ALL VALUES ('click', 'd2', 'm2', NULL), ('error', 'd3', 'm1', 1.0)), e AS (SELECT *, 'e' || lpad(user_id::VARCHAR, greatest(2, length(user_id::VARCHAR))::INT, '0') AS entity_id FROM events),
    a AS (SELECT DISTINCT entity_id, CASE user_id % 2 WHEN 0 THEN 'click' ELSE 'error' END AS signal_type FROM e WHERE user_id % 3 = 0), x AS (SELECT entity_id FROM e WHERE user_id % 7 > 0 UNION SELECT entity_id FROM a),
    q AS (SELECT DISTINCT entity_id, 1.5 + user_id % 4 AS s FROM e WHERE user_id % 5 > 0),
    f AS (SELECT entity_id, event_type AS signal_type, 3.0::DOUBLE + any_value(user_id) % 2 AS rate, count(*) AS actual, count(*) FILTER (value < 2) + count(*) FILTER (event_id % 50 = 0 AND value >= 2) AS bad FROM e WHERE user_id % 4 > 0 GROUP BY ALL),
    r AS (SELECT x.entity_id, g.*, CASE WHEN actual IS NULL THEN coalesce(hz, 0) ELSE rate END AS sample_rate_hz, CASE WHEN actual IS NOT NULL THEN round_even(s * rate, 0) END::BIGINT AS expected, false AS small, coalesce(actual, 0) AS n, coalesce(bad, 0) AS bad, a.entity_id IS NOT NULL AND actual IS NULL AS known
      FROM x CROSS JOIN g LEFT JOIN q USING (entity_id) LEFT JOIN f USING (entity_id, signal_type) LEFT JOIN a USING (entity_id, signal_type)),
    {MISS_STEPS} SELECT entity_id, entity_id AS unit_id, signal_type, device, modality, sample_rate_hz, {MISS_OUT} FROM m""")
def session_missingness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Availability comes as a wide table of TRUE and FALSE, samples with zeros and nulls."""
    e = table(spark, sf_dir, "events").withColumn("entity_id", F.concat(F.lit("e"), F.lpad(F.col("user_id").cast("string"), F.greatest(F.lit(2), F.length(F.col("user_id").cast("string"))), "0")))
    who = e.select("entity_id", "user_id").distinct()
    wide = who.filter("user_id % 3 = 0").select("entity_id", F.when(F.col("user_id") % 2 == 0, " false").otherwise("TRUE").alias("click"), F.when(F.col("user_id") % 2 == 0, "TRUE").otherwise("False ").alias("error"))
    absent = audit.known_absent(wide, "entity_id").withColumnRenamed("signal", "signal_type")
    own = e.filter("user_id % 4 > 0").withColumn("value", F.when(F.col("value") < 2, 0.0).when(F.col("event_id") % 50 == 0, None).otherwise(F.col("value"))).withColumn("t", F.col("event_id").cast("double"))
    scan = audit.signal_scan(own.withColumn("rate", 3.0 + F.col("user_id") % 2), ["entity_id", "event_type", "rate"], zero_check=True)
    found = scan.select("entity_id", F.col("event_type").alias("signal_type"), F.col("rate").alias("sample_rate_hz"), "actual", "zeros", "nulls")
    sessions = who.filter("user_id % 5 > 0").select("entity_id", F.lit(10.0).alias("session_start_s"), (11.5 + F.col("user_id") % 4).alias("session_end_s"))
    signals = spark.createDataFrame([("view", "d1", "m1", 4.0), ("click", "d2", "m2", None), ("error", "d3", "m1", 1.0)], "signal_type string, device string, modality string, declared_hz double")
    return audit.session_missingness(who.filter("user_id % 7 > 0"), signals, sessions, found, absent)


@query("""WITH a AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN [100 + c_custkey % 7, 3, c_nationkey % 5] WHEN 1 THEN [30, 40 + c_custkey % 9] WHEN 2 THEN [9] END AS shape FROM customer),
    d AS (SELECT c_custkey, CASE len(shape) WHEN 3 THEN shape[1] WHEN 2 THEN greatest(shape[1], shape[2]) END AS points, CASE len(shape) WHEN 3 THEN shape[3] WHEN 2 THEN 1 END AS many FROM a)
    SELECT c_custkey, lpad(k::VARCHAR, 3, '0') AS unit_id, 0.0::DOUBLE AS start_rel_s, points / 50.0::DOUBLE AS end_rel_s, points / 50.0::DOUBLE AS duration_s FROM d, range(5) r(k) WHERE k < many""")
def instance_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    shape = F.when(k % 4 == 0, F.array(100 + k % 7, F.lit(3).cast("long"), (F.col("c_nationkey") % 5).cast("long"))).when(k % 4 == 1, F.array(F.lit(30).cast("long"), 40 + k % 9)).when(k % 4 == 2, F.array(F.lit(9).cast("long")))
    return audit.instance_timing(table(spark, sf_dir, "customer").select("c_custkey", shape.alias("shape")), ["c_custkey"], 50.0)


@query("""SELECT doc_id, 0.0::DOUBLE AS start_rel_s, n_chars / 16.0::DOUBLE AS end_rel_s, n_chars / 16.0::DOUBLE AS duration_s FROM documents WHERE doc_id % 5 > 0 AND n_chars IS NOT NULL""")
def media_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.media_timing(table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 5 > 0, F.col("n_chars") / 16).alias("duration_s")), ["doc_id"])


@query(f"""WITH {E}, g AS (SELECT user_id, count(*) AS n FROM e WHERE user_id >= 4 GROUP BY 1 ORDER BY 1 LIMIT 6), s AS (SELECT user_id, CASE WHEN n < 66 THEN 'partial_missing' ELSE 'complete' END AS status FROM g) SELECT status, user_id % 2 AS part, count(*) AS n FROM s GROUP BY ALL""")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statuses of the first six users from the fourth on."""
    chosen = audit.chosen_entities(samples(spark, sf_dir), "user_id", start_from=4, first=6)
    n = chosen.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return audit.status_counts(n.select((F.col("user_id") % 2).alias("part"), S.status(F.col("n"), F.lit(67)).alias("status")), ["part"])


@query("""WITH r AS (SELECT user_id, event_type, count(*) AS n, nullif(any_value(user_id) % 3, 0) AS hz FROM events GROUP BY ALL) SELECT e.event_id, e.user_id, e.event_type, coalesce(r.hz, 4)::DOUBLE AS rate FROM events e LEFT JOIN (SELECT * FROM r WHERE user_id % 4 > 0) r ON r.user_id = e.user_id AND r.event_type = e.event_type
    WHERE NOT EXISTS (SELECT 1 FROM r q WHERE q.user_id = e.user_id AND q.event_type = e.event_type AND q.n < 12)""")
def rates_and_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    n = e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    report = n.select(
        F.col("user_id").alias("participant_id"), F.lit("u").alias("unit_id"), F.col("event_type").alias("signal_type"), F.when(F.col("user_id") % 4 > 0, (F.col("user_id") % 3).cast("double")).alias("sample_rate_hz"), F.when(F.col("n") < 12, "total_missing").otherwise("complete").alias("status")
    )
    rates, skips = audit.rates_and_skips(report)
    keys = ["participant_id", "signal_type"]
    rows = e.withColumnsRenamed({"user_id": "participant_id", "event_type": "signal_type"})
    out = audit.with_rates(audit.without_skipped(rows, skips, keys), rates, keys, 4.0)
    return out.withColumnsRenamed({"participant_id": "user_id", "signal_type": "event_type"})


@query(f"""WITH {E}, s AS (SELECT user_id, 3 * {DAY} + user_id AS a, 20 * {DAY} AS b FROM (SELECT DISTINCT user_id FROM e WHERE user_id % 4 > 0)) SELECT e.user_id, t / 1000000 AS t, value FROM e JOIN s USING (user_id) WHERE t / 1000000 BETWEEN a / 1000000 AND b / 1000000""")
def in_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir).withColumn("t", F.col("t") / 1_000_000)
    sessions = rows.filter("user_id % 4 > 0").select("user_id").distinct().select("user_id", ((3 * DAY + F.col("user_id")) / 1_000_000).alias("session_start_s"), F.lit(20 * DAY / 1_000_000).alias("session_end_s"))
    return audit.in_session(rows, sessions, KEYS).select("user_id", "t", "value")


# -- raw files, integrity -------------------------------------------------------------------------


@query("""WITH f AS (SELECT doc_id, source AS dataset, ['audio', 'video', 'mat', 'csv', 'other'][doc_id % 5 + 1] AS modality, CASE WHEN doc_id % 17 = 0 THEN '.hid.wav' ELSE 'f' || doc_id || ['.WAV', '.mp4', '.mat', '.csv', '.txt'][(doc_id + doc_id // 50) % 5 + 1] END AS name,
      CASE WHEN doc_id % 23 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN 0 ELSE n_chars END AS length, CASE WHEN doc_id % 13 > 0 THEN n_chars / 100.0 END::DOUBLE AS duration_s, [44100.0, 22050.0][doc_id % 3 // 2 + 1]::DOUBLE AS rate, doc_id % 11 > 0 AS readable FROM documents),
    r(modality, ext, lo, hi, hz, least) AS (VALUES ('audio', ['.wav'], 5.0, 60.0, 44100.0, NULL), ('video', ['.mp4', '.wav'], NULL, NULL, NULL, 1500), ('mat', []::VARCHAR[], NULL, NULL, NULL, NULL), ('csv', ['.csv', '.mat', '.txt'], NULL, NULL, NULL, NULL)),
    j AS (SELECT f.*, r.* EXCLUDE (modality), r.modality AS kind FROM f LEFT JOIN r ON f.modality = r.modality AND f.dataset < 'src2'),
    k AS (SELECT * FROM j WHERE name[1] <> '.' AND (ext IS NULL OR len(ext) = 0 OR list_contains(ext, lower(regexp_extract(name, '[.][^.]*$')))))
    SELECT doc_id, dataset, modality, name, length, duration_s, rate, readable, CASE WHEN length IS NULL THEN 'missing' WHEN length = 0 THEN 'zero_byte' ELSE concat_ws(',', CASE WHEN (kind = 'audio' AND duration_s IS NULL) OR (kind IN ('mat', 'csv') AND NOT readable) THEN 'cannot_open' END, CASE WHEN kind = 'audio' AND duration_s < lo THEN 'too_short' END,
      CASE WHEN kind = 'audio' AND duration_s > hi THEN 'too_long' END, CASE WHEN kind = 'audio' AND rate <> hz THEN 'other_rate' END, CASE WHEN kind = 'video' AND length < least THEN 'too_small' END) END AS issues FROM k""")
def raw_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    pick = lambda names, at: F.element_at(F.array(*[F.lit(n) for n in names]), (at + 1).cast("int"))
    d = table(spark, sf_dir, "documents")
    files = d.select(
        "doc_id",
        F.col("source").alias("dataset"),
        pick(["audio", "video", "mat", "csv", "other"], i % 5).alias("modality"),
        F.when(i % 17 == 0, ".hid.wav").otherwise(F.concat(F.lit("f"), i, pick([".WAV", ".mp4", ".mat", ".csv", ".txt"], (i + F.floor(i / 50)) % 5))).alias("name"),
        F.when(i % 23 == 0, None).when(i % 19 == 0, 0).otherwise(F.col("n_chars")).alias("length"),
        F.when(i % 13 > 0, F.col("n_chars") / 100).alias("duration_s"),
        pick([44100.0, 22050.0], F.floor(i % 3 / 2)).alias("rate"),
        (i % 11 > 0).alias("readable"),
    )
    own = [("audio", [".wav"], 5.0, 60.0, 44100.0, None), ("video", [".mp4", ".WAV"], None, None, None, 1500), ("mat", [], None, None, None, None), ("csv", [".csv", ".mat", ".txt"], None, None, None, None)]
    schema = "modality string, extensions array<string>, min_duration_s double, max_duration_s double, expected_rate double, min_bytes long"
    rules = d.select(F.col("source").alias("dataset")).filter("source < 'src2'").distinct().join(spark.createDataFrame(own, schema)).withColumn("kind", F.col("modality"))  # four rules for each dataset
    return checks.raw_issues(files, rules).withColumn("issues", F.array_join("issues", ","))


@query("""SELECT source, count(*) AS files, count(*) FILTER (n_chars < 300 OR doc_id % 9 = 0) AS with_issues, CASE WHEN count(*) FILTER (n_chars < 300 OR doc_id % 9 = 0) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM documents GROUP BY 1""")
def issue_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").withColumn("length", F.when(F.col("doc_id") % 9 == 0, None).otherwise(F.col("n_chars")))
    return checks.rollup(checks.file_issues(files, [("short", F.col("length") < 300)]), ["source"])


INTEGRITY_SQL = """WITH m AS (SELECT doc_id AS path, strlen(text) AS size, md5(text) AS md5, n_chars / 100.0 AS duration_s FROM documents), i AS (SELECT doc_id AS path, strlen(text) + (doc_id % 5 = 0)::INT AS size, CASE WHEN doc_id % 7 = 0 THEN 'ab-2' WHEN doc_id % 3 = 0 THEN 'x' ELSE md5(text) END AS md5 FROM documents WHERE doc_id % 11 > 0)
    SELECT m.path, CASE WHEN i.path IS NULL THEN 'missing' WHEN i.size <> m.size THEN 'size_mismatch' WHEN i.md5 NOT LIKE '%-%' AND i.md5 <> m.md5 THEN 'hash_mismatch' WHEN duration_s < 4 OR duration_s > 30 THEN 'content' ELSE 'ok' END AS outcome FROM m LEFT JOIN i USING (path)"""


@query(INTEGRITY_SQL)
def integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain with content last; the inventory's hashes are quoted and in capitals."""
    d = table(spark, sf_dir, "documents")
    size, md5 = F.octet_length("text"), F.md5(F.col("text").cast("binary"))
    manifest = d.select(F.col("doc_id").alias("path"), size.alias("size"), md5.alias("md5"), (F.col("n_chars") / 100).alias("duration_s"))
    other = F.when(F.col("doc_id") % 7 == 0, "ab-2").when(F.col("doc_id") % 3 == 0, "x").otherwise(F.concat(F.lit('"'), F.upper(md5), F.lit('"')))
    inventory = d.filter(F.col("doc_id") % 11 > 0).select(F.col("doc_id").alias("path"), (size + (F.col("doc_id") % 5 == 0).cast("int")).alias("size"), other.alias("md5"))
    return checks.reconcile(manifest, inventory, content=(F.col("duration_s") < 4) | (F.col("duration_s") > 30))


@query(f"SELECT path FROM ({INTEGRITY_SQL}) WHERE outcome NOT IN ('ok', 'missing')")
def faulty_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.faulty(integrity(spark, sf_dir))


@query("SELECT doc_id AS path, CASE WHEN doc_id % 4 > 0 AND doc_id % 5 > 0 THEN 'skipped' WHEN doc_id % 6 = 0 THEN 'failed' ELSE 'uploaded' END AS part FROM documents")
def upload_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.col("n_chars").alias("size"))
    inventory = d.filter("path % 4 > 0").withColumn("size", F.col("size") + (F.col("path") % 5 == 0).cast("int"))
    return checks.upload_parts(d, inventory, d.filter("path % 6 = 0").select("path"))


@query("SELECT doc_id AS path, n_chars AS size FROM documents WHERE doc_id % 4 = 0 OR doc_id % 5 = 0")
def to_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.col("n_chars").alias("size"))
    return checks.to_upload(d, d.filter("path % 4 > 0").withColumn("size", F.col("size") + (F.col("path") % 5 == 0).cast("int")))


@query("""WITH f AS (SELECT DISTINCT source AS prefix FROM documents WHERE doc_id % 2 = 0), w(prefix) AS (VALUES ('src1'), ('src3'), ('other')) SELECT prefix, 'missing' AS finding FROM w WHERE prefix NOT IN (SELECT prefix FROM f) UNION ALL SELECT prefix, 'unknown' FROM f WHERE prefix NOT IN (SELECT prefix FROM w)""")
def prefix_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select(F.concat(F.when(F.col("doc_id") % 2 == 0, "raw/").otherwise("elsewhere/"), "source", F.lit("/x/"), "doc_id").alias("path"))
    return checks.prefix_findings(files, "raw", ["src1", "src3", "other"])


@query("""SELECT entity_id, modality FROM (SELECT DISTINCT user_id AS entity_id FROM events), (VALUES ('view'), ('error'), ('none')) m(modality) WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = entity_id AND e.event_type = modality AND value > 60)""")
def missing_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("entity_id"), F.col("event_type").alias("modality"), "value")
    return checks.missing_folders(e, e.filter("value > 60"), ["view", "error", "none"])


@query("SELECT DISTINCT source AS entity_id FROM documents WHERE NOT regexp_full_match(replace(source, 'src1', 'e1'), 'e[0-9][0-9]') AND source NOT LIKE 'src1_'")
def not_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.when(F.length("source") == 5, F.regexp_replace("source", "^src1", "e1")).otherwise(F.col("source"))
    return checks.not_canonical(table(spark, sf_dir, "documents").select(own.alias("entity_id")))


@query("SELECT count(DISTINCT user_id) AS found, 100000 AS least FROM events")
def too_few_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.too_few(table(spark, sf_dir, "events"), "user_id", 100_000)


# -- annotations, labels --------------------------------------------------------------------------

CONVERSATION_CLASSES = ["Neutral", "Anger", "Calm", "Sadness"]


@query(f"""WITH m AS (SELECT doc_id + 1 AS "Index", {CONVERSATION_CLASSES}[CASE WHEN doc_id % 3 = 0 THEN 1 ELSE doc_id // 7 % 4 + 1 END] AS emotion, doc_id // 10 AS conversation FROM documents),
    c AS (SELECT conversation, arg_min(emotion, "Index") FILTER (emotion <> 'Neutral') AS dominant FROM m GROUP BY 1), o AS (SELECT *, row_number() OVER (PARTITION BY dominant ORDER BY conversation) AS occurrence FROM c) SELECT "Index", emotion, conversation, dominant, occurrence FROM m JOIN o USING (conversation)""")
def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.when(F.col("doc_id") % 3 == 0, 0).otherwise(F.floor(F.col("doc_id") / 7) % 4)
    meta = table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("Index"), *[(at == k).cast("int").alias(c) for k, c in enumerate(CONVERSATION_CLASSES)])
    return annotate.conversations(meta, CONVERSATION_CLASSES)


@query("""WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 7 = 1 THEN 'c' || (turn // 7 % 2) END AS label, length(text) AS v FROM conversations), f AS (SELECT *, last_value(label IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS emotion_class FROM c), d AS (SELECT * FROM f WHERE label IS NULL AND emotion_class IS NOT NULL),
    k AS (SELECT conv_id, turn, v, emotion_class, row_number() OVER (PARTITION BY conv_id, emotion_class ORDER BY turn) AS k FROM d) SELECT conv_id, turn, v, emotion_class, k FROM k WHERE k <= 5""")
def questionnaire(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("turn") % 7 == 1, F.concat(F.lit("c"), (F.floor(F.col("turn") / 7) % 2).cast("string")))
    cells = table(spark, sf_dir, "conversations").select("conv_id", "turn", label.alias("label"), F.length("text").cast("long").alias("v"))
    return annotate.questionnaire(cells, ["conv_id"], "turn", "label")


TRIAL_FLAGS = f"SELECT DISTINCT user_id % 9 AS entity_id, event_id % 6 + 1 AS trial_id, event_id // 6 % 5 AS window_id, event_type AS modality, {FLAG_SQL} AS f FROM events"
TRIAL_REPORT = f"""WITH g AS ({TRIAL_FLAGS}), m AS (SELECT entity_id, trial_id, window_id, {', '.join(f"CASE WHEN bool_or(f = 'BAD') FILTER (modality = '{m}') THEN 'BAD' WHEN bool_or(f = 'NOISY') FILTER (modality = '{m}') THEN 'NOISY' WHEN bool_or(f = 'GOOD') FILTER (modality = '{m}') THEN 'GOOD' END AS {m}_flag" for m in ("view", "click"))} FROM g GROUP BY ALL)
    SELECT entity_id, lpad(trial_id::VARCHAR, 3, '0') || '_' || lpad(window_id::VARCHAR, 2, '0') AS window_id, view_flag, click_flag, CASE WHEN (entity_id + trial_id) % 4 > 0 THEN ['Calm', 'Anger'][trial_id % 2 + 1] END AS window_emotion FROM m"""


@query(TRIAL_REPORT)
def trial_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    flags = e.select((F.col("user_id") % 9).alias("entity_id"), (F.col("event_id") % 6 + 1).cast("int").alias("trial_id"), (F.floor(F.col("event_id") / 6) % 5).cast("int").alias("window_id"), F.col("event_type").alias("modality"), flag().alias("quality_flag"))
    emotions = flags.select("entity_id", "trial_id").distinct().filter("(entity_id + trial_id) % 4 > 0").withColumn("emotion", F.when(F.col("trial_id") % 2 == 0, "Calm").otherwise("Anger"))
    return fusion.trial_report(flags, emotions, ["view", "click"])


@query(f"""WITH r AS ({TRIAL_REPORT}), f AS (SELECT event_id, user_id % 9 AS entity_id, event_id % 6 AS trial_id, event_id // 6 % 7 + 1 AS window_id FROM events) SELECT event_id, f.entity_id, trial_id, f.window_id, window_emotion FROM f JOIN r ON r.entity_id = f.entity_id AND r.window_id = lpad((trial_id + 1)::VARCHAR, 3, '0') || '_' || lpad((f.window_id - 1)::VARCHAR, 2, '0') WHERE window_emotion IS NOT NULL""")
def trial_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of a signal that counts trials from 0 and windows from 1."""
    own = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 9).alias("entity_id"), (F.col("event_id") % 6).cast("int").alias("trial_id"), (F.floor(F.col("event_id") / 6) % 7 + 1).cast("int").alias("window_id"))
    return fusion.with_trial_label(own, trial_report(spark, sf_dir), trial_shift=1)


@query(f"""WITH {E}, q AS (SELECT DISTINCT ON (user_id, window_id) user_id, window_id, {FLAG_SQL} AS f, event_type AS window_emotion FROM d WHERE window_id < 30 ORDER BY user_id, window_id, t),
    x AS (SELECT user_id, k AS part, k * 0.5 + 0.25 AS window_start_s FROM (SELECT DISTINCT user_id FROM e), range(62) r(k)) SELECT x.user_id, part, window_start_s::DOUBLE AS window_start_s, window_emotion, CASE f WHEN 'GOOD' THEN 1.0 WHEN 'NOISY' THEN 0.5 WHEN 'BAD' THEN 0.1 ELSE 0.5 END::DOUBLE AS quality FROM x LEFT JOIN q ON q.user_id = x.user_id AND q.window_id = floor(window_start_s)""")
def feature_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of half-second windows with the quality of the second that they start in; a day is a second."""
    rows = timewin.tumbling(samples(spark, sf_dir, "event_type"), F.col("t"), DAY, DAYS)
    first = rows.groupBy("user_id", "window_id").agg(F.min_by(F.struct(flag().alias("f"), "event_type"), "t").alias("x"))
    flags = first.select("user_id", (F.col("window_id") + 0.5).alias("window_start_s"), F.col("x.f").alias("flag"), F.col("x.event_type").alias("window_emotion"))
    own = rows.select("user_id").distinct().withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(61)))).withColumn("window_start_s", F.col("part") * 0.5 + 0.25)
    return fusion.with_quality(own, flags, KEYS, "flag", S.flag_score(F.col("_flag")))


@query(f"""WITH {E}, x AS (SELECT user_id AS entity_id, k AS part, (k * {DAY} * 2)::DOUBLE / 1000000 AS s FROM (SELECT DISTINCT user_id FROM e), range(15) r(k)), l AS (SELECT user_id AS entity_id, t / 1000000 AS s, event_type AS v FROM e WHERE event_type <> 'view'),
    b AS (SELECT x.entity_id, x.part, x.s, l.s AS bs, l.v AS bv FROM x ASOF LEFT JOIN l ON x.entity_id = l.entity_id AND x.s >= l.s), a AS (SELECT x.entity_id, x.part, l.s AS fs, l.v AS fv FROM x ASOF LEFT JOIN l ON x.entity_id = l.entity_id AND x.s <= l.s)
    SELECT entity_id, part, s AS window_start_s, CASE WHEN fs IS NULL THEN bv WHEN bs IS NULL THEN fv WHEN s - bs <= fs - s THEN bv ELSE fv END AS window_emotion_near FROM b JOIN a USING (entity_id, part)""")
def nearest_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir, "event_type").withColumnRenamed("user_id", "entity_id")
    labels = rows.filter("event_type <> 'view'").select("entity_id", (F.col("t") / 1_000_000).alias("window_start_s"), F.col("event_type").alias("window_emotion"))
    own = rows.select("entity_id").distinct().withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(14)))).withColumn("window_start_s", F.col("part") * 2 * DAY / 1_000_000)
    return fusion.nearest_label(own, labels)


@query("SELECT user_id FROM (SELECT DISTINCT user_id, event_type FROM events WHERE value > 40) GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT event_type) FROM events WHERE value > 40)")
def common_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion.in_all(table(spark, sf_dir, "events").filter("value > 40"), "user_id", "event_type")


@query("SELECT user_id, CASE WHEN bool_or(f = 'BAD') THEN 'BAD' WHEN bool_or(f = 'NOISY') THEN 'NOISY' ELSE 'GOOD' END AS worst FROM (SELECT user_id, CASE WHEN value > 250 THEN 'BAD' WHEN value > 150 THEN 'NOISY' ELSE 'GOOD' END AS f FROM events) GROUP BY 1")
def worst_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("value") > 250, "BAD").when(F.col("value") > 150, "NOISY").otherwise("GOOD")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(S.worst_flag(F.collect_set(flag)).alias("worst"))


# -- features -------------------------------------------------------------------------------------


@query(f"WITH {E} SELECT user_id, window_id, round(avg(c % 101), 6) AS x_mean, round(stddev_samp(c % 101), 6) AS x_std, round(avg(value), 6) AS value_mean, round(stddev_samp(value), 6) AS value_std FROM d WHERE window_id < {DAYS} GROUP BY ALL")
def moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = timewin.tumbling(samples(spark, sf_dir).withColumn("x", cents() % 101), F.col("t"), DAY, DAYS)
    return rounded(features.moments(rows, ["user_id", "window_id"], ["x", "value"]), ["x_mean", "x_std", "value_mean", "value_std"])


@query(f"WITH {E}, r AS (SELECT user_id, window_id, value - 10 AS v FROM d WHERE window_id < {DAYS} AND value > 10) SELECT user_id, window_id, round(avg(v), 6) AS hr_mean, round(stddev_samp(v), 6) AS hr_std, round(stddev_samp(60000 / v), 4) AS nn_std FROM r GROUP BY ALL")
def heart_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = timewin.tumbling(samples(spark, sf_dir).withColumn("value", F.col("value") - 10), F.col("t"), DAY, DAYS)
    return rounded(rounded(features.heart_rate(rows, ["user_id", "window_id"]), ["hr_mean", "hr_std"]), ["nn_std"], 4)


@query(f"""WITH {E}, g AS (SELECT *, value - lag(value) OVER (PARTITION BY user_id ORDER BY t) AS dd FROM e), m AS (SELECT user_id, quantile_cont(value, 0.5) AS mid FROM e GROUP BY 1)
    SELECT user_id, count(*) AS n, round(stddev_samp(value), 6) AS sdnn, round(sqrt(avg(dd * dd)), 6) AS rmssd, round(avg((abs(dd) > 50)::INT), 6) AS pnn50, round(any_value(mid), 6) AS median, round(quantile_cont(value, 0.2), 6) AS p20, round(quantile_cont(abs(value - mid), 0.5), 6) AS mad FROM g JOIN m USING (user_id) GROUP BY 1""")
def interval_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.interval_features(samples(spark, sf_dir), KEYS), ["sdnn", "rmssd", "pnn50", "median", "p20", "mad"])


@query(f"""WITH {E}, m AS (SELECT user_id, window_id AS s, avg(c) AS c, avg(value) AS value FROM d GROUP BY ALL), w AS (SELECT user_id, k + 1 AS window_id FROM (SELECT DISTINCT user_id FROM e), range(40) r(k)) SELECT w.user_id, w.window_id, round(c, 6) AS c, round(value, 6) AS value FROM w LEFT JOIN m ON m.user_id = w.user_id AND m.s = floor((w.window_id - 0.5) * 0.75)""")
def second_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir).withColumn("c", cents()).withColumn("t", F.col("t") / DAY)  # a day is a second
    return rounded(features.second_means(rows, KEYS, ["c", "value"], 0.75, F.lit(40)), ["c", "value"])


@query(f"WITH {E} SELECT user_id, k + 1 AS window_id, round(avg(value), 6) AS mean FROM e, range(10) r(k) WHERE t >= k * {2 * DAY} AND t < k * {2 * DAY} + {3 * DAY} GROUP BY ALL")
def scalar_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.scalar_means(samples(spark, sf_dir).withColumnRenamed("t", "t_us"), KEYS, 2 * DAY, 3 * DAY, 10), ["mean"])


@query(f"""WITH {E}, f AS (SELECT user_id, t / {DAY}::DOUBLE AS s, c % 3 > 0 AS success, value FROM e), w AS (SELECT *, floor(s / 1.5)::BIGINT + 1 AS window_id FROM f), r AS (SELECT user_id, unnest(range(min(window_id), max(window_id) + 1)) AS window_id FROM w GROUP BY 1)
    SELECT r.user_id, r.window_id, round(avg(value) FILTER (success), 6) AS value FROM r LEFT JOIN w USING (user_id, window_id) GROUP BY ALL""")
def face_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = samples(spark, sf_dir).select("user_id", (F.col("t") / F.lit(float(DAY))).alias("timestamp"), (cents() % 3 > 0).cast("int").alias("success"), "value")
    return rounded(features.face_means(frames, KEYS, ["value"], 1.5), ["value"])


@query("""WITH g AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS idx FROM events), s AS (SELECT *, 100 + idx / 4.0::DOUBLE AS t FROM g), b AS (SELECT user_id, round_even((user_id % 5 + 98.9 - 100) * 4, 0) AS a, round_even((108.1 - 100) * 4, 0) AS z FROM (SELECT DISTINCT user_id FROM g))
    SELECT s.user_id, idx - greatest(a, 0)::BIGINT AS idx, t, value FROM s JOIN b USING (user_id) WHERE idx >= a AND idx < z""")
def session_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = F.row_number().over(Window.partitionBy("user_id").orderBy("ts")) - 1
    rows = table(spark, sf_dir, "events").select("user_id", idx.alias("idx"), "value").withColumn("t", 100 + F.col("idx") / 4)
    sessions = rows.select("user_id").distinct().select("user_id", (F.col("user_id") % 5 + 98.9).alias("session_start_s"), F.lit(108.1).alias("session_end_s"))
    return features.session_slice(rows, KEYS, sessions, 4.0).select("user_id", "idx", "t", "value")


@query(f"WITH {E} SELECT user_id, k AS window_id, count(*) AS n, sum(c) AS c FROM e, range({DAYS}) r(k) WHERE k >= 6 AND t >= (k - 6) * {DAY} AND t < (k + 1) * {DAY} GROUP BY ALL")
def whole_lookbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = timewin.lookback(samples(spark, sf_dir).withColumn("c", cents()), F.col("t"), DAY, 7 * DAY, DAYS, whole_only=True)
    return rows.groupBy("user_id", "window_id").agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c"))


@query(f"WITH {E}, w AS (SELECT user_id, window_id, 10 + user_id % 12 AS expected FROM (SELECT DISTINCT user_id, window_id FROM d WHERE window_id < {DAYS})) SELECT user_id, window_id, expected FROM w WHERE window_id < expected")
def trimmed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = timewin.tumbling(samples(spark, sf_dir), F.col("t"), DAY, DAYS).select("user_id", "window_id").distinct()
    return timewin.trim(rows.withColumn("expected", timewin.expected_windows((10 + F.col("user_id") % 12) * 0.3, 0.3)), F.col("expected"))


EEG_X = "CASE user_id % 6 WHEN 0 THEN value * 8 WHEN 1 THEN floor(value / 40) WHEN 2 THEN value / 300 WHEN 3 THEN CASE WHEN c % 19 > 0 THEN value END ELSE value END"


@query(f"""WITH {E}, a AS (SELECT user_id, c, {EEG_X} AS x, row_number() OVER (PARTITION BY user_id ORDER BY t) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM e), b AS (SELECT *, i // 16 AS window_id FROM a WHERE (i // 16 + 1) * 16 <= n),
    l AS (SELECT user_id, window_id, max(run_length) AS max_run FROM {sql_runs("b WHERE x IS NOT NULL", "user_id, window_id", "i", "x")} GROUP BY ALL),
    m AS (SELECT user_id, window_id, count(x) AS samples, bool_or(x IS NULL) AS gone, round(stddev_pop(x), 6) AS std, round(max(x) - min(x), 4) AS peak_to_peak FROM b GROUP BY ALL)
    SELECT user_id % 7 AS entity_id, user_id AS trial, 0 AS channel, window_id, samples, std, max_run, peak_to_peak, CASE WHEN samples < 13 OR gone OR std < 0.5 OR max_run >= 5 OR peak_to_peak > 500 THEN 'BAD' ELSE 'GOOD' END AS quality_flag,
      CASE WHEN gone OR std < 0.5 THEN 'FLAT' WHEN max_run >= 5 THEN 'CLIPPING' WHEN samples < 13 OR peak_to_peak > 500 THEN 'ARTIFACT' ELSE 'NONE' END AS problem_flag FROM m JOIN l USING (user_id, window_id)""")
def eeg_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EEG flags without noise ratios; some samples are missing, flat, repeated or far apart."""
    v, u = F.col("value"), F.col("user_id")
    x = F.when(u % 6 == 0, v * 8).when(u % 6 == 1, F.floor(v / 40).cast("double")).when(u % 6 == 2, v / 300).when(u % 6 == 3, F.when(cents() % 19 > 0, v)).otherwise(v)
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("t")) - 1
    rows = samples(spark, sf_dir).select((u % 7).alias("entity_id"), u.alias("trial"), F.lit(0).alias("channel"), i.alias("t"), x.alias("value"))
    return quality.eeg(rows, ["entity_id"], 16.0, 1.0).drop("rNSR", "rNSR_zscore")


# -- statistics, models ---------------------------------------------------------------------------

RATES = f"WITH r AS (SELECT user_id, round(avg(({FLAG_SQL} <> 'GOOD')::INT) * 100, 2) AS r, avg(({FLAG_SQL} <> 'GOOD')::INT) AS rate FROM events GROUP BY 1)"


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("quality_flag", flag())


@query(f"{RATES} SELECT min(r) AS min_rate, median(r) AS median_rate, max(r) AS max_rate, count(*) AS n FROM r")
def rate_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rate_range(flagged(spark, sf_dir), KEYS)


@query(f"{RATES} SELECT round(avg(rate), 9) AS rate_mean, round(stddev_pop(rate), 9) AS rate_std, min(rate) AS rate_min, max(rate) AS rate_max, user_id % 3 AS part FROM r GROUP BY ALL")
def spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = stats.bad_rate(flagged(spark, sf_dir), KEYS).select((F.col("user_id") % 3).alias("part"), F.col("bad_rate").alias("rate"))
    return rounded(stats.spread(rates, ["rate"], ["part"]), ["rate_mean", "rate_std"], 9)


@query(f"""WITH r AS (SELECT user_id % 9 AS entity_id, event_type AS channel, avg(({FLAG_SQL} <> 'GOOD')::INT) AS x FROM events GROUP BY ALL) SELECT channel, count(*) AS n_entities, round(avg(x) * 100, 2) AS bad_rate_pct, round(stddev_pop(x) * 100, 2) AS bad_rate_std FROM r GROUP BY 1""")
def eeg_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.eeg_report(eeg_like(spark, sf_dir))["channels"]


@query(f"SELECT user_id % 9 AS entity_id, count(*) AS total_windows, count(*) FILTER ({FLAG_SQL} <> 'GOOD') AS non_good_windows, round(avg(({FLAG_SQL} <> 'GOOD')::INT) * 100, 2) AS bad_rate_pct FROM events GROUP BY 1")
def eeg_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.eeg_report(eeg_like(spark, sf_dir))["entities"]


@query("SELECT " + ", ".join(f"round(quantile_cont(value / 7, {p / 100}), 6) AS p{p}" for p in (50, 75, 90, 95, 99)) + " FROM events WHERE event_id % 5 > 0")
def eeg_noise_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.eeg_report(eeg_like(spark, sf_dir))["rNSR"]


def eeg_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(spark, sf_dir).select((F.col("user_id") % 9).alias("entity_id"), F.col("event_type").alias("channel"), "quality_flag", F.when(F.col("event_id") % 5 > 0, F.col("value") / 7).alias("rNSR"), (F.col("value") / 9).alias("rNSR_zscore"))


@query("""WITH p AS (SELECT event_type AS y, CASE WHEN event_id % 3 = 0 THEN 'view' WHEN event_id % 7 = 0 THEN 'odd' ELSE event_type END AS g FROM events), k AS (SELECT y AS c FROM p UNION SELECT g FROM p),
    s AS (SELECT c, (SELECT count(*) FROM p WHERE y = c AND g = c) AS tp, (SELECT count(*) FROM p WHERE y = c) AS sup, (SELECT count(*) FROM p WHERE g = c) AS pred FROM k), r AS (SELECT *, CASE WHEN pred > 0 THEN tp / pred::DOUBLE ELSE 0 END AS p, CASE WHEN sup > 0 THEN tp / sup::DOUBLE ELSE 0 END AS r FROM s)
    SELECT (SELECT round(avg((y = g)::INT), 4) FROM p) AS accuracy, round(avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END), 4) AS macro_f1 FROM r""")
def evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    guess = F.when(F.col("event_id") % 3 == 0, "view").when(F.col("event_id") % 7 == 0, "odd").otherwise(F.col("event_type"))
    return ml.evaluate(table(spark, sf_dir, "events").select(F.col("event_type").alias("y"), guess.alias("g")), "y", "g")


@query("""WITH e AS (SELECT user_id * 3 + event_id % 3 AS trial, event_type AS modality, event_id, CASE WHEN user_id % 5 = 0 AND event_id % 40 = 7 THEN 9 ELSE user_id % 2 END AS label FROM events WHERE event_type IN ('view', 'click')),
    g AS (SELECT trial FROM e GROUP BY 1 HAVING count(DISTINCT modality) = 2 AND count(DISTINCT label) = 1), r AS (SELECT e.*, row_number() OVER (PARTITION BY trial, modality ORDER BY event_id) - 1 AS t FROM e JOIN g USING (trial)),
    n AS (SELECT trial, min(c) AS n FROM (SELECT trial, modality, count(*) AS c FROM r GROUP BY ALL) GROUP BY 1) SELECT trial, modality, event_id, label, t FROM r JOIN n USING (trial) WHERE t < n""")
def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter("event_type in ('view', 'click')")
    label = F.when((F.col("user_id") % 5 == 0) & (F.col("event_id") % 40 == 7), 9).otherwise(F.col("user_id") % 2)
    rows = e.select((F.col("user_id") * 3 + F.col("event_id") % 3).alias("trial"), F.col("event_type").alias("modality"), "event_id", label.alias("label"))
    return ml.sequences(rows, "trial", "label", "event_id", "modality")


@query("SELECT event_type, count(*) AS n, least(greatest(1, floor(count(*) * 0.3::DOUBLE)), count(*) - 1)::BIGINT AS n_test FROM events GROUP BY 1")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split's rows are drawn by a hash, so only its sizes are compared."""
    out = stats.stratified_split(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", "event_id", 0.3, 7)
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("part") == "test").cast("long")).alias("n_test"))


@query("""WITH s AS (SELECT user_id % 8 AS entity_id, event_id % 4 AS seed, avg((value > 50)::INT) AS accuracy FROM events GROUP BY ALL) SELECT s.entity_id, s.seed, round(s.accuracy, 9) AS accuracy, round(s.accuracy - b.accuracy, 9) AS delta FROM s JOIN (SELECT * FROM s WHERE seed = 2) b USING (entity_id)""")
def seed_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 8).alias("entity_id"), (F.col("event_id") % 4).alias("seed")).agg(F.avg((F.col("value") > 50).cast("double")).alias("accuracy"))
    return rounded(pipelines.seed_deltas(scores, 2), ["accuracy", "delta"], 9)


@query("""WITH x AS (SELECT vec_id, CASE WHEN vec_id % 5 > 0 THEN embedding[1]::DOUBLE END AS a, CASE WHEN vec_id % 7 > 0 THEN embedding[2]::DOUBLE END AS b, NULL::DOUBLE AS c FROM embeddings), t AS (SELECT avg(a) AS a, avg(b) AS b FROM x WHERE vec_id % 2 = 0) SELECT vec_id, round(coalesce(x.a, t.a), 9) AS a, round(coalesce(x.b, t.b), 9) AS b, 0.0::DOUBLE AS c FROM x, t""")
def impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda k, m: F.when(F.col("vec_id") % m > 0, F.col("embedding")[k].cast("double")).when(F.col("vec_id") % 2 == 0, F.lit(float("nan")))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", part(0, 5).alias("a"), part(1, 7).alias("b"), F.lit(None).cast("double").alias("c"))
    return rounded(ml.impute(rows, rows.filter("vec_id % 2 = 0"), ["a", "b", "c"]), ["a", "b", "c"], 9)


@query("""WITH x AS (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b, 3.5::DOUBLE AS c FROM embeddings), t AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM x WHERE vec_id % 2 = 0) SELECT vec_id, round((a - ma) / sa, 6) AS a, round((b - mb) / sb, 6) AS b, 0.0::DOUBLE AS c FROM x, t""")
def scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("a"), F.col("embedding")[1].cast("double").alias("b"), F.lit(3.5).alias("c"))
    return rounded(ml.scale(rows, rows.filter("vec_id % 2 = 0"), ["a", "b", "c"]), ["a", "b", "c"])


@query("SELECT vec_id, coalesce(CASE WHEN vec_id % 3 > 0 THEN embedding[1]::DOUBLE END, 0) AS a, coalesce(CASE WHEN vec_id % 4 > 0 THEN vec_id END, 0) AS b FROM embeddings")
def numeric_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 3 > 0, F.col("embedding")[0].cast("double")).alias("a"), F.when(F.col("vec_id") % 4 > 0, F.col("vec_id")).alias("b"), F.lit("x").alias("name"))
    return ml.numeric_filled(rows, ["vec_id"])


@query("""SELECT event_id, event_type, (SELECT count(DISTINCT event_type) FROM events f WHERE f.event_type < e.event_type) AS state FROM events e""")
def dense_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml.dense_labels(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type").select("event_id", "event_type", F.col("state").cast("long").alias("state"))


@query(f"WITH {E} SELECT user_id, v AS value, run_start, run_length FROM {sql_runs('e', 'user_id', 't', 'c // 2000')} WHERE run_length > 1")
def long_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidegauge.operators import runs

    rows = samples(spark, sf_dir).withColumn("step", F.floor(cents() / 2000).cast("long"))
    return runs.islands(rows, KEYS, "t", F.col("step")).filter("run_length > 1")
