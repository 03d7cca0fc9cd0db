"""Queries over cut points, whole processing, sessions, and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from utterloom.functions import text as T
from utterloom.operators import alignment as A, dataset as D, process as P, segment, training, voices as V
from utterloom.plans.adapters import SAMPLES_SQL, WORDS_SQL, read, samples, words
from utterloom.plans.datasets import _RATED, _rated
from utterloom.registry import query

RATE = 1000


def _recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_id, rate, audio_ms, samples): a sample for each millisecond, from a formula; every tenth recording is missing.

    Recordings are in order before they get their samples, which take hundreds of times the text: no later step that
    goes by recording sorts them.
    """
    ends = words(spark, sf_dir).groupBy("file_id").agg((F.max("end_ms") + 300).alias("audio_ms")).where("file_id % 10 <> 0")
    sample = lambda i: ((i * 7919 + F.col("file_id") * 104729) % 1009 + 1) / F.lit(1024.0)
    samples = F.transform(F.sequence(F.lit(0).cast("long"), F.col("audio_ms") - 1), sample)
    return ends.sortWithinPartitions("file_id").select("file_id", F.lit(RATE).alias("rate"), "audio_ms", samples.alias("samples"))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as segments."""
    w = words(spark, sf_dir).groupBy("file_id", F.col("turn").cast("int").alias("seg_id"))
    cols = [F.min("pos").cast("int").alias("w_from"), F.max("pos").cast("int").alias("w_to"), F.count("start_ms").alias("timed")]
    return w.agg(*cols, F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("ws")).where("timed > 0").select(
        "file_id", "seg_id", "w_from", "w_to", T.joined(F.col("ws.word")).alias("text")
    )


_TIMED = rf"""g AS (SELECT file_id, turn::INT AS seg_id, min(start_ms) AS start_ms, max(end_ms) AS e, arg_max(word, pos) AS last_word,
  arg_max(start_ms, pos) FILTER (start_ms IS NOT NULL) AS ls FROM words GROUP BY ALL HAVING count(start_ms) > 0),
spans AS (SELECT file_id, seg_id, start_ms, greatest(ls, e - CASE WHEN regexp_matches(trim(last_word), '[.!?]\z') THEN 100 ELSE 50 END)::BIGINT AS end_ms FROM g),
gaps AS (SELECT *, coalesce(start_ms - lag(end_ms) OVER w < 400, false) OR coalesce(lead(start_ms) OVER w - end_ms < 400, false) AS gone FROM spans WINDOW w AS (PARTITION BY file_id ORDER BY seg_id))"""


def _cuts_sql(source: str) -> str:
    """Cut points of the segments of a table, in recordings that exist."""
    return f"""
nb AS (SELECT s.*, (row_number() OVER w - 1)::INT AS idx, lag(s.end_ms) OVER w AS pe, lead(s.start_ms) OVER w AS ns, a.n FROM {source} s
  LEFT JOIN (SELECT file_id, max(end_ms) + 300 AS n FROM words WHERE file_id % 10 <> 0 GROUP BY 1) a USING (file_id) WINDOW w AS (PARTITION BY s.file_id ORDER BY s.seg_id)),
win AS (SELECT *, greatest(0, CASE WHEN start_ms - pe < 150 THEN least(pe, start_ms - 50) ELSE start_ms - 150 END) AS sf,
  least(n, CASE WHEN ns - end_ms < 400 THEN ns ELSE end_ms + 400 END) AS et FROM nb),
ends AS (SELECT file_id, seg_id, 's' AS kind, sf AS f, start_ms AS l, greatest(sf, start_ms - 100) AS p, least(100, start_ms - sf) AS d FROM win WHERE n IS NOT NULL
  UNION ALL SELECT file_id, seg_id, 'e', end_ms, et, end_ms, least(300, et - end_ms) FROM win WHERE n IS NOT NULL),
pcs AS (SELECT *, d // 2 AS m FROM ends WHERE d >= 2),
pc AS (SELECT x.*, j, p + j * d // m AS a, p + (j + 1) * d // m AS b FROM pcs x, (SELECT unnest(range(150)) AS j) WHERE j < m),
lev AS (SELECT *, list_transform(range(a, b), lambda i: ((i * 7919 + file_id * 104729) % 1009 + 1) / 1024.0::DOUBLE) AS v FROM pc),
top AS (SELECT file_id, seg_id, kind, f, l, d, m, arg_min(struct_pack(j := j, v := v), (list_sum(list_transform(v, lambda x: x * x)) / len(v), j)) AS q FROM lev GROUP BY ALL),
hit AS (SELECT file_id, seg_id, kind, floor(least(l, greatest(f, f + q.j * d / m::DOUBLE + (list_position(q.v, list_min(q.v)) - 1) / len(q.v)::DOUBLE * 2)))::BIGINT AS ms FROM top
  UNION ALL SELECT file_id, seg_id, kind, CASE WHEN d <= 0 THEN f ELSE (f + l) // 2 END FROM ends WHERE d < 2),
cuts AS (SELECT w.file_id, w.seg_id, w.idx, w.pe, w.ns, w.sf, w.et, max(ms) FILTER (kind = 's') AS a, max(ms) FILTER (kind = 'e') AS b FROM win w LEFT JOIN hit h USING (file_id, seg_id) GROUP BY ALL)"""


@query(f"""WITH {WORDS_SQL}, {_TIMED}, {_cuts_sql('spans')}
SELECT file_id, seg_id, idx AS index, pe AS prev_word_end, ns AS next_word_start, sf::BIGINT AS start_from, et::BIGINT AS end_to, a AS cut_start_ms, b AS cut_end_ms FROM cuts WHERE a IS NOT NULL""")
def d4_cut_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = P.timed_segments(_segments(spark, sf_dir), words(spark, sf_dir))
    points = P.cut_points(timed.select("file_id", "seg_id", "start_ms", "end_ms"), _recordings(spark, sf_dir)).where("cut_start_ms IS NOT NULL")
    return points.select("file_id", "seg_id", "index", "prev_word_end", "next_word_start", "start_from", "end_to", "cut_start_ms", "cut_end_ms")


@query(f"""WITH {WORDS_SQL}, {_TIMED}, kept AS (SELECT file_id, seg_id, start_ms, end_ms FROM gaps WHERE NOT gone), {_cuts_sql('kept')}
SELECT g.file_id, g.seg_id, CASE WHEN NOT gone THEN g.file_id || '_segment_' || idx END AS name, a AS cut_start_ms, b AS cut_end_ms, (b - a)::INT AS n_samples,
  CASE WHEN gone THEN 'small gap' WHEN a IS NULL THEN 'no audio' END AS reason FROM gaps g LEFT JOIN cuts c USING (file_id, seg_id)""")
def d5_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = P.Processing(min_gap_ms=400, fade=(30, 40))
    done = P.process(_segments(spark, sf_dir), words(spark, sf_dir), _recordings(spark, sf_dir), config)
    n = F.when(F.col("samples").isNotNull(), F.size("samples"))
    return done.select("file_id", "seg_id", "name", "cut_start_ms", "cut_end_ms", n.alias("n_samples"), "reason")


@query(f"""WITH {WORDS_SQL}, {_TIMED}, kept AS (SELECT * FROM gaps WHERE NOT gone)
SELECT file_id, seg_id, (row_number() OVER w - 1)::INT AS index, lag(end_ms) OVER w AS prev_word_end, lead(start_ms) OVER w AS next_word_start FROM kept WINDOW w AS (PARTITION BY file_id ORDER BY seg_id)""")
def j5_adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = segment.min_gap(P.timed_segments(_segments(spark, sf_dir), words(spark, sf_dir)), 400).where("kept")
    return P.neighbours(timed).select("file_id", "seg_id", "index", "prev_word_end", "next_word_start")


@query(f"""WITH {WORDS_SQL}, {_TIMED}, {_cuts_sql('spans')}
SELECT file_id, seg_id, greatest(pe, a) - pe AS from_previous_ms, a - sf AS from_search_ms, s.start_ms - a AS to_first_word_ms, b - s.end_ms AS from_last_word_ms, b - a AS length_ms
FROM cuts JOIN spans s USING (file_id, seg_id) WHERE a IS NOT NULL""")
def k9_cut_point_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = P.timed_segments(_segments(spark, sf_dir), words(spark, sf_dir)).select("file_id", "seg_id", "start_ms", "end_ms")
    p, c = P.cut_points(timed, _recordings(spark, sf_dir)).where("cut_start_ms IS NOT NULL"), F.col
    before = F.when(c("prev_word_end").isNotNull(), F.greatest("prev_word_end", "cut_start_ms") - c("prev_word_end"))
    return p.select(
        "file_id", "seg_id", before.alias("from_previous_ms"), (c("cut_start_ms") - c("start_from")).alias("from_search_ms"),
        (c("start_ms") - c("cut_start_ms")).alias("to_first_word_ms"), (c("cut_end_ms") - c("end_ms")).alias("from_last_word_ms"),
        (c("cut_end_ms") - c("cut_start_ms")).alias("length_ms"),
    )


@query("""WITH a AS (SELECT vec_id AS file_id, embedding::DOUBLE[] AS s, vec_id % 50 AS a, vec_id % 50 + vec_id % 17 AS b FROM embeddings)
SELECT file_id, len(s[a + 1 : b])::INT AS n, round(coalesce(list_sum(s[a + 1 : b]), 0), 6) AS total FROM a""")
def j7_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("file_id"), F.lit(RATE).alias("rate"), F.col("embedding").cast("array<double>").alias("samples"))
    s = e.select("file_id", (F.col("file_id") % 50).alias("start_ms"), (F.col("file_id") % 50 + F.col("file_id") % 17).alias("end_ms"))
    total = F.aggregate("samples", F.lit(0.0), lambda x, y: x + y)
    return P.slices(s, e).select("file_id", F.size("samples").alias("n"), F.round(total, 6).alias("total"))


@query("""SELECT o_orderkey AS run, o_custkey % 3 = 0 OR o_custkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 > 8 OR o_custkey % 13 = 0 AS wanted FROM orders""")
def f15_effects_wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, k = read(spark, sf_dir, "orders"), F.col("o_custkey"), F.col("o_orderkey")
    config = o.select(
        k.alias("run"), F.when(c % 3 == 0, 16).alias("normalize"), F.when(c % 5 == 0, "male").alias("compress"), F.when(k % 7 == 0, True).alias("dess"),
        F.lit(None).cast("boolean").alias("denoise"), F.lit(False).alias("trim"), F.when(k % 11 > 8, 30).otherwise(0).alias("fade_in"), F.when(c % 13 == 0, 40).otherwise(0).alias("fade_out"),
    )
    return config.select("run", P.effects_wanted(config).alias("wanted"))


# a third of the lines lacks its last field
_LINES = """lines AS (SELECT p_partkey AS line, 'f' || (p_partkey % 97) AS audio, p_name AS t, p_partkey % 3 = 0 AS short FROM part)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    audio = F.concat(F.lit("f"), (F.col("p_partkey") % 97).cast("string"))
    fields = F.concat_ws("|", audio, "p_name", F.when(F.col("p_partkey") % 3 != 0, "001"))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("line"), fields.alias("value"))


@query(f"""WITH {_LINES}, l AS (SELECT DISTINCT 'f' || (s_suppkey % 61) AS audio FROM supplier)
SELECT line, audio AS audio_file, t AS text, CASE WHEN audio IN (SELECT audio FROM l) THEN 'kept' ELSE 'missing' END AS state FROM lines WHERE NOT short""")
def s8_metadata_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = read(spark, sf_dir, "supplier").select(F.concat(F.lit("f"), (F.col("s_suppkey") % 61).cast("string")).alias("audio_file"))
    kept, missing = D.existing(D.parsed_metadata(_lines(spark, sf_dir)), known)
    of = lambda df, state: df.select("line", "audio_file", "text", F.lit(state).alias("state"))
    return of(kept, "kept").unionByName(of(missing, "missing"))


@query("""SELECT o_custkey AS session, arg_min('f' || o_orderkey, o_orderkey) FILTER (o_orderkey % 3 <> 0) AS audio_file FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderkey % 3 <> 0) > 0""")
def s9_first_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.when(F.col("o_orderkey") % 3 == 0, "  ").otherwise(F.concat(F.lit("f"), F.col("o_orderkey").cast("string")))
    rows = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("session"), F.col("o_orderkey").alias("line"), path.alias("audio_file"))
    return D.first_path(rows, "session", "line")


@query("SELECT o_custkey AS session, greatest(0, count(*) - 1)::BIGINT AS n FROM orders GROUP BY 1")
def s10_dataset_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("session"), F.col("o_orderpriority").alias("value"))
    return D.sizes(lines, "session")


@query("""WITH k AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '/abs/' || p_partkey ELSE '/s/r' || p_partkey END AS path, trim(' ' || p_name || '  ') AS t FROM part),
r AS (SELECT *, row_number() OVER (ORDER BY md5('17|' || path), path) AS place, count(*) OVER () AS n FROM k)
SELECT CASE WHEN place <= floor(0.8::DOUBLE * n) THEN 'train' ELSE 'eval' END AS split, path || '|' || t || '|001' AS value FROM r""")
def k1_metadata_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("/abs/"), F.col("p_partkey").cast("string"))).otherwise(F.concat(F.lit("r"), F.col("p_partkey").cast("string")))
    rows = read(spark, sf_dir, "part").select(path.alias("audio_file"), F.concat(F.lit(" "), "p_name", F.lit("  ")).alias("text"), F.lit("001").alias("speaker_name"))
    return D.metadata_lines(rows, "/s")


_SESSION = """m AS (SELECT o_custkey AS session, o_orderkey || '.wav' AS name, o_orderkey % 100 AS size, CASE WHEN o_orderkey % 2 = 0 THEN '/s/old/audio/' ELSE '/elsewhere/' END || o_orderkey || '.wav' AS path FROM orders)"""


def _session(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.col("o_orderkey").cast("string"), F.lit(".wav"))
    path = F.concat(F.when(F.col("o_orderkey") % 2 == 0, "/s/old/audio/").otherwise("/elsewhere/"), name)
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("session"), name.alias("name"), (F.col("o_orderkey") % 100).alias("size"), path.alias("path"))


@query(f"""WITH {_SESSION} SELECT name, size, CASE WHEN starts_with(path, '/s/old/') THEN '/s/new' || substr(path, 7) ELSE '/s/new/audio_sources/processed/' || name END AS path FROM m""")
def k8_session_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.session_copy(_session(spark, sf_dir), "/s/old", "/s/new")


@query(f"""WITH {_SESSION}, c AS (SELECT session, name, size + CASE WHEN size % 41 = 0 THEN 1 ELSE 0 END AS sb FROM m WHERE size % 37 <> 5)
SELECT m.session, count(*) AS n, count(*) FILTER (sb IS NULL) AS n_missing, count(*) FILTER (sb <> size) AS n_changed, count(*) FILTER (sb IS NULL OR sb <> size) = 0 AS ok
FROM m LEFT JOIN c ON c.session = m.session AND c.name = m.name GROUP BY m.session""")
def x7_session_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _session(spark, sf_dir)
    copy = m.where("size % 37 <> 5").withColumn("size", F.col("size") + F.when(F.col("size") % 41 == 0, 1).otherwise(0))
    return D.verified(m, copy, "session")


@query(f"""WITH {_RATED}, z AS (SELECT voice, sample, row_number() OVER (PARTITION BY voice ORDER BY size DESC, sample) AS p FROM rated), t AS (SELECT * FROM z WHERE p <= 4)
SELECT voice, sample, voice || CASE WHEN p = 1 THEN '' WHEN p = 2 THEN '_fast' ELSE '_dynamic_' || p END || '.wav' AS name FROM t""")
def k10_reference_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = V.ranked(_rated(spark, sf_dir), "voice", [F.desc("size"), F.col("sample")]).where("place <= 4")
    role = F.when(F.col("place") == 1, "basic").when(F.col("place") == 2, "fast").otherwise("dynamic")
    return picked.select("voice", "sample", D.reference_name(F.col("voice"), role, F.col("place")).alias("name"))


@query("""WITH f AS (SELECT o_custkey AS run, list('w' || o_orderkey || CASE WHEN o_orderkey % 4 = 0 THEN '.dvae.x' ELSE '.gpt' END ORDER BY o_orderkey) AS w FROM orders GROUP BY 1)
SELECT run, len(w)::INT AS n, array_to_string(list_filter(w, lambda x: x NOT LIKE '%dvae%'), ',') AS kept FROM f""")
def k12_pruned_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("w"), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 4 == 0, ".dvae.x").otherwise(".gpt"))
    f = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("run")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", name.alias("w")))).alias("x"))
    return f.select("run", F.size("x").alias("n"), F.array_join(training.pruned(F.col("x.w")), ",").alias("kept"))


@query("""SELECT o_orderkey AS name, 'v' || (o_custkey % 50) AS folder, CASE WHEN EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey % 40 = o_custkey % 50) THEN 'copied' ELSE 'skipped' END AS state FROM orders""")
def k11_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = lambda c, n: F.concat(F.lit("v"), (F.col(c) % n).cast("string")).alias("folder")
    files = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("name"), folder("o_custkey", 50))
    return training.publishable(files, read(spark, sf_dir, "supplier").select(folder("s_suppkey", 40))).select("name", "folder", "state")


@query("""WITH a AS (SELECT l_orderkey AS doc, l_linenumber AS seg, CASE WHEN (l_orderkey + l_linenumber) % 4 <> 0 THEN l_discount * 10 END AS ctc, (l_orderkey % 11) / 10.0::DOUBLE AS retrieval,
  CASE WHEN l_orderkey % 5 = 0 THEN 1.0 ELSE least(1 + l_linenumber % 3, l_orderkey % 5) / (l_orderkey % 5)::DOUBLE END AS covered, l_orderkey % 5 AS reference FROM lineitem),
s AS (SELECT *, round(ctc * 0.75::DOUBLE + retrieval * 0.15::DOUBLE + covered * 0.1::DOUBLE, 9) AS score FROM a),
b AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY score DESC NULLS LAST, seg) AS r, count(*) FILTER (ctc IS NULL) OVER (PARTITION BY doc) AS n_failed FROM s)
SELECT doc, CASE WHEN score IS NOT NULL THEN seg END AS attempt, round(score, 6) AS score, n_failed, CASE WHEN score IS NULL THEN 'failed'
  WHEN ctc >= 0.5::DOUBLE AND (reference = 0 OR covered >= 0.35::DOUBLE) THEN 'accepted' ELSE 'rejected' END AS state FROM b WHERE r = 1""")
def x3_alignment_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    a = read(spark, sf_dir, "lineitem").select(
        k.alias("doc"), n.alias("seg"), F.when((k + n) % 4 != 0, F.col("l_discount") * 10).alias("ctc"), ((k % 11) / F.lit(10.0)).alias("retrieval"),
        (1 + n % 3).alias("aligned"), (k % 5).alias("reference"),
    )
    return A.run(a, "doc", "seg").withColumn("score", F.round("score", 6))


@query("""SELECT l_orderkey AS doc, l_linenumber AS seg, round((l_discount * 10) * 0.75::DOUBLE + (l_orderkey % 11) / 10.0::DOUBLE * 0.15::DOUBLE + l_tax * 10 * 0.1::DOUBLE, 6) AS combined FROM lineitem""")
def a7_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = A.combined(F.col("l_discount") * 10, (F.col("l_orderkey") % 11) / F.lit(10.0), F.col("l_tax") * 10)
    return read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("seg"), F.round(score, 6).alias("combined"))


@query(f"""WITH {SAMPLES_SQL} SELECT voice, count(pitch) AS n, round(coalesce(stddev_pop(pitch) / nullif(avg(pitch), 0), 0), 6) AS variation FROM samples GROUP BY voice""")
def a11_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.variation(samples(spark, sf_dir), "voice", "pitch").withColumn("variation", F.round("variation", 6))


@query("""WITH c AS (SELECT user_id AS session, event_type AS file, count(*) AS n FROM events GROUP BY ALL)
SELECT *, sum(n) OVER (PARTITION BY session ORDER BY file ROWS UNBOUNDED PRECEDING)::BIGINT AS total FROM c""")
def a15_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.running_totals(read(spark, sf_dir, "events").select(F.col("user_id").alias("session"), F.col("event_type").alias("file")), "session", "file")


@query("""SELECT o_orderkey AS run, CASE WHEN o_custkey % 12 + o_orderkey % 12 = 10 AND o_orderkey % 9 <> 0 THEN (o_custkey % 12) / 10.0::DOUBLE END AS proportion FROM orders""")
def t6_proportion(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.concat((F.col("o_custkey") % 12).cast("string"), F.when(F.col("o_orderkey") % 9 == 0, "-").otherwise("_"), (F.col("o_orderkey") % 12).cast("string"))
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run"), T.proportion(value).alias("proportion"))


@query("""SELECT o_orderkey AS run, 's' || o_custkey || '__' || strftime(o_orderdate, '%y_%m_%d') || '__' || strftime(o_orderdate, '%H_%M') || '__e' || (1 + o_custkey % 24) || '__g' || (1 + o_orderkey % 4) AS name FROM orders""")
def t16_session_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.concat(F.lit("s"), F.col("o_custkey").cast("string"))
    name = D.session_name(old, F.col("o_orderdate"), 1 + F.col("o_custkey") % 24, 1 + F.col("o_orderkey") % 4)
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run"), name.alias("name"))


@query("SELECT o_orderkey AS run, round((o_custkey * 7 + o_orderkey % 1000) / 60.0::DOUBLE, 2) AS minutes FROM orders")
def t20_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run"), T.minutes(F.col("o_custkey") * 7 + F.col("o_orderkey") % 1000).alias("minutes"))


@query("SELECT o_orderkey AS run, floor((o_custkey % 24 + 0.25::DOUBLE + 0.5) * (16000 + 50 * (o_orderkey % 200)))::BIGINT AS max_wav FROM orders")
def t21_max_wav(spark: SparkSession, sf_dir: str) -> DataFrame:
    wav = training.max_wav_length(F.col("o_custkey") % 24 + F.lit(0.25), 16000 + 50 * (F.col("o_orderkey") % 200))
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run"), wav.alias("max_wav"))


@query("""WITH l AS (SELECT DISTINCT 'p' || (s_suppkey % 83) AS path FROM supplier), p AS (SELECT p_partkey, 'p' || (p_partkey % 211) AS a, 'p' || (p_partkey % 97) AS b, 'p' || (p_partkey % 89) AS c FROM part)
SELECT p_partkey, CASE WHEN a IN (SELECT path FROM l) THEN a WHEN b IN (SELECT path FROM l) THEN b WHEN c IN (SELECT path FROM l) THEN c ELSE a END AS resolved FROM p""")
def j10_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda c, n: F.concat(F.lit("p"), (F.col(c) % n).cast("string"))
    p = read(spark, sf_dir, "part").select("p_partkey", name("p_partkey", 211).alias("a"), name("p_partkey", 97).alias("b"), name("p_partkey", 89).alias("c"))
    listing = read(spark, sf_dir, "supplier").select(name("s_suppkey", 83).alias("path"))
    return D.resolve(p, listing, ["a", "b", "c"]).select("p_partkey", "resolved")


@query("""SELECT conv_id, turn, coalesce(CASE WHEN conv_id % 3 = 0 THEN 'aligned:' || turn END, CASE WHEN turn % 2 = 0 THEN 'asr:' || turn END, 'second:' || turn) AS result FROM conversations""")
def x2_recognised(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = lambda by: F.concat(F.lit(by + ":"), F.col("turn").cast("string"))
    sources = [F.when(F.col("conv_id") % 3 == 0, made("aligned")), F.when(F.col("turn") % 2 == 0, made("asr")), made("second")]
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", P.recognised(sources).alias("result"))
