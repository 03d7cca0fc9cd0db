"""Queries over alignments, manifests, splits, training runs and voices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from utterloom.functions import text as T
from utterloom.operators import alignment as A, dataset as D, training, voices as V
from utterloom.plans.adapters import ALIGNMENT_SQL, SAMPLES_SQL, alignment, read, samples
from utterloom.registry import query


@query(f"WITH {ALIGNMENT_SQL} SELECT doc, count(*) AS n, round(least(1, greatest(0, (avg(score) + median(score)) / 2)), 6) AS score FROM alignment GROUP BY doc")
def a5_alignment_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.scores(alignment(spark, sf_dir), "doc").withColumn("score", F.round("score", 6))


_ATTEMPTS = f"""{ALIGNMENT_SQL},
c AS (SELECT doc, seg, score, 1 + seg % 3 AS aligned, doc % 5 AS reference, (doc % 11) / 10.0::DOUBLE AS retrieval FROM alignment),
a AS (SELECT *, CASE WHEN reference <= 0 THEN 1.0 ELSE least(aligned, reference) / reference::DOUBLE END AS covered FROM c),
x AS (SELECT *, score * 0.75::DOUBLE + retrieval * 0.15::DOUBLE + covered * 0.1::DOUBLE AS combined FROM a)"""


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = alignment(spark, sf_dir).select("doc", "seg", "score", (1 + F.col("seg") % 3).alias("aligned"), (F.col("doc") % 5).alias("reference"), ((F.col("doc") % 11) / F.lit(10.0)).alias("retrieval"))
    a = a.withColumn("covered", A.coverage(F.col("aligned"), F.col("reference")))
    return a.withColumn("combined", A.combined(F.col("score"), F.col("retrieval"), F.col("covered")))


@query(f"WITH {_ATTEMPTS} SELECT doc, seg, round(covered, 6) AS coverage FROM x")
def a6_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attempts(spark, sf_dir).select("doc", "seg", F.round("covered", 6).alias("coverage"))


@query(f"""WITH {_ATTEMPTS} SELECT doc, seg, round(combined, 6) AS combined FROM
(SELECT *, row_number() OVER (PARTITION BY doc ORDER BY round(combined, 9) DESC, seg) AS r FROM x) WHERE r = 1""")
def a8_best_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _attempts(spark, sf_dir).withColumn("rounded", F.round("combined", 9))
    return A.best_attempt(a, "doc", "seg", "rounded").select("doc", "seg", F.round("combined", 6).alias("combined"))


@query(f"WITH {_ATTEMPTS} SELECT doc, seg, score >= 0.5::DOUBLE AND (reference = 0 OR covered >= 0.35::DOUBLE) AS accepted FROM x")
def f12_confidence_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gate = A.accepted(F.col("score"), F.col("covered"), F.col("reference") > 0)
    return _attempts(spark, sf_dir).select("doc", "seg", gate.alias("accepted"))


@query(f"""WITH {ALIGNMENT_SQL} SELECT doc, string_agg(text, ' ' ORDER BY seg, text, score) AS text,
string_agg(text || '@' || round(score, 6)::VARCHAR, ',' ORDER BY seg, text, score) AS words FROM alignment GROUP BY doc""")
def f14_to_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.struct("seg", "text", F.lit(None).cast("double").alias("start"), F.lit(None).cast("double").alias("end"), F.round("score", 6).alias("score"))
    d = alignment(spark, sf_dir).groupBy("doc").agg(F.array_sort(F.collect_list(s)).alias("segments"))
    d = d.select("doc", A.to_words(F.col("segments")).alias("w"))
    shown = F.transform("w", lambda w: F.concat(w["word"], F.lit("@"), w["score"].cast("string")))
    return d.select("doc", F.array_join(F.col("w.word"), " ").alias("text"), F.array_join(shown, ",").alias("words"))


@query(r"""WITH x AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+(?:[-''][\p{L}\p{N}_]+)*') AS l FROM conversations),
y AS (SELECT conv_id, turn, CASE WHEN len(l) <= 40 THEN l ELSE list_concat(l[1:20], l[-20:]) END AS l FROM x)
SELECT conv_id, turn, conv_id % 4 AS level, len(l)::BIGINT AS n, md5(array_to_string(l, ' ')) AS words_md5 FROM y""")
def t18_query_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    level, none_w = F.col("conv_id") % 4, F.lit(None)
    word = F.struct(F.col("text").alias("word"))
    seg = F.struct(F.when(level == 2, F.col("text")).alias("text"), F.when(level == 1, F.array(word)).alias("words"))
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", level.alias("level"), F.when(level == 0, F.array(word)).alias("ws"), F.when(level.isin(1, 2), F.array(seg)).alias("segs"), F.when(level == 3, F.col("text")).otherwise(none_w).alias("t"))
    words = A.query_words(F.col("ws"), F.col("segs"), F.col("t"), most=40)
    return c.select("conv_id", "turn", "level", F.size(words).cast("long").alias("n"), F.md5(F.array_join(words, " ")).alias("words_md5"))


_SPLIT = """k AS (SELECT o_orderkey AS id, md5('17|' || o_orderkey::VARCHAR) AS h FROM orders)"""


@query(f"""WITH {_SPLIT}, r AS (SELECT id, row_number() OVER (ORDER BY h, id) AS place, count(*) OVER () AS n FROM k)
SELECT id, CASE WHEN place <= floor(0.8::DOUBLE * n) THEN 'train' ELSE 'eval' END AS split FROM r""")
def o10_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.split(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), "id").select("id", "split")


_FILES = """files AS (SELECT doc_id, source || '/' || lang || '/chapter' || (doc_id % 60) || CASE WHEN doc_id % 3 = 0 THEN '.wav' ELSE '.mp3' END AS rel FROM documents),
one AS (SELECT min(doc_id) AS doc_id, rel FROM files GROUP BY rel)"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = F.concat("source", F.lit("/"), "lang", F.lit("/chapter"), (F.col("doc_id") % 60).cast("string"), F.when(F.col("doc_id") % 3 == 0, ".wav").otherwise(".mp3"))
    return read(spark, sf_dir, "documents").groupBy(rel.alias("rel")).agg(F.min("doc_id").alias("doc_id"))


@query(rf"""WITH {_FILES}, s AS (SELECT rel, regexp_replace(regexp_extract(rel, '[^/]*\z'), '\.[^.]*\z', '') AS stem FROM one),
k AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY lower(rel), rel) AS k FROM s),
n AS (SELECT *, CASE WHEN k = 1 THEN stem ELSE stem || '__' || left(sha1(rel), 8) END AS name FROM k),
a AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY lower(rel), rel) AS a FROM n)
SELECT rel, stem, CASE WHEN a = 1 THEN name ELSE name || '_' || a END AS out_stem FROM a""")
def t10_dedupe_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.output_stems(_files(spark, sf_dir)).select("rel", "stem", "out_stem")


@query(r"""WITH p AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '/s/old/audio/' WHEN 1 THEN 'audio_sources/' ELSE '/elsewhere/' END || lang || doc_id || '.wav' AS path FROM documents)
SELECT doc_id, path, CASE WHEN starts_with(path, '/s/old/') THEN '/s/new' || substr(path, 7)
  ELSE '/s/new/audio_sources/processed/' || regexp_extract(path, '[^/]*\z') END AS moved FROM p""")
def t15_path_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.when(F.col("doc_id") % 3 == 0, "/s/old/audio/").when(F.col("doc_id") % 3 == 1, "audio_sources/").otherwise("/elsewhere/")
    p = read(spark, sf_dir, "documents").select("doc_id", F.concat(head, "lang", F.col("doc_id").cast("string"), F.lit(".wav")).alias("path"))
    return p.select("doc_id", "path", T.rewritten(F.col("path"), "/s/old", "/s/new").alias("moved"))


@query("""WITH s AS (SELECT p_partkey AS id, 'f' || (p_partkey % 97) AS audio_file, CASE WHEN p_size % 7 = 0 THEN '  ' ELSE ' ' || p_name || ' ' END AS text FROM part),
l AS (SELECT DISTINCT 'f' || (s_suppkey % 61) AS audio_file FROM supplier)
SELECT id, audio_file, trim(text) AS text FROM s WHERE trim(text) <> '' AND audio_file IN (SELECT audio_file FROM l)""")
def f9_valid_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda c, n: F.concat(F.lit("f"), (F.col(c) % n).cast("string")).alias("audio_file")
    s = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), name("p_partkey", 97), F.when(F.col("p_size") % 7 == 0, "  ").otherwise(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("text"))
    return D.valid_samples(s, read(spark, sf_dir, "supplier").select(name("s_suppkey", 61))).select("id", "audio_file", "text")


@query("""WITH l AS (SELECT p_partkey, 'f' || (p_partkey % 97) AS name FROM part), r AS (SELECT 'f' || (l_partkey % 89) AS name, l_orderkey * 10 + l_linenumber AS ord, l_quantity AS q FROM lineitem),
k AS (SELECT name, min(ord) AS ord, arg_min(q, ord) AS q FROM r GROUP BY name) SELECT p_partkey, name, ord, q FROM l JOIN k USING (name)""")
def j2_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda c, n: F.concat(F.lit("f"), (F.col(c) % n).cast("string")).alias("name")
    left = read(spark, sf_dir, "part").select("p_partkey", name("p_partkey", 97))
    right = read(spark, sf_dir, "lineitem").select(name("l_partkey", 89), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.col("l_quantity").alias("q"))
    return D.first_match(left, right, "name", "ord").select("p_partkey", "name", "ord", "q")


_MANIFESTS = """a AS (SELECT o_custkey AS name, count(*) AS size FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
b AS (SELECT o_custkey AS name, count(*) AS size FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)"""


@query(f"""WITH {_MANIFESTS} SELECT coalesce(a.name, b.name) AS name, CASE WHEN b.name IS NULL THEN 'missing' WHEN a.name IS NULL THEN 'extra'
WHEN a.size = b.size THEN 'same' ELSE 'changed' END AS state FROM a FULL JOIN b ON a.name = b.name""")
def j6_manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    of = lambda s: o.where(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("name")).agg(F.count("*").alias("size"))
    return D.manifest_diff(of("F"), of("O"))


@query("""WITH s AS (SELECT o_custkey AS session, count(*) AS n_wavs, sum((o_orderstatus = 'F')::INT) AS train_lines, sum((o_orderstatus = 'O')::INT) AS eval_lines,
  bool_or(o_orderpriority LIKE '1%') AS has_csvs, bool_or(o_totalprice > 100000) AS has_processed FROM orders GROUP BY 1)
SELECT session, CASE WHEN NOT has_csvs THEN 'no metadata' WHEN NOT has_processed THEN 'no processed folder' WHEN n_wavs < 1 THEN 'no audio'
WHEN train_lines < 2 OR eval_lines < 2 THEN 'no samples' ELSE 'ok' END AS reason FROM s""")
def f18_reusable_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lambda s: F.sum((F.col("o_orderstatus") == s).cast("int"))
    s = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("session")).agg(
        F.count("*").alias("n_wavs"), lines("F").alias("train_lines"), lines("O").alias("eval_lines"),
        F.bool_or(F.col("o_orderpriority").like("1%")).alias("has_csvs"), F.bool_or(F.col("o_totalprice") > 100000).alias("has_processed"),
    )
    return D.reusable(s.withColumn("has_dir", F.lit(True))).select("session", "reason")


@query("""WITH r AS (SELECT o_orderkey AS run, floor(o_totalprice / 10)::BIGINT AS n, 1 + o_custkey % 8 AS batch, 1 + o_orderkey % 4 AS accum, 1 + o_custkey % 24 AS epochs FROM orders),
s AS (SELECT *, n // (batch * accum) AS per_epoch, (n // (batch * accum)) * epochs AS total FROM r)
SELECT run, per_epoch, total, array_to_string(list_transform(CASE WHEN epochs <= 10 THEN [0.7::DOUBLE, 0.9] ELSE [0.25::DOUBLE, 0.6, 0.8] END, lambda p: floor(total * p)::BIGINT), ',') AS milestones,
CASE WHEN epochs <= 10 THEN total ELSE 3 * per_epoch END AS t0, CASE WHEN epochs <= 10 THEN 1 ELSE 2 END::INT AS t_mult,
floor((epochs + 0.5::DOUBLE) * 22050)::BIGINT AS max_wav FROM s""")
def t22_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run"), F.floor(F.col("o_totalprice") / 10).cast("long").alias("n"), (1 + F.col("o_custkey") % 8).alias("batch"), (1 + F.col("o_orderkey") % 4).alias("accum"), (1 + F.col("o_custkey") % 24).alias("epochs"))
    r = r.withColumn("per_epoch", training.steps_per_epoch(F.col("n"), F.col("batch"), F.col("accum"))).withColumn("total", F.col("per_epoch") * F.col("epochs"))
    cos = training.cosine(F.col("total"), F.col("per_epoch"), F.col("epochs"), F.lit(5e-6))
    marks = F.array_join(training.milestones(F.col("total"), F.col("epochs")).cast("array<string>"), ",")
    return r.select("run", "per_epoch", "total", marks.alias("milestones"), cos["t0"].alias("t0"), cos["t_mult"].alias("t_mult"), training.max_wav_length(F.col("epochs"), F.lit(22050)).alias("max_wav"))


@query("""WITH f AS (SELECT o_custkey AS run, '/run/' || (o_orderkey % 3) || '/best_model_' || o_orderkey || CASE WHEN o_orderkey % 5 = 0 THEN '.txt' ELSE '.pth' END AS path, o_orderkey FROM orders),
g AS (SELECT *, regexp_replace(path, '/[^/]*$', '') AS folder FROM f WHERE path LIKE '%.pth'), m AS (SELECT run, min(folder) AS folder FROM g GROUP BY run)
SELECT run, arg_max(path, o_orderkey) AS path, max(o_orderkey) AS step FROM g JOIN m USING (run, folder) GROUP BY run""")
def a14_best_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("/run/"), (F.col("o_orderkey") % 3).cast("string"), F.lit("/best_model_"), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 5 == 0, ".txt").otherwise(".pth"))
    return training.best_checkpoint(read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run"), path.alias("path")))


# --- voices
_RATED = f"{SAMPLES_SQL}, rated AS (SELECT *, length(text) / (duration_ms / 1000.0::DOUBLE) AS rate FROM samples WHERE duration_ms > 0)"


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = samples(spark, sf_dir).where("duration_ms > 0")
    return s.withColumn("rate", V.speech_rate(F.col("text"), F.col("duration_ms") / F.lit(1000.0)))


@query(r"""SELECT doc_id, regexp_matches(substr(text, 1, 1), '^\p{Lu}') AND regexp_matches(text, '[.!?](["'')]|\)"|\)''|"\)|''\)|\)\.)?\z') AS complete FROM documents""")
def f10_sentence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", T.complete_sentence(F.col("text")).alias("complete"))


@query(f"""WITH {_RATED}, k AS (SELECT voice, pitch, row_number() OVER (PARTITION BY voice ORDER BY pitch) - 1 AS i, count(*) OVER (PARTITION BY voice) AS n FROM rated)
SELECT voice, n, max(pitch) FILTER (i = least(n - 1, floor(0.1::DOUBLE * n))) AS low, max(pitch) FILTER (i = least(n - 1, floor(0.9::DOUBLE * n))) AS high FROM k GROUP BY voice, n""")
def a12_index_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.index_percentiles(_rated(spark, sf_dir), "voice", "pitch")


@query(f"""WITH {_RATED}, k AS (SELECT *, row_number() OVER (PARTITION BY voice ORDER BY size DESC, sample) AS place, count(*) OVER (PARTITION BY voice) AS n FROM rated)
SELECT voice, sample, place::INT AS place FROM k WHERE place <= greatest(1, floor(0.1::DOUBLE * n))""")
def o4_top_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.top_share(_rated(spark, sf_dir), "voice", "size", "sample", 0.1, 1).select("voice", "sample", "place")


@query(f"""WITH {_RATED}, z AS (SELECT *, count(*) OVER (PARTITION BY voice) AS n, row_number() OVER (PARTITION BY voice ORDER BY size DESC, sample) AS big,
  row_number() OVER (PARTITION BY voice ORDER BY pitch, sample) AS lo, row_number() OVER (PARTITION BY voice ORDER BY pitch DESC, sample DESC) AS hi,
  row_number() OVER (PARTITION BY voice ORDER BY rate) - 1 AS ri FROM rated),
fast AS (SELECT voice, arg_min(sample, (-rate, sample)) AS s FROM z WHERE big <= floor(0.7::DOUBLE * n) GROUP BY voice),
low AS (SELECT z.voice, arg_min(sample, lo) AS s FROM z LEFT JOIN fast f ON f.voice = z.voice AND f.s = z.sample WHERE lo > floor(0.1::DOUBLE * n) AND f.s IS NULL GROUP BY z.voice),
edge AS (SELECT voice, max(rate) AS e FROM z WHERE ri = least(n - 1, floor(0.1::DOUBLE * n)) GROUP BY voice),
slow AS (SELECT z.voice, arg_min(sample, (rate, sample)) AS s FROM z JOIN edge USING (voice) WHERE rate >= e
  AND NOT EXISTS (SELECT 1 FROM (SELECT * FROM fast UNION ALL SELECT * FROM low) p WHERE p.voice = z.voice AND p.s = z.sample) GROUP BY z.voice),
high AS (SELECT z.voice, arg_min(sample, hi) AS s FROM z WHERE n >= 4 AND hi > floor(0.1::DOUBLE * n)
  AND NOT EXISTS (SELECT 1 FROM (SELECT * FROM fast UNION ALL SELECT * FROM low UNION ALL SELECT * FROM slow) p WHERE p.voice = z.voice AND p.s = z.sample) GROUP BY z.voice)
SELECT voice, 'fast' AS role, s AS sample FROM fast UNION ALL SELECT voice, 'low', s FROM low UNION ALL SELECT voice, 'slow', s FROM slow UNION ALL SELECT voice, 'high', s FROM high""")
def o5_extended_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.extended_picks(_rated(spark, sf_dir))


_DYNAMIC = f"""{_RATED}, c AS (SELECT *, length(text) - length(replace(text, '?', '')) AS q, length(text) - length(replace(text, '!', '')) AS x, length(text) - length(replace(text, '.', '')) AS d FROM rated),
m AS (SELECT *, round(pitch / 280.0::DOUBLE * 0.3::DOUBLE + rate / 30 * 0.3::DOUBLE + (size % 10) / 10.0::DOUBLE * 0.25::DOUBLE
  + ((q + x + d) / length(text)::DOUBLE * 10 + (CASE WHEN (q > 0)::INT + (x > 0)::INT + (d > 0)::INT > 1 THEN 1.0 ELSE 0.0 END)::DOUBLE * 0.5::DOUBLE) * 0.15::DOUBLE, 9) AS score FROM c),
e AS (SELECT *, count(*) OVER w AS n, row_number() OVER (PARTITION BY voice ORDER BY pitch) - 1 AS pi, row_number() OVER (PARTITION BY voice ORDER BY rate) - 1 AS ri FROM m WINDOW w AS (PARTITION BY voice)),
l AS (SELECT voice, max(pitch) FILTER (pi = least(n - 1, floor(0.1::DOUBLE * n))) AS pl, max(pitch) FILTER (pi = least(n - 1, floor(0.9::DOUBLE * n))) AS ph,
  max(rate) FILTER (ri = least(n - 1, floor(0.1::DOUBLE * n))) AS rl, max(rate) FILTER (ri = least(n - 1, floor(0.9::DOUBLE * n))) AS rh FROM e GROUP BY voice),
o AS (SELECT e.*, (pitch < pl OR pitch > ph)::INT + (rate < rl OR rate > rh)::INT AS n_outliers FROM e JOIN l USING (voice))"""


def _dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds, density = V.marks(F.col("text"))
    score = V.dynamic_score(F.col("pitch") / F.lit(280.0), F.col("rate") / 30, (F.col("size") % 10) / F.lit(10.0), density, F.when(kinds > 1, 1.0).otherwise(0.0))
    return V.outliers(_rated(spark, sf_dir).withColumn("score", F.round(score, 9)), "voice", ["pitch", "rate"])


@query(f"WITH {_DYNAMIC} SELECT voice, sample, round(score, 6) AS score, n_outliers FROM o")
def f13_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dynamic(spark, sf_dir).select("voice", "sample", F.round("score", 6).alias("score"), "n_outliers")


@query(f"""WITH {_DYNAMIC}, b AS (SELECT *, row_number() OVER (PARTITION BY voice ORDER BY size DESC, sample) AS big FROM o),
t AS (SELECT *, CASE WHEN big <= greatest(5, floor(0.7::DOUBLE * n)) THEN least(2, n_outliers) ELSE 3 END::INT AS tier FROM b),
p AS (SELECT *, row_number() OVER (PARTITION BY voice ORDER BY tier, score DESC, sample) AS place FROM t)
SELECT voice, place::INT AS place, sample, tier FROM p WHERE place <= 3""")
def o9_dynamic_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.dynamic_picks(_dynamic(spark, sf_dir))
