"""Queries of source-text retrieval: benchmark items ask, documents are the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from utterloom.functions import text as T
from utterloom.operators import retrieval as R
from utterloom.plans.adapters import read
from utterloom.registry import query

_TOKENS = f"""
q AS (SELECT item_id, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS qp FROM
      (SELECT item_id, regexp_extract_all(lower(text), '{T.TOKEN.replace("'", "''")}') AS l FROM benchmark)),
s AS (SELECT doc_id, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS pos FROM
      (SELECT doc_id, regexp_extract_all(lower(text), '{T.TOKEN.replace("'", "''")}') AS l FROM documents)),
p AS (SELECT *, count(*) OVER (PARTITION BY doc_id, token) AS df FROM s WHERE length(token) >= 3),
m AS (SELECT q.item_id, p.doc_id, q.token, q.qp, p.pos FROM q JOIN p ON p.token = q.token AND p.df <= 400)"""
_VOTES = """
v AS (SELECT item_id, doc_id, greatest(0, pos - qp)::INT AS start, sum(12 + least(6, length(token)))::BIGINT AS votes,
             min(qp::BIGINT * 2147483648 + pos) AS first FROM m GROUP BY ALL)"""
_BEST = """
b AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY max(votes) DESC, doc_id) AS r FROM v GROUP BY item_id, doc_id),
nq AS (SELECT item_id, count(*)::INT AS n_query FROM q GROUP BY item_id),
o AS (SELECT v.*, row_number() OVER w AS k, max(votes) OVER (PARTITION BY item_id, doc_id) AS top,
             greatest(40, greatest(120, least(n_query + 120, 1800)) // 3) AS reach, n_query
      FROM v JOIN b USING (item_id, doc_id) JOIN nq USING (item_id) WHERE r <= 3
      WINDOW w AS (PARTITION BY item_id, doc_id ORDER BY votes DESC, first)),
n AS (SELECT item_id, doc_id, 0::BIGINT AS k, []::INT[] AS acc FROM o WHERE k = 1
      UNION ALL
      SELECT n.item_id, n.doc_id, o.k, CASE WHEN len(acc) < 18 AND len(list_filter(acc, lambda x: abs(x - o.start) < o.reach)) = 0
             THEN list_append(acc, o.start) ELSE acc END
      FROM n JOIN o ON o.item_id = n.item_id AND o.doc_id = n.doc_id AND o.k = n.k + 1),
last AS (SELECT item_id, doc_id, arg_max(acc, k) AS acc FROM n GROUP BY ALL),
starts AS (SELECT item_id, doc_id, unnest(acc) AS start, generate_subscripts(acc, 1) - 1 AS rank FROM last)"""


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.token_rows(read(spark, sf_dir, "benchmark"), "item_id")


@query(f"WITH {_TOKENS} SELECT doc_id, count(*) AS n_tokens, count(DISTINCT token) AS n_distinct, md5(string_agg(token, ' ' ORDER BY pos)) AS tokens_md5 FROM s GROUP BY doc_id")
def t1_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", T.tokens(F.col("text")).alias("l")).where(F.size("l") > 0)
    n, distinct = F.size("l").cast("long"), F.size(F.array_distinct("l")).cast("long")
    return d.select("doc_id", n.alias("n_tokens"), distinct.alias("n_distinct"), F.md5(F.array_join("l", " ")).alias("tokens_md5"))


@query(f"WITH {_TOKENS} SELECT item_id, doc_id, count(*) AS n_matches, count(DISTINCT token) AS n_tokens FROM m GROUP BY ALL")
def j1_index_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.probe(read(spark, sf_dir, "documents"), _queries(spark, sf_dir), "item_id", "doc_id")


@query(f"WITH {_TOKENS}, {_VOTES} SELECT item_id, doc_id, max(votes) AS votes, arg_min(start, (-votes, first)) AS start, count(*) AS n_starts FROM v GROUP BY ALL")
def a1_diagonal_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.source_votes(read(spark, sf_dir, "documents"), _queries(spark, sf_dir), "item_id", "doc_id")


@query(f"WITH RECURSIVE {_TOKENS}, {_VOTES}, {_BEST} SELECT item_id, doc_id, rank::INT AS rank, start FROM starts")
def w8_nms(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = R.best_starts(read(spark, sf_dir, "documents"), _queries(spark, sf_dir), "item_id", "doc_id", 3, 18)
    return kept.select("item_id", "doc_id", "rank", "start")


_TOKEN = T.TOKEN.replace("'", "''")


@query(rf"""WITH RECURSIVE {_TOKENS}, {_VOTES}, {_BEST},
d AS (SELECT doc_id, text, regexp_extract_all(text, '{_TOKEN}') AS l, regexp_split_to_array(text, '{_TOKEN}') AS g FROM documents
      WHERE doc_id IN (SELECT doc_id FROM starts)),
u AS (SELECT doc_id, unnest(l) AS tok, unnest(list_slice(g, 1, len(l))) AS gap, generate_subscripts(l, 1) - 1 AS pos FROM d),
pl AS (SELECT doc_id, pos, lower(tok) AS token, length(tok) AS n,
         (sum(length(gap) + length(tok)) OVER (PARTITION BY doc_id ORDER BY pos) - length(tok))::BIGINT AS place FROM u),
w AS (SELECT st.*, o.votes, o.top, o.n_query, least(len(d.l), st.start + greatest(120, least(o.n_query + 120, 1800))) AS fin, d.text
      FROM starts st JOIN o USING (item_id, doc_id, start) JOIN d USING (doc_id)),
c AS (SELECT w.item_id, w.doc_id, w.start, pl.token, count(*) AS cw FROM w JOIN pl ON pl.doc_id = w.doc_id AND pl.pos >= w.start AND pl.pos < w.fin GROUP BY ALL),
cq AS (SELECT item_id, token, count(*) AS cq FROM q GROUP BY ALL),
h AS (SELECT c.item_id, c.doc_id, c.start, sum(least(cw, cq))::DOUBLE AS hits FROM c JOIN cq USING (item_id, token) GROUP BY ALL),
x AS (SELECT w.*, coalesce(hits, 0) / greatest(1, fin - start)::DOUBLE AS pr, coalesce(hits, 0) / greatest(1, n_query)::DOUBLE AS rc FROM w LEFT JOIN h USING (item_id, doc_id, start)),
y AS (SELECT x.item_id, x.doc_id, x.rank, x.start, x.fin, x.text, a.place AS c0, b.place + b.n AS c1,
        round((votes / top::DOUBLE) * 0.65::DOUBLE + CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END * 0.35::DOUBLE, 5) AS score
      FROM x JOIN pl a ON a.doc_id = x.doc_id AND a.pos = x.start JOIN pl b ON b.doc_id = x.doc_id AND b.pos = x.fin - 1),
e AS (SELECT *, c0 - length(regexp_extract(substr(text, greatest(0, c0 - 320) + 1, c0 - greatest(0, c0 - 320)), '[^.!?\n]*\z')) AS a0,
        c1 + length(regexp_extract(substr(text, c1 + 1, 320), '\A[^.!?\n]*[.!?\n]?')) AS b0 FROM y),
f AS (SELECT *, trim(substr(text, a0 + 1, b0 - a0), ' ' || chr(9) || chr(10) || chr(13)) AS passage FROM e),
g1 AS (SELECT *, row_number() OVER (PARTITION BY item_id, doc_id, substr(passage, 1, 1200) ORDER BY score DESC, rank) AS copy FROM f WHERE passage <> ''),
g2 AS (SELECT *, row_number() OVER (PARTITION BY item_id, doc_id ORDER BY score DESC, rank) AS place FROM g1 WHERE copy = 1)
SELECT item_id, doc_id, place::INT AS place, start AS start_token, fin::INT AS end_token, score, passage FROM g2 WHERE place <= 3""")
def x4_retrieval_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "benchmark")
    return R.candidates(items, R.token_rows(items, "item_id"), read(spark, sf_dir, "documents"))


@query(f"""WITH {_TOKENS}, {_VOTES}, b AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY max(votes) DESC, doc_id) AS r FROM v GROUP BY item_id, doc_id),
cs AS (SELECT doc_id, token, count(*) AS cw FROM s GROUP BY ALL), ns AS (SELECT doc_id, count(*) AS n_source FROM s GROUP BY ALL),
cq AS (SELECT item_id, token, count(*) AS cq FROM q GROUP BY ALL), nq AS (SELECT item_id, count(*) AS n_query FROM q GROUP BY ALL),
h AS (SELECT item_id, doc_id, sum(least(cw, cq))::BIGINT AS hits FROM b JOIN cq USING (item_id) JOIN cs USING (doc_id, token) WHERE r = 1 GROUP BY ALL)
SELECT item_id, doc_id, hits, n_source, n_query, round(2 * (hits / n_source::DOUBLE) * (hits / n_query::DOUBLE) / (hits / n_source::DOUBLE + hits / n_query::DOUBLE), 6) AS f1
FROM h JOIN ns USING (doc_id) JOIN nq USING (item_id)""")
def j8_overlap_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    top = F.broadcast(R.best_sources(docs, _queries(spark, sf_dir), "item_id", "doc_id", 1).select("item_id", "doc_id"))
    windows = R.token_rows(docs.join(top.select("doc_id").distinct(), "doc_id", "left_semi"), "doc_id")
    windows = windows.join(top, "doc_id").select("item_id", "doc_id", "token")
    o = R.overlap(windows, _queries(spark, sf_dir), ["item_id", "doc_id"], "item_id")
    value = F.round(R.f1(F.col("hits"), F.col("n_window"), F.col("n_query")), 6)
    return o.select("item_id", "doc_id", "hits", F.col("n_window").alias("n_source"), "n_query", value.alias("f1"))


@query(f"""WITH {_TOKENS}, n AS (SELECT doc_id, count(*)::INT AS n FROM s GROUP BY doc_id),
x AS (SELECT doc_id, n, CASE WHEN n <= 120 THEN [0] ELSE list_transform([0, 1, 2], lambda i: least(n - 120, i * greatest(1, (n - 120) // 2))) END AS l FROM n)
SELECT doc_id, n AS n_tokens, (generate_subscripts(l, 1) - 1)::INT AS place, unnest(l)::INT AS start FROM x""")
def w10_fallback_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", F.size(T.tokens(F.col("text"))).alias("n_tokens")).where("n_tokens > 0")
    return d.select("doc_id", "n_tokens", F.posexplode(R.fallback_starts(F.col("n_tokens"), F.lit(120), 3)).alias("place", "start"))


@query(r"""WITH x AS (SELECT doc_id, text, length(text) // 3 AS c0, length(text) // 2 AS c1 FROM documents)
SELECT doc_id, (c0 - length(regexp_extract(substr(text, greatest(0, c0 - 320) + 1, c0 - greatest(0, c0 - 320)), '[^.!?\n]*\z')))::INT AS start_char,
       (c1 + length(regexp_extract(substr(text, c1 + 1, 320), '\A[^.!?\n]*[.!?\n]?')))::INT AS end_char FROM x""")
def t4_sentence_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    third, half = (F.floor(F.length("text") / n).cast("int") for n in (3, 2))
    return read(spark, sf_dir, "documents").select("doc_id", T.sentence_start(F.col("text"), third).alias("start_char"), T.sentence_end(F.col("text"), half).alias("end_char"))
