"""Queries over timed words: segmentation, gaps, offsets, neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from utterloom.functions import text as T
from utterloom.operators import segment
from utterloom.plans.adapters import WORDS_SQL, abbreviation_sql, break_sql, read, words
from utterloom.registry import query

_RANGES = """
cut AS (SELECT r.file_id, r.f, r.t, array_agg(trim(w.word) ORDER BY w.pos) AS ws, count(*) AS n,
               arg_max(w.end_ms, w.pos) FILTER (w.end_ms IS NOT NULL) - arg_min(w.start_ms, w.pos) FILTER (w.start_ms IS NOT NULL) AS took
        FROM ranges r JOIN words w ON w.file_id = r.file_id AND w.pos BETWEEN r.f AND r.t GROUP BY ALL)
SELECT file_id, (row_number() OVER (PARTITION BY file_id ORDER BY f) - 1)::INT AS seg_id, f::INT AS w_from, t::INT AS w_to,
       n::INT AS n_words, took / 1000.0::DOUBLE AS duration, array_to_string(ws, ' ') AS text FROM cut
"""


def _maximise_sql(source: str, out: str) -> str:
    """Fold as a recursive query: one row of state for each recording and step."""
    return f"""
{out}_v AS (SELECT file_id, pos, start_ms AS s, end_ms AS e, length(word) AS len, {break_sql("word")} AS brk,
       sum(length(word) + 1) OVER (PARTITION BY file_id ORDER BY pos) AS cum,
       first_value(start_ms IGNORE NULLS) OVER (PARTITION BY file_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nvs
     FROM {source}),
{out}_k AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY pos) AS k FROM {out}_v WHERE s IS NOT NULL AND e IS NOT NULL),
{out}_r AS (
  SELECT file_id, 0::BIGINT AS k, NULL::BIGINT AS sp, NULL::BIGINT AS sc, NULL::BIGINT AS sv, NULL::BIGINT AS bp, NULL::BIGINT AS bc,
         NULL::BIGINT AS bv, 0::BIGINT AS le, NULL::BIGINT AS ef, NULL::BIGINT AS et FROM {out}_k WHERE k = 1
  UNION ALL
  SELECT file_id, k,
    CASE WHEN ok THEN sp2 WHEN bp1 IS NOT NULL THEN bp1 + 1 END, CASE WHEN ok THEN sc2 WHEN bp1 IS NOT NULL THEN bc1 END,
    CASE WHEN ok THEN sv2 WHEN bp1 IS NOT NULL THEN bv1 END,
    CASE WHEN ok AND brk THEN pos WHEN ok THEN bp1 END, CASE WHEN ok AND brk THEN cum WHEN ok THEN bc1 END,
    CASE WHEN ok AND brk THEN nvs WHEN ok THEN bv1 END, e,
    CASE WHEN NOT ok AND bp1 IS NOT NULL THEN sp2 END, CASE WHEN NOT ok THEN bp1 END
  FROM (SELECT *, (e - sv2 <= 11000 AND cum - sc2 - 1 <= 200) AS ok FROM (
    SELECT v.*, CASE WHEN gone OR r.sp IS NULL THEN v.pos ELSE r.sp END AS sp2,
           CASE WHEN gone OR r.sp IS NULL THEN v.cum - v.len - 1 ELSE r.sc END AS sc2,
           CASE WHEN gone OR r.sp IS NULL THEN v.s ELSE r.sv END AS sv2,
           CASE WHEN NOT gone THEN r.bp END AS bp1, CASE WHEN NOT gone THEN r.bc END AS bc1, CASE WHEN NOT gone THEN r.bv END AS bv1
    FROM (SELECT *, coalesce(sp IS NOT NULL AND le - sv > 11000, false) AS gone FROM {out}_r) r
    JOIN {out}_k v ON v.file_id = r.file_id AND v.k = r.k + 1))),
{out} AS (SELECT file_id, ef AS f, et AS t FROM {out}_r WHERE ef IS NOT NULL AND et IS NOT NULL
  UNION ALL SELECT file_id, sp, bp FROM {out}_r r WHERE bp IS NOT NULL AND sp IS NOT NULL
            AND k = (SELECT max(k) FROM {out}_k x WHERE x.file_id = r.file_id))"""


def _punctuation_sql(source: str, out: str) -> str:
    return f"""
{out}_v AS (SELECT file_id, pos, start_ms AS s, end_ms AS e, length(word) AS len, {break_sql("word")} AS brk,
       sum(length(word) + 1) OVER (PARTITION BY file_id ORDER BY pos) AS cum FROM {source}),
{out}_k AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY pos) AS k FROM {out}_v WHERE s IS NOT NULL AND e IS NOT NULL),
{out}_r AS (
  SELECT file_id, 0::BIGINT AS k, NULL::BIGINT AS sp, NULL::BIGINT AS sc, NULL::BIGINT AS sv, NULL::BIGINT AS ef, NULL::BIGINT AS et
  FROM {out}_k WHERE k = 1
  UNION ALL
  SELECT v.file_id, v.k,
    CASE WHEN r.sp IS NULL OR v.e - r.sv > 11000 OR v.cum - r.sc - 1 > 200 THEN v.pos WHEN v.e - r.sv >= 2000 AND v.brk THEN NULL ELSE r.sp END,
    CASE WHEN r.sp IS NULL OR v.e - r.sv > 11000 OR v.cum - r.sc - 1 > 200 THEN v.cum - v.len - 1 ELSE r.sc END,
    CASE WHEN r.sp IS NULL OR v.e - r.sv > 11000 OR v.cum - r.sc - 1 > 200 THEN v.s ELSE r.sv END,
    CASE WHEN r.sp IS NOT NULL AND v.e - r.sv <= 11000 AND v.cum - r.sc - 1 <= 200 AND v.e - r.sv >= 2000 AND v.brk THEN r.sp END, v.pos
  FROM {out}_r r JOIN {out}_k v ON v.file_id = r.file_id AND v.k = r.k + 1),
{out} AS (SELECT file_id, ef AS f, et AS t FROM {out}_r WHERE ef IS NOT NULL)"""


_SPLIT = f"""
prefix AS (SELECT file_id, pos, word, end_ms - first_value(start_ms IGNORE NULLS) OVER w AS dur,
             last_value(end_ms IGNORE NULLS) OVER (PARTITION BY file_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
             - first_value(start_ms IGNORE NULLS) OVER (PARTITION BY file_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS total
           FROM words WINDOW w AS (PARTITION BY file_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
split AS (SELECT file_id, arg_min(pos, (abs(dur - total * 0.6::DOUBLE), pos)) AS cut_pos FROM prefix
          WHERE dur IS NOT NULL AND {break_sql("word", T.STOPS)} GROUP BY file_id)"""


@query(f"WITH RECURSIVE {WORDS_SQL}, {_maximise_sql('words', 'ranges')}, {_RANGES}")
def w5_maximise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.cut(words(spark, sf_dir), "maximise-punctuation")


@query(f"WITH RECURSIVE {WORDS_SQL}, {_punctuation_sql('words', 'ranges')}, {_RANGES}")
def w6_punct_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.cut(words(spark, sf_dir), "punctuation-only")


@query(f"""WITH RECURSIVE {WORDS_SQL}, {_SPLIT},
head AS (SELECT w.* FROM words w LEFT JOIN split s ON s.file_id = w.file_id WHERE s.cut_pos IS NULL OR w.pos <= s.cut_pos),
tail AS (SELECT w.* FROM words w JOIN split s ON s.file_id = w.file_id WHERE w.pos > s.cut_pos),
{_maximise_sql("head", "ranges1")}, {_punctuation_sql("tail", "ranges2")},
ranges AS (SELECT * FROM ranges1 UNION ALL SELECT * FROM ranges2), {_RANGES}""")
def w7_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.cut(words(spark, sf_dir), "mixed")


@query(f"WITH {WORDS_SQL}, {_SPLIT} SELECT file_id, cut_pos::INT AS split_pos FROM split")
def w4_mixed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("file_id")
    order = by.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    whole = by.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = words(spark, sf_dir)
    w = w.withColumn("dur", F.col("end_ms") - F.first("start_ms", ignorenulls=True).over(order))
    w = w.withColumn("total", F.last("end_ms", ignorenulls=True).over(whole) - F.first("start_ms", ignorenulls=True).over(whole))
    far = F.abs(F.col("dur") - F.col("total") * F.lit(0.6))
    ends = w.where(F.col("dur").isNotNull() & T.is_break(F.col("word"), T.STOPS))
    return ends.groupBy("file_id").agg(F.min_by("pos", F.struct(far, "pos")).cast("int").alias("split_pos"))


@query(f"""WITH {WORDS_SQL} SELECT file_id, pos::INT AS pos, word, {abbreviation_sql("word")} AS abbreviation,
{break_sql("word")} AS is_break, {break_sql("word", T.STOPS)} AS is_stop FROM words WHERE regexp_matches(word, '{T.BREAKS}')""")
def t2_abbrev_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.col("word")
    out = words(spark, sf_dir).where(w.rlike(T.BREAKS))
    return out.select("file_id", "pos", "word", T.is_abbreviation(w).alias("abbreviation"), T.is_break(w).alias("is_break"), T.is_break(w, T.STOPS).alias("is_stop"))


_TURNS = """turns AS (SELECT file_id, turn AS seg_id, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n_words,
  arg_max(word, pos) AS last_word, arg_max(start_ms, pos) FILTER (start_ms IS NOT NULL) AS last_start FROM words GROUP BY ALL)"""


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(spark, sf_dir).groupBy("file_id", F.col("turn").alias("seg_id")).agg(
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count("*").alias("n_words"),
        F.max_by("word", "pos").alias("last_word"),
        F.max_by("start_ms", F.when(F.col("start_ms").isNotNull(), F.col("pos"))).alias("last_start"),
    )


@query(rf"""WITH {WORDS_SQL}, {_TURNS} SELECT file_id, seg_id, end_ms,
greatest(last_start, end_ms - CASE WHEN regexp_matches(trim(last_word), '[.!?]\z') THEN 100 ELSE 50 END)::BIGINT AS cut_end_ms FROM turns""")
def t13_negative_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = segment.offset_end(F.col("last_word"), F.col("last_start"), F.col("end_ms"))
    return _turns(spark, sf_dir).select("file_id", "seg_id", "end_ms", end.alias("cut_end_ms"))


@query("""WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS s, epoch_us(ts) + round(value * 100)::BIGINT * 10000 AS e FROM events),
g AS (SELECT user_id, event_id, s - lag(e) OVER w AS prev_gap, lead(s) OVER w - e AS next_gap FROM e
      WINDOW w AS (PARTITION BY user_id ORDER BY s, event_id))
SELECT user_id, event_id, prev_gap, next_gap, NOT (coalesce(prev_gap < 60000000, false) OR coalesce(next_gap < 60000000, false)) AS kept FROM g""")
def f6_min_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    e = e.select("user_id", "event_id", start.alias("start_ms"), (start + F.round(F.col("value") * 100).cast("long") * 10_000).alias("end_ms"))
    e = e.withColumn("at", F.struct("start_ms", "event_id"))
    return segment.min_gap(e, 60_000_000, "user_id", "at").select("user_id", "event_id", "prev_gap", "next_gap", "kept")


@query(f"""WITH {WORDS_SQL}, {_TURNS}, n AS (SELECT *, lag(end_ms) OVER w AS prev_word_end, lead(start_ms) OVER w AS next_word_start,
  max(end_ms) OVER (PARTITION BY file_id) AS audio_ms FROM turns WINDOW w AS (PARTITION BY file_id ORDER BY seg_id))
SELECT file_id, seg_id, prev_word_end, next_word_start, coalesce(start_ms - prev_word_end < 150, false) AS search_start,
  greatest(0, CASE WHEN start_ms - prev_word_end < 150 THEN least(prev_word_end, start_ms - 50) ELSE start_ms - 150 END)::BIGINT AS start_from,
  coalesce(next_word_start - end_ms < 400, false) AS search_end,
  least(audio_ms, CASE WHEN next_word_start - end_ms < 400 THEN next_word_start ELSE end_ms + 400 END)::BIGINT AS end_to FROM n""")
def w2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("file_id").orderBy("seg_id")
    t = _turns(spark, sf_dir).withColumn("prev_word_end", F.lag("end_ms").over(w)).withColumn("next_word_start", F.lead("start_ms").over(w))
    t = t.withColumn("audio_ms", F.max("end_ms").over(Window.partitionBy("file_id")))
    return segment.cut_windows(t).select("file_id", "seg_id", "prev_word_end", "next_word_start", "search_start", "start_from", "search_end", "end_to")


@query(f"""WITH {WORDS_SQL}, {_TURNS} SELECT file_id, count(*) AS n_segments, sum(n_words)::BIGINT AS n_words,
round(sum(end_ms - start_ms) / 60000.0::DOUBLE, 2) AS minutes, (count(*) // 2)::BIGINT AS batches FROM turns GROUP BY file_id""")
def a10_audio_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turns(spark, sf_dir).groupBy("file_id").agg(
        F.count("*").alias("n_segments"), F.sum("n_words").alias("n_words"),
        F.round(F.sum(F.col("end_ms") - F.col("start_ms")) / F.lit(60000.0), 2).alias("minutes"),
        F.floor(F.count("*") / 2).cast("long").alias("batches"),
    )


@query(f"""WITH {WORDS_SQL}, {_TURNS}, r AS (SELECT file_id, CASE WHEN end_ms - start_ms > 11000 THEN 'too long'
  WHEN n_words < 8 THEN 'too few words' ELSE 'kept' END AS reason FROM turns)
SELECT coalesce(file_id, -1) AS file_id, coalesce(reason, 'all') AS reason, count(*) AS n FROM r
GROUP BY GROUPING SETS ((file_id, reason), (file_id), (reason), ())""")
def a16_discard_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.when(F.col("end_ms") - F.col("start_ms") > 11_000, "too long").when(F.col("n_words") < 8, "too few words").otherwise("kept")
    r = _turns(spark, sf_dir).select("file_id", reason.alias("reason")).cube("file_id", "reason").agg(F.count("*").alias("n"))
    return r.select(F.coalesce("file_id", F.lit(-1).cast("long")).alias("file_id"), F.coalesce("reason", F.lit("all")).alias("reason"), "n")


@query(f"""WITH {WORDS_SQL} SELECT file_id, turn, count(*) AS n_words,
md5(array_to_string(list_filter(array_agg(trim(word) ORDER BY pos), lambda x: x <> ''), ' ')) AS text_md5 FROM words GROUP BY file_id, turn""")
def t8_join_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = words(spark, sf_dir).groupBy("file_id", "turn").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("ws"))
    return w.select("file_id", "turn", F.size("ws").cast("long").alias("n_words"), F.md5(T.joined(F.col("ws.word"))).alias("text_md5"))
