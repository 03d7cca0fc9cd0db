"""Queries over documents, chapters and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from utterloom.functions import text as T
from utterloom.operators import documents, training
from utterloom.plans.adapters import read
from utterloom.registry import query


@query("""SELECT conv_id, (turn // 3)::INT AS part, md5(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS text_md5, count(*) AS n FROM conversations GROUP BY 1, 2""")
def h6_group_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    parts = documents.grouped(c, "conv_id", "turn", "text", 3)
    n = c.groupBy("conv_id", F.floor(F.col("turn") / 3).cast("int").alias("part")).agg(F.count("*").alias("n"))
    return parts.join(n, ["conv_id", "part"]).select("conv_id", "part", F.md5("text").alias("text_md5"), "n")


@query()
def h1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", documents.paragraph_text(F.col("html")).alias("text"))


@query()
def h3_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.chapter_rows(read(spark, sf_dir, "pages"), "page_id", "html")


@query()
def t3_sentence_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", "text", (F.regexp_instr("text", F.lit("[.!?]")) - 1).alias("pos"))
    return d.where("pos >= 0").select("doc_id", "pos", T.real_sentence_end_column(F.col("text"), F.col("pos")).alias("ends"))


@query("""SELECT doc_id, coalesce(nullif(regexp_replace(source || '_' || CASE WHEN doc_id % 5 = 0 THEN 'x' ELSE doc_id::VARCHAR END, '[^0-9]', '', 'g'), '')::BIGINT - 1, 0) AS chapter,
CASE lang WHEN 'en' THEN 'eng' WHEN 'nl' THEN 'nld' ELSE lang END AS language, regexp_matches('GTX 10' || (60 + doc_id % 40), '1060|1070|1080|1660|1650') AS old_gpu FROM documents""")
def t7_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    stem = F.concat("source", F.lit("_"), F.when(F.col("doc_id") % 5 == 0, "x").otherwise(F.col("doc_id").cast("string")))
    gpu = T.is_old_gpu(F.concat(F.lit("GTX 10"), (60 + F.col("doc_id") % 40).cast("string")))
    return d.select("doc_id", T.chapter_index(stem).alias("chapter"), T.language(F.col("lang"), {"en": "eng", "nl": "nld"}).alias("language"), gpu.alias("old_gpu"))


@query("""WITH l AS (SELECT user_id AS log, event_id AS line, CASE event_type WHEN 'error' THEN ' > EVALUATION' WHEN 'click' THEN 'avg_loss_text_ce: ' || value::VARCHAR
  ELSE repeat('-', 200) END AS value FROM events),
e AS (SELECT *, (sum(length(value) + 1) OVER (PARTITION BY log ORDER BY line))::BIGINT AS fin FROM l),
s AS (SELECT *, fin - length(value) - 1 AS beg FROM e),
m AS (SELECT *, last_value(CASE WHEN contains(value, '> EVALUATION') THEN beg + instr(value, '> EVALUATION') - 1 END IGNORE NULLS)
  OVER (PARTITION BY log ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM s)
SELECT log, line, regexp_extract(value, 'ce:[^0-9]*([0-9.]+)', 1)::DOUBLE AS loss FROM m WHERE contains(value, 'avg_loss_text_ce:') AND beg - mark <= 1000""")
def t19_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    loss = F.concat(F.lit("avg_loss_text_ce: "), F.col("value").cast("string"))
    value = F.when(kind == "error", " > EVALUATION").when(kind == "click", loss).otherwise("-" * 200)
    lines = read(spark, sf_dir, "events").select(F.col("user_id").alias("log"), F.col("event_id").alias("line"), value.alias("value"))
    return training.losses(lines, "text")
