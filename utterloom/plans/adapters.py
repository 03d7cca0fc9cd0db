"""The driver's tables as the tables of the engine, in Spark and in DuckDB SQL.

Words get whole milliseconds from their lengths, so no sum of floats decides anything. Every seventeenth word has no
times, as recognisers leave some out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from utterloom.functions import text


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_id, pos, turn, word, start_ms, end_ms): a recording for each conversation.

    Whole turns are dealt out by recording before they fall into words, which take several times their text; the count of
    parts is stated, so that what is small as text is not put together.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    said = read(spark, sf_dir, "conversations").select("conv_id", "turn", "text").repartition(parts, "conv_id").select(
        F.col("conv_id").alias("file_id"), "turn",
        F.posexplode(F.regexp_extract_all("text", F.lit(r"[^ \n\t\r]+"), F.lit(0))).alias("i", "word"),
    )
    order = Window.partitionBy("file_id").orderBy("turn", "i")
    pause = F.when(F.col("word").rlike(r"[.!?]\z"), 350).when(F.col("word").rlike(r"[,;]\z"), 120).otherwise(20)
    timed = said.withColumn("dur", 80 + 45 * F.length("word")).withColumn("pause", pause)
    before = F.coalesce(F.sum(F.col("dur") + F.col("pause")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = timed.select("file_id", (F.row_number().over(order) - 1).alias("pos"), "turn", "word", before.alias("s"), "dur")
    known = F.col("pos") % 17 != 5
    return placed.select(
        "file_id", "pos", "turn", "word",
        F.when(known, F.col("s")).alias("start_ms"), F.when(known, F.col("s") + F.col("dur")).alias("end_ms"),
    )


WORDS_SQL = r"""
said AS (SELECT conv_id AS file_id, turn, unnest(l) AS word, generate_subscripts(l, 1) AS i
         FROM (SELECT conv_id, turn, regexp_extract_all(text, '[^ \n\t\r]+') AS l FROM conversations)),
timed AS (SELECT *, 80 + 45 * length(word) AS dur,
                 CASE WHEN regexp_matches(word, '[.!?]\z') THEN 350 WHEN regexp_matches(word, '[,;]\z') THEN 120 ELSE 20 END AS pause
          FROM said),
placed AS (SELECT file_id, turn, word, dur, row_number() OVER w - 1 AS pos,
                  coalesce(sum(dur + pause) OVER (PARTITION BY file_id ORDER BY turn, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
           FROM timed WINDOW w AS (PARTITION BY file_id ORDER BY turn, i)),
words AS (SELECT file_id, pos, turn, word, CASE WHEN pos % 17 <> 5 THEN s END::BIGINT AS start_ms,
                 CASE WHEN pos % 17 <> 5 THEN s + dur END::BIGINT AS end_ms
          FROM placed)"""


def abbreviation_sql(word: str) -> str:
    return f"regexp_matches(lower(right({word}, 6)), '{text.ABBREVIATION_PATTERN}')"


def break_sql(word: str, marks: str = text.BREAKS) -> str:
    return f"(regexp_matches({word}, '{marks}') AND NOT {abbreviation_sql(word)})"


def audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_id, samples): embeddings stand for short recordings."""
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("file_id"), F.col("embedding").cast("array<double>").alias("samples"))


AUDIO_SQL = "audio AS (SELECT vec_id AS file_id, embedding::DOUBLE[] AS samples FROM embeddings)"


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, seg, text, score): line items stand for aligned segments."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("seg"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("text"), (F.col("l_discount") * 10).alias("score"),
    )


ALIGNMENT_SQL = """alignment AS (SELECT l_orderkey AS doc, l_linenumber AS seg, l_returnflag || ' ' || l_linestatus AS text,
                                  l_discount * 10 AS score FROM lineitem)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(voice, sample, size, text, duration, pitch): documents stand for recorded samples of the voice of their source."""
    docs = read(spark, sf_dir, "documents")
    digest = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 4), 16, 10).cast("long")
    words_ = F.size(F.regexp_extract_all("text", F.lit(r"[^ \n\t\r]+"), F.lit(0)))
    return docs.select(
        F.col("source").alias("voice"), F.col("doc_id").alias("sample"), F.col("n_chars").alias("size"), "text",
        (words_ * 350).alias("duration_ms"), (80 + digest % 200).alias("pitch"),
    )


SAMPLES_SQL = r"""samples AS (SELECT source AS voice, doc_id AS sample, n_chars AS size, text,
  len(regexp_extract_all(text, '[^ \n\t\r]+')) * 350 AS duration_ms,
  80 + ('0x' || substr(md5(doc_id::VARCHAR), 1, 4))::BIGINT % 200 AS pitch FROM documents)"""


def digest(col: Column | str) -> Column:
    return F.md5(F.col(col) if isinstance(col, str) else col)
