"""Scores of aligned segments, the confidence gate, and what is taken from transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from utterloom.functions import text as T

TRANSCRIPT = (
    "word_segments array<struct<word:string,start:double,end:double,score:double>>, "
    "segments array<struct<text:string,start:double,end:double,score:double,words:array<struct<word:string,start:double,end:double>>>>, text string"
)


def scores(segments: DataFrame, key: str) -> DataFrame:
    """key, n, score: mean of mean and median, within 0 and 1. A missing score counts as 0, one that is no number not."""
    s = F.coalesce(F.col("score").cast("string"), F.lit("0")).try_cast("double")
    kept = segments.select(key, s.alias("s"))
    both = (F.avg("s") + F.median("s")) / 2
    return kept.groupBy(key).agg(F.count("s").alias("n"), F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), both)), F.lit(0.0)).alias("score"))


def coverage(aligned: Column, reference: Column) -> Column:
    return F.when(reference <= 0, 1.0).when(aligned <= 0, 0.0).otherwise(F.least(aligned, reference) / reference)


def combined(ctc: Column, retrieval: Column, covered: Column) -> Column:
    return ctc * 0.75 + retrieval * 0.15 + covered * 0.10


def accepted(score: Column, covered: Column, has_query: Column, min_score: float = 0.5, min_coverage: float = 0.35) -> Column:
    """The gate; without query words coverage doesn't count."""
    return (score >= min_score) & (~has_query | (covered >= min_coverage))


def best_attempt(attempts: DataFrame, key: str, order: str, score: str) -> DataFrame:
    """The attempt with the greatest score, the first of equals."""
    w = Window.partitionBy(key).orderBy(F.desc(score), order)
    return attempts.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def to_words(segments: Column) -> Column:
    """Aligned segments as words with text, start, end and score."""
    return F.transform(segments, lambda s: F.struct(s["text"].alias("word"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))


def query_words(word_segments: Column, segments: Column, text: Column, most: int = T.MAX_QUERY_WORDS) -> Column:
    """Lower-cased tokens from the first source that has any words: word_segments, segments' words, their text, text."""
    of = lambda words: F.flatten(F.transform(words, lambda w: T.tokens(F.coalesce(w, F.lit("")))))
    none = F.array().cast("array<string>")
    sources = [
        of(F.transform(word_segments, lambda w: w["word"])),
        of(F.flatten(F.transform(segments, lambda s: F.coalesce(F.transform(s["words"], lambda w: w["word"]), none)))),
        of(F.transform(segments, lambda s: s["text"])),
        T.tokens(F.coalesce(text, F.lit(""))),
    ]
    first = F.coalesce(*(F.when(F.size(s) > 0, s) for s in sources), none)
    return T.head_and_tail(first, most)


def run(attempts: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: key, attempt, score, n_failed, state, from attempts (key, order, ctc, retrieval, aligned, reference).

    A failed attempt has no ctc; it doesn't keep others from winning. ``state`` is failed where all did, else accepted or
    rejected by the gate on the best attempt, the first of equally good ones (to nine places).
    """
    covered = coverage(F.col("aligned"), F.col("reference"))
    tried = attempts.withColumn("_covered", covered)
    tried = tried.withColumn("_score", F.round(combined(F.col("ctc"), F.col("retrieval"), F.col("_covered")), 9))
    gate = accepted(F.col("ctc"), F.col("_covered"), F.col("reference") > 0)
    won = F.max_by(F.struct(F.col(order).alias("attempt"), F.col("_score").alias("score"), gate.alias("ok")), F.struct("_score", -F.col(order)))
    best = tried.groupBy(key).agg(won.alias("w"), F.count_if(F.col("ctc").isNull()).alias("n_failed"))
    none = F.col("w.score").isNull()
    state = F.when(none, "failed").when(F.col("w.ok"), "accepted").otherwise("rejected")
    return best.select(key, F.when(~none, F.col("w.attempt")).alias("attempt"), "w.score", "n_failed", state.alias("state"))
