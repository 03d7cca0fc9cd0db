"""Writers: metadata tables, JSON, candidate texts, audio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from utterloom.functions import signal
from utterloom.operators.dataset import split


def metadata(rows: DataFrame, path: str, share: float = 0.8, seed: str = "17") -> None:
    """Pipe-separated train and eval tables (folders split=train, split=eval) with a header."""
    parts = split(rows.select("audio_file", F.trim("text").alias("text"), "speaker_name"), "audio_file", share, seed)
    parts.write.mode("overwrite").partitionBy("split").option("sep", "|").option("header", True).csv(path)


def json(rows: DataFrame, path: str, by: str | None = None) -> None:
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def candidate_texts(candidates: DataFrame, path: str) -> None:
    """A folder for each query and place, holding the candidate's text."""
    named = candidates.select(F.format_string("%s_candidate_%02d", F.col("item_id").cast("string"), F.col("place")).alias("name"), F.col("passage").alias("value"))
    named.write.mode("overwrite").partitionBy("name").text(path)


def wav_content(samples: Column, rate: int) -> Column:
    return signal.mapped(lambda a: signal.encode_wav(a, rate), samples, "binary")


def audio(rows: DataFrame, path: str, rate: int) -> None:
    """(name, content) of 16-bit files as Parquet: a table sink that any executor can write."""
    rows.select("name", wav_content(F.col("samples"), rate).alias("content")).write.mode("overwrite").parquet(path)
