"""Readers of audio listings, transcripts, texts, metadata and logs; schemas are always given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from utterloom.functions import signal
from utterloom.functions.text import basename
from utterloom.operators.alignment import TRANSCRIPT
from utterloom.operators.documents import epub_rows

AUDIO_SUFFIXES = r"(?i)\.(mp3|wav|flac|ogg|webm)\z"
METADATA = "audio_file string, text string, speaker_name string"


def listing(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, name, length) of all files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    files = files.where(F.col("path").rlike(pattern)) if pattern else files
    return files.select("path", basename(F.col("path")).alias("name"), "length")


def audio_files(spark: SparkSession, path: str) -> DataFrame:
    """Audio files below a folder by suffix, whatever its case, with their place in the order of lower-cased paths."""
    found = listing(spark, path, AUDIO_SUFFIXES)
    return found.orderBy(F.lower("path"))


def wav_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(path).select("path", "length")


def wav_samples(spark: SparkSession, path: str) -> DataFrame:
    """(path, rate, samples): PCM files decoded to mono; rate is null where a file can't be read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(path).select("path", "content")

    def decode(batches):
        import pandas as pd

        for pdf in batches:
            got = [signal.decode_wav(c) for c in pdf.content]
            yield pd.DataFrame({"path": pdf.path, "rate": pd.array([g and g[0] for g in got], dtype="Int32"), "samples": [None if g is None else g[1] for g in got]})

    return files.mapInPandas(decode, "path string, rate int, samples array<double>")


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """(path, word_segments, segments, text, _corrupt_record) of JSON documents."""
    reader = spark.read.schema(f"{TRANSCRIPT}, _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE")
    return reader.json(path).withColumn("path", F.col("_metadata.file_path"))


def transcript_words(rows: DataFrame) -> DataFrame:
    """(file_id, pos, word, start_ms, end_ms) of transcripts, as segmentation takes them."""
    ids = rows.select(F.xxhash64("path").alias("file_id"), F.posexplode("word_segments").alias("pos", "w"))
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    return ids.select("file_id", "pos", F.col("w.word").alias("word"), ms("w.start").alias("start_ms"), ms("w.end").alias("end_ms"))


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): a row for each file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def epubs(spark: SparkSession, path: str) -> DataFrame:
    return epub_rows(spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").load(path))


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a pipe-separated table with a header; rows without all three fields go."""
    rows = spark.read.csv(path, sep="|", header=True, schema=METADATA, mode="PERMISSIVE")
    return rows.where(F.col("audio_file").isNotNull() & F.col("text").isNotNull() & F.col("speaker_name").isNotNull())


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(log, line, value): whole logs cut into numbered lines."""
    return texts(spark, path).select(F.col("path").alias("log"), F.posexplode(F.split("text", "\n")).alias("line", "value"))
