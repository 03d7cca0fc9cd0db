"""Transcripts cut into segments as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from utterloom.operators import segment
from utterloom.operators.alignment import TRANSCRIPT
from utterloom.sources.readers import transcript_words


def segments(spark: SparkSession, source: str, target: str, checkpoint: str, method: str = "maximise-punctuation", files: int = 100) -> StreamingQuery:
    """Every new JSON document below source, cut and appended to the Parquet table target; ends when none is left.

    A transcript is one document and so never spans micro-batches. A batch that is run again writes its own folder anew.
    """
    stream = spark.readStream.schema(TRANSCRIPT).option("multiLine", True).option("maxFilesPerTrigger", files).json(source)
    stream = stream.withColumn("path", F.col("_metadata.file_path"))

    def write(batch: DataFrame, number: int) -> None:
        segment.cut(transcript_words(batch), method).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
