"""Training schedules and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def steps_per_epoch(n: Column, batch: Column, accumulation: Column) -> Column:
    return F.floor(n / (batch * accumulation)).cast("long")


def milestones(total: Column, epochs: Column) -> Column:
    """70 and 90 per cent of the steps up to ten epochs, 25, 60 and 80 beyond."""
    at = lambda shares: F.transform(F.array(*(F.lit(float(p)) for p in shares)), lambda p: F.floor(total * p).cast("long"))
    return F.when(epochs <= 10, at([0.7, 0.9])).otherwise(at([0.25, 0.6, 0.8]))


def cosine(total: Column, per_epoch: Column, epochs: Column, rate: Column) -> Column:
    """T_0, T_mult, eta_min of a cosine schedule with restarts."""
    return F.struct(
        F.when(epochs <= 10, total).otherwise(3 * per_epoch).alias("t0"),
        F.when(epochs <= 10, 1).otherwise(2).alias("t_mult"),
        (rate * 0.1).alias("eta_min"),
    )


def max_wav_length(seconds: Column, rate: Column) -> Column:
    return F.floor((seconds + 0.5) * rate).cast("long")


def losses(lines: DataFrame, kind: str) -> DataFrame:
    """(log, line, loss): loss lines of a kind whose last 1000 characters before them name an evaluation.

    lines has log, line (ordinal), value. The look-back counts characters of whole lines, newlines included.
    """
    end = F.sum(F.length("value") + 1).over(Window.partitionBy("log").orderBy("line"))
    at = lines.withColumn("_end", end).withColumn("_start", F.col("_end") - F.length("value") - 1)
    mark = F.when(F.col("value").contains("> EVALUATION"), F.col("_start") + F.instr("value", "> EVALUATION") - 1)
    last = F.last(mark, ignorenulls=True).over(Window.partitionBy("log").orderBy("line").rowsBetween(Window.unboundedPreceding, -1))
    at = at.withColumn("_mark", last)
    found = at.where(F.col("value").contains(f"avg_loss_{kind}_ce:") & (F.col("_start") - F.col("_mark") <= 1000))
    return found.select("log", "line", F.regexp_extract("value", r"ce:[^\d]*([\d.]+)", 1).cast("double").alias("loss"))


def best_checkpoint(files: DataFrame) -> DataFrame:
    """(run, path, step): the file with the greatest number behind best_model_, of the first folder that has any."""
    step = F.regexp_extract("path", r"best_model_(\d+)\.pth\z", 1)
    found = files.withColumn("step", step).where("step <> ''").withColumn("step", F.col("step").cast("long"))
    found = found.withColumn("folder", F.regexp_replace("path", r"/[^/]*\z", ""))
    first = found.groupBy("run").agg(F.min("folder").alias("folder"))
    return found.join(first, ["run", "folder"]).groupBy("run").agg(F.max_by("path", "step").alias("path"), F.max("step").alias("step"))


def pruned(weights: Column) -> Column:
    """Names of a checkpoint's weights without those of the discrete autoencoder."""
    return F.filter(weights, lambda w: ~w.contains("dvae"))


def publishable(files: DataFrame, target: DataFrame, key: str = "name") -> DataFrame:
    """Files with state: copied where the target folder exists (of which target has a row), else skipped."""
    there = F.when(F.col("_there"), "copied").otherwise("skipped")
    joined = files.join(target.select("folder").distinct().withColumn("_there", F.lit(True)), "folder", "left")
    return joined.withColumn("state", there).drop("_there")
