"""Reference samples of a voice: complete sentences, index percentiles, ranked and tiered picks.

Ranks are windows over the samples of a voice; where a voice may hold a third of all rows, the sort spills, and only
rows that can be picked leave it (row_number filters are pushed into the sort).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def speech_rate(text: Column, duration: Column) -> Column:
    return F.when(duration > 0, F.length(text) / duration).otherwise(0.0)


def index_percentiles(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, n, low, high: the sorted values at int(0.1 n) and min(n - 1, int(0.9 n)); nothing is interpolated."""
    sizes = rows.groupBy(key).agg(F.count(value).alias("n"))
    counts = rows.groupBy(key, value).agg(F.count("*").alias("c")).where(F.col(value).isNotNull())
    upto = F.sum("c").over(Window.partitionBy(key).orderBy(value))
    placed = counts.withColumn("upto", upto).join(sizes, key)
    at = lambda q: F.least(F.col("n") - 1, F.floor(F.lit(q) * F.col("n")))
    holds = lambda q: F.min(F.when(F.col("upto") > at(q), F.col(value)))
    return placed.groupBy(key).agg(F.first("n").alias("n"), holds(0.1).alias("low"), holds(0.9).alias("high"))


def ranked(rows: DataFrame, key: str, by: list[Column]) -> DataFrame:
    """Adds place (from 1) and n of each key."""
    sizes = rows.groupBy(key).agg(F.count("*").alias("n"))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*by))).join(sizes, key)


def top_share(rows: DataFrame, key: str, size: str, order: str, share: float, least: int = 0) -> DataFrame:
    """The largest int(share * n) rows of each key, ``least`` at the least."""
    most = F.greatest(F.lit(least), F.floor(F.lit(float(share)) * F.col("n")))
    return ranked(rows, key, [F.desc(size), F.col(order)]).where(F.col("place") <= most)


def extended_picks(rows: DataFrame, key: str = "voice", order: str = "sample") -> DataFrame:
    """(voice, role, sample) of the extended mode: fast, low, slow and high, no sample twice.

    fast: greatest speech rate of the largest 70 per cent; low: the first by rising pitch behind the lowest tenth; slow:
    the least rate that is not under the index percentile; high: as low by falling pitch, of voices with four samples.
    """
    big = top_share(rows, key, "size", order, 0.7).drop("place", "n")
    picked = big.groupBy(key).agg(F.min_by(order, F.struct((-F.col("rate")).alias("r"), order)).alias("pick")).withColumn("role", F.lit("fast"))

    def left(role: str) -> DataFrame:
        return rows.join(picked.select(key, F.col("pick").alias(order)), [key, order], "left_anti").withColumn("role", F.lit(role))

    def behind_tenth(role: str, by: list[Column], least: int) -> DataFrame:
        all_ = ranked(rows, key, by).where((F.col("place") > F.floor(F.lit(0.1) * F.col("n"))) & (F.col("n") >= least))
        return all_.join(left(role).select(key, order, "role"), [key, order]).groupBy(key, "role").agg(F.min_by(order, "place").alias("pick"))

    picked = picked.unionByName(behind_tenth("low", [F.asc("pitch"), F.asc(order)], 1))
    edge = index_percentiles(rows, key, "rate").select(key, "low")
    slow = left("slow").join(edge, key).where("rate >= low").groupBy(key, "role").agg(F.min_by(order, F.struct("rate", order)).alias("pick"))
    picked = picked.unionByName(slow)
    picked = picked.unionByName(behind_tenth("high", [F.desc("pitch"), F.desc(order)], 4))
    return picked.select(key, "role", F.col("pick").alias(order))


def marks(text: Column) -> tuple[Column, Column]:
    """(different kinds of sentence marks, marks for each character)."""
    count = lambda c: F.length(text) - F.length(F.replace(text, F.lit(c)))
    kinds = [count(c) for c in "?!."]
    n = sum(kinds[1:], kinds[0])
    return sum((k > 0).cast("int") for k in kinds), F.when(F.length(text) > 0, n / F.length(text)).otherwise(0.0)


def dynamic_score(pitch: Column, speed: Column, rhythm: Column, density: Column, variety: Column) -> Column:
    return pitch * 0.30 + speed * 0.30 + rhythm * 0.25 + (density * 10 + variety * 0.5) * 0.15


def outliers(rows: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """Adds n_outliers: metrics strictly outside the index percentiles of their key."""
    out = rows
    for m in metrics:
        edge = index_percentiles(rows, key, m).select(key, F.col("low").alias(f"_l_{m}"), F.col("high").alias(f"_h_{m}"))
        out = out.join(edge, key)
    flags = [((F.col(m) < F.col(f"_l_{m}")) | (F.col(m) > F.col(f"_h_{m}"))).cast("int") for m in metrics]
    return out.withColumn("n_outliers", sum(flags[1:], flags[0])).drop(*(f"_{e}_{m}" for m in metrics for e in "lh"))


def dynamic_picks(rows: DataFrame, key: str = "voice", order: str = "sample", k: int = 3) -> DataFrame:
    """(key, place, sample): k samples by tier, then falling score; needs size, score, n_outliers.

    Tiers: of the largest max(5, int(0.7 n)) those with no, one and more outliers, then all others.
    """
    sized = ranked(rows, key, [F.desc("size"), F.col(order)])
    good = F.col("place") <= F.greatest(F.lit(5), F.floor(F.lit(0.7) * F.col("n")))
    tier = F.when(good, F.least(F.lit(2), F.col("n_outliers"))).otherwise(3)
    w = Window.partitionBy(key).orderBy("tier", F.desc("score"), order)
    out = sized.withColumn("tier", tier).withColumn("pick", F.row_number().over(w)).where(F.col("pick") <= k)
    return out.select(key, F.col("pick").alias("place"), order, "tier")


def variation(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, n, variation: population deviation over mean, 0 where the mean is."""
    out = rows.groupBy(key).agg(F.count(value).alias("n"), F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    return out.select(key, "n", F.when(F.col("_m") != 0, F.col("_s") / F.col("_m")).otherwise(0.0).alias("variation"))
