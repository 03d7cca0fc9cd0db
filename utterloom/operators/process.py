"""From segments and recordings to qualifying segments: offsets, gaps, cut points, slices, effects.

Neighbours and gaps are windows over segment rows. The samples of a recording meet its segments once, in a cogroup by
recording, so long arrays are never repeated for each segment.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from utterloom.functions import signal
from utterloom.operators import segment

RESULT = "file_id long, seg_id int, name string, text string, cut_start_ms long, cut_end_ms long, rate int, samples array<double>, reason string"


@dataclass(frozen=True)
class Processing:
    offset_ms: int = 50
    min_gap_ms: int | None = None
    discard_abrupt: bool = False
    start_window_ms: int = 100
    end_window_ms: int = 300
    target_rate: int | None = None
    loudness: float | None = None
    compress: str | None = None
    deess: str | None = None
    trim: bool = False
    fade: tuple[int, int] = (30, 40)


def timed_segments(segments: DataFrame, words: DataFrame, offset_ms: int = 50) -> DataFrame:
    """Segments with start_ms and end_ms, which is moved forward by the offset of their last word.

    Segments name the words that they hold. Both meet by recording, a row each with its words and its segments, so that
    frames that are dealt out by recording already are not dealt out again.
    """
    ws = words.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("pos", "start_ms", "end_ms", "word"))).alias("ws"))
    first = F.get("ws.pos", F.lit(0))
    whole = F.size(F.filter("ws", lambda x, i: x["pos"] != first + i)) == 0
    ws = ws.select("file_id", "ws", first.alias("first"), whole.alias("whole"))
    held = segments.groupBy("file_id").agg(F.collect_list(F.struct("seg_id", "text", F.least("w_from", "w_to").alias("a"), F.greatest("w_from", "w_to").alias("b"), (F.col("w_from") + F.col("w_to")).alias("both"))).alias("x"))

    def span(x: Column) -> Column:
        a = F.greatest(x["a"] - F.col("first"), F.lit(0)).cast("int")
        n = F.greatest(x["b"] - F.col("first") + 1 - a, F.lit(0)).cast("int")
        inside = F.when(F.col("whole"), F.slice("ws", a + 1, n)).otherwise(F.filter("ws", lambda w: w["pos"].between(x["a"], x["b"])))
        return F.when(x["both"].isNotNull(), inside)

    def timed(x: Column) -> Column:
        def ends(w: Column) -> Column:
            begun, done = F.filter(w, lambda y: y["start_ms"].isNotNull()), F.filter(w, lambda y: y["end_ms"].isNotNull())
            start, last = F.get(begun, F.lit(0))["start_ms"], F.get(w, F.size(w) - 1)["word"]
            last_end, last_start = F.get(done, F.size(done) - 1)["end_ms"], F.get(begun, F.size(begun) - 1)["start_ms"]
            return F.struct(x["seg_id"].alias("seg_id"), x["text"].alias("text"), F.size(w).alias("held"), start.alias("start_ms"), last_end.alias("last_end"), last.alias("last_word"), last_start.alias("last_start"))

        return F.get(F.transform(F.array(span(x)), ends), F.lit(0))

    out = held.hint("merge").join(ws, "file_id").select("file_id", F.inline(F.transform("x", timed))).where("held > 0").drop("held")
    end = segment.offset_end(F.col("last_word"), F.col("last_start"), F.col("last_end"), offset_ms)
    return out.withColumn("end_ms", end).drop("last_word", "last_start", "last_end")


def neighbours(segments: DataFrame, part: str = "file_id", order: str = "seg_id") -> DataFrame:
    """Adds index (from 0), prev_word_end and next_word_start, among the segments given."""
    w = Window.partitionBy(part).orderBy(order)
    out = segments.withColumn("index", F.row_number().over(w) - 1)
    return out.withColumn("prev_word_end", F.lag("end_ms").over(w)).withColumn("next_word_start", F.lead("start_ms").over(w))


def quietest(samples: np.ndarray, rate: int, start_ms: int, end_ms: int, most_ms: int, at_start: bool) -> int:
    """Milliseconds of the quietest place of a window: its 2 ms part with least energy, there the least sample.

    Of a window over ``most_ms`` the last part is searched for a start, the first for an end; the place is counted from
    the window's own beginning either way, as the known tool counts it.
    """
    if end_ms <= start_ms:
        return start_ms
    first, last = start_ms, end_ms
    if end_ms - start_ms > most_ms:
        start_ms, end_ms = (end_ms - most_ms, end_ms) if at_start else (start_ms, start_ms + most_ms)
    part = samples[start_ms * rate // 1000 : end_ms * rate // 1000]
    n = (end_ms - start_ms) // 2
    if n < 1 or len(part) < n:
        return (first + last) // 2
    pieces = [part[i * len(part) // n : (i + 1) * len(part) // n] for i in range(n)]
    silent = [np.mean(np.abs(p) < signal.SILENT) > 0.95 for p in pieces]
    level = [20 * np.log10(max(np.sqrt(np.mean(p**2)), signal.QUIET)) for p in pieces]
    k = min(range(n), key=lambda i: (not silent[i], level[i], i))
    inside = int(np.argmin(np.abs(pieces[k]))) / len(pieces[k]) * 2
    return int(min(last, max(first, first + k * (end_ms - start_ms) / n + inside)))


def cut_points(segments: DataFrame, audio: DataFrame, config: Processing = Processing()) -> DataFrame:
    """Where each segment is cut: its columns, index, search windows, cut_start_ms, cut_end_ms (null without audio).

    segments has file_id, seg_id, start_ms, end_ms; audio has file_id, rate, samples, and audio_ms if that is known.
    Neighbours are those given: what the gap filter drops is left out before. Samples are met as ``audio`` has them: if it
    is dealt out and sorted by recording before they are made, they are neither shuffled nor sorted.
    """
    known = F.col("audio_ms") if "audio_ms" in audio.columns else F.floor(F.size("samples") * 1000 / F.col("rate")).cast("long")
    length, audio = audio.select("file_id", known.alias("audio_ms")), audio.select("file_id", "rate", "samples")
    windows = segment.cut_windows(neighbours(segments).hint("merge").join(length, "file_id", "left"))
    schema = f"{windows._jdf.schema().toDDL()}, cut_start_ms BIGINT, cut_end_ms BIGINT"

    def one(key, rows: pd.DataFrame, files: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("seg_id")
        cuts = [(None, None)] * len(rows)
        if len(files) and len(files.samples.iloc[0]):
            rate, whole = int(files.rate.iloc[0]), np.asarray(files.samples.iloc[0], np.float64)
            cuts = [
                (
                    quietest(whole, rate, int(r.start_from), int(r.start_ms), config.start_window_ms, True),
                    quietest(whole, rate, int(r.end_ms), int(r.end_to), config.end_window_ms, False),
                )
                for r in rows.itertuples()
            ]
        out = rows.assign(cut_start_ms=[a for a, _ in cuts], cut_end_ms=[b for _, b in cuts])
        return out.astype({"cut_start_ms": "Int64", "cut_end_ms": "Int64"})

    return windows.groupBy("file_id").cogroup(audio.groupBy("file_id")).applyInPandas(one, schema)


def process(segments: DataFrame, words: DataFrame, audio: DataFrame, config: Processing = Processing()) -> DataFrame:
    """Every segment with its samples or the reason why it goes: file_id, seg_id, name, text, cuts, rate, samples, reason.

    audio has file_id, rate, samples. ``reason`` is null for qualifying segments, else: small gap, no audio, abrupt
    ending (only with discard_abrupt), effects failed. Names count the segments that the gap filter leaves.
    """
    timed = segment.min_gap(timed_segments(segments, words, config.offset_ms), config.min_gap_ms)
    points = cut_points(timed.where("kept").select("file_id", "seg_id", "text", "start_ms", "end_ms"), audio, config)
    points = points.select("file_id", "seg_id", "text", F.col("index").alias("place"), "cut_start_ms", "cut_end_ms")

    def one(key, rows: pd.DataFrame, files: pd.DataFrame) -> pd.DataFrame:
        rate, whole = (int(files.rate.iloc[0]), np.asarray(files.samples.iloc[0], np.float64)) if len(files) else (0, np.zeros(0))
        out = []
        for r in rows.sort_values("seg_id").itertuples():
            cuts, samples, reason = (None, None), None, None if len(whole) else "no audio"
            if reason is None:
                a, b = cuts = int(r.cut_start_ms), int(r.cut_end_ms)
                samples = whole[a * rate // 1000 : b * rate // 1000]
                if config.discard_abrupt and signal.ends_abruptly(samples, rate):
                    samples, reason = None, "abrupt ending"
            if reason is None:
                samples = signal.effects(samples, rate, config.target_rate, config.loudness, config.compress, config.deess, config.trim, config.fade)
                reason = "effects failed" if samples is None else None
            out.append((key[0], r.seg_id, f"{key[0]}_segment_{r.place}", r.text, *cuts, config.target_rate or rate, samples, reason))
        done = pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])
        return done.astype({"cut_start_ms": "Int64", "cut_end_ms": "Int64"})

    audio = audio.select("file_id", "rate", "samples")
    done = points.groupBy("file_id").cogroup(audio.groupBy("file_id")).applyInPandas(one, RESULT)
    gone = timed.where("NOT kept").select("file_id", "seg_id", "text", F.lit("small gap").alias("reason"))
    return done.unionByName(gone, allowMissingColumns=True)


def slices(segments: DataFrame, audio: DataFrame) -> DataFrame:
    """segments (file_id, start_ms, end_ms) with their samples: those from start up to but not with end."""
    at = lambda c: F.floor(F.col(c) * F.col("rate") / 1000).cast("int")
    n = F.greatest(F.lit(0), at("end_ms") - at("start_ms"))
    return segments.join(audio, "file_id").withColumn("samples", F.slice("samples", at("start_ms") + 1, n)).drop("rate")


def effects_wanted(config: DataFrame) -> Column:
    """Whether any option asks for the effects chain; a fade does unless it is 0."""
    asked = F.col("normalize").isNotNull() | F.col("compress").isNotNull()
    flags = [F.coalesce(F.col(c), F.lit(False)) for c in ("dess", "denoise", "trim")]
    fades = (F.col("fade_in") > 0) | (F.col("fade_out") > 0)
    return asked | flags[0] | flags[1] | flags[2] | fades


def qualifying(rows: DataFrame, speaker: str = "001") -> DataFrame:
    """(audio_file, text, speaker_name) of the segments that stay."""
    kept = rows.where("reason IS NULL")
    return kept.select(F.concat("name", F.lit(".wav")).alias("audio_file"), "text", F.lit(speaker).alias("speaker_name"))


def discards(rows: DataFrame) -> DataFrame:
    """(reason, n) of all segments; those that stay under 'kept'."""
    return rows.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def recognised(sources: list[Column]) -> Column:
    """The first of several recognisers' results that is there."""
    return F.coalesce(*sources)
