"""Timed words cut into segments by greedy, limit-aware folds over each recording.

A recording's words fit in one task by nature (hours of speech are some ten thousand words). The folds keep a handful of
scalars; words without times never enter a fold and ride along by position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from utterloom.functions.text import ABBREVIATION_PATTERN, BREAKS, STOPS

_ABBREVIATION, _BREAKS, _STOPS = re.compile(ABBREVIATION_PATTERN), re.compile(BREAKS), re.compile(STOPS)
SEGMENTS = "file_id long, seg_id int, w_from int, w_to int, n_words int, duration double, text string"


@dataclass(frozen=True)
class Limits:
    max_ms: int = 11_000
    max_chars: int = 200
    min_ms: int = 2_000  # punctuation-only
    share: float = 0.6  # mixed: the part that is cut by maximise-punctuation


@dataclass(frozen=True)
class Word:
    pos: int
    word: str
    start: int | None
    end: int | None


def breaks(word: str, marks: re.Pattern[str] = _BREAKS) -> bool:
    return bool(marks.search(word)) and not _ABBREVIATION.search(word[-6:].lower())


def _lengths(words: list[Word]) -> list[int]:
    """Characters of the joined text up to and with each word, a space counted behind each."""
    out, total = [], 0
    for w in words:
        total += len(w.word.strip()) + 1 if w.word.strip() else 0
        out.append(total)
    return out


def maximise(words: list[Word], limits: Limits) -> Iterator[tuple[int, int]]:
    """Segments as index ranges, both ends included: as long as the limits allow, up to the last break within them."""
    total = _lengths(words)
    first = at_break = None  # index, characters before, start of the first timed word
    last_end = 0
    timed = [k for k, w in enumerate(words) if w.start is not None and w.end is not None]
    after = dict(zip(timed, [*timed[1:], None], strict=False))
    for k in timed:
        w = words[k]
        if first and last_end - first[2] > limits.max_ms:
            first = at_break = None
        if not first:
            first = (k, total[k - 1] if k else 0, w.start)
        if w.end - first[2] <= limits.max_ms and total[k] - first[1] - 1 <= limits.max_chars:
            if breaks(w.word):
                at_break = k
        elif at_break is not None:
            yield first[0], at_break
            first, at_break = (at_break + 1, total[at_break], words[after[at_break]].start), None
        else:
            first = None
        last_end = w.end
    if first and at_break is not None:
        yield first[0], at_break


def punctuation_only(words: list[Word], limits: Limits) -> Iterator[tuple[int, int]]:
    """Segments end at every break that is far enough from their start; what overflows is dropped up to its last word."""
    total, first = _lengths(words), None
    for k, w in enumerate(words):
        if w.start is None or w.end is None:
            continue
        if first is None:
            first = k
            continue
        took = w.end - words[first].start
        chars = total[k] - (total[first - 1] if first else 0) - 1
        if took > limits.max_ms or chars > limits.max_chars:
            first = k
        elif took >= limits.min_ms and breaks(w.word):
            yield first, k
            first = None


def split_at(words: list[Word], share: float) -> int | None:
    """The sentence end whose prefix lasts nearest to ``share`` of the whole, the first of equals."""
    timed = [w for w in words if w.start is not None and w.end is not None]
    if not timed:
        return None
    target, best = (timed[-1].end - timed[0].start) * share, None
    for k, w in enumerate(words):
        if w.start is not None and w.end is not None and breaks(w.word, _STOPS):
            far = abs(w.end - timed[0].start - target)
            if best is None or far < best[0]:
                best = far, k
    return best and best[1]


def mixed(words: list[Word], limits: Limits) -> Iterator[tuple[int, int]]:
    """Up to the split by maximise-punctuation, behind it by punctuation-only; all by the former without a split."""
    at = split_at(words, limits.share)
    if at is None:
        yield from maximise(words, limits)
        return
    yield from maximise(words[: at + 1], limits)
    for a, b in punctuation_only(words[at + 1 :], limits):
        yield a + at + 1, b + at + 1


METHODS = {"maximise-punctuation": maximise, "punctuation-only": punctuation_only, "mixed": mixed}


def cut(words: DataFrame, method: str = "maximise-punctuation", limits: Limits = Limits()) -> DataFrame:
    """Segments of (file_id, pos, word, start_ms, end_ms): file_id, seg_id, w_from, w_to, n_words, duration, text.

    Words without both times belong to the segment around them. A recording without breaks has no segments.
    """
    fold = METHODS[method]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, out = pdf.sort_values("pos"), []
        have = lambda x: None if pd.isna(x) else int(x)
        ws = [Word(int(p), w or "", have(s), have(e)) for p, w, s, e in zip(pdf.pos, pdf.word, pdf.start_ms, pdf.end_ms, strict=True)]
        for a, b in fold(ws, limits):
            timed = [w for w in ws[a : b + 1] if w.start is not None and w.end is not None]
            text = " ".join(w.word.strip() for w in ws[a : b + 1] if w.word.strip())
            if timed and text:
                took = (timed[-1].end - timed[0].start) / 1000
                out.append((pdf.file_id.iloc[0], len(out), ws[a].pos, ws[b].pos, b - a + 1, took, text))
        return pd.DataFrame(out, columns=[c.split()[0] for c in SEGMENTS.split(", ")])

    return words.groupBy("file_id").applyInPandas(one, SEGMENTS)


def min_gap(rows: DataFrame, gap: int | None, part: str = "file_id", order: str = "seg_id") -> DataFrame:
    """Adds prev_gap, next_gap, kept: both sides of a gap under ``gap`` go; neighbours count whether they stay or not.

    A gap that can't be measured, or a gap of None or 0, drops nothing.
    """
    w = Window.partitionBy(part).orderBy(order)
    out = rows.withColumn("prev_gap", F.col("start_ms") - F.lag("end_ms").over(w)).withColumn("next_gap", F.lead("start_ms").over(w) - F.col("end_ms"))
    low = lambda c: F.coalesce(F.col(c) < gap, F.lit(False)) if gap else F.lit(False)
    return out.withColumn("kept", ~(low("prev_gap") | low("next_gap")))


def offset_end(word: Column, start: Column, end: Column, offset_ms: int = 50) -> Column:
    """The end of a last word moved forward, twice as far behind a sentence mark, never before its start."""
    by = F.when(F.trim(word).rlike(r"[.!?]\z"), 2 * offset_ms).otherwise(offset_ms)
    return F.greatest(start, end - by)


def cut_windows(segments: DataFrame) -> DataFrame:
    """Where the cuts of a segment may lie, from its neighbours: search windows in milliseconds.

    Needs file_id, seg_id, start_ms, end_ms, prev_word_end, next_word_start, audio_ms. A start with a gap under 150 ms
    is searched from the previous word (50 ms at least), else it is 150 ms early; an end with a gap under 400 ms is
    searched up to the next word, else it is 400 ms late, within the audio.
    """
    gap_before, gap_after = F.col("start_ms") - F.col("prev_word_end"), F.col("next_word_start") - F.col("end_ms")
    near, close = F.coalesce(gap_before < 150, F.lit(False)), F.coalesce(gap_after < 400, F.lit(False))
    early = F.least(F.col("prev_word_end"), F.col("start_ms") - 50)
    return (
        segments.withColumn("search_start", near)
        .withColumn("start_from", F.greatest(F.lit(0), F.when(near, early).otherwise(F.col("start_ms") - 150)))
        .withColumn("search_end", close)
        .withColumn("end_to", F.least(F.col("audio_ms"), F.when(close, F.col("next_word_start")).otherwise(F.col("end_ms") + 400)))
    )
