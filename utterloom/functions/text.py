"""Text functions as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F

# Abbreviations whose point ends no sentence.
ABBREVIATIONS = (
    "Mr. Mrs. Ms. Dr. Prof. Sr. Jr. et. al. etc. e.g. i.e. vs. Ph.D. M.D. B.A. M.A. a.m. p.m. U.S. U.K. St."
).split()
#: Matches an abbreviation inside the last six characters, lower-cased; the test is by substring.
ABBREVIATION_PATTERN = "|".join(sorted({a.lower().replace(".", r"\.") for a in ABBREVIATIONS}))
BREAKS = r"[.!?;,\-]"
STOPS = r"[.!?]"
#: Words, with inner hyphens and apostrophes; the class is that of Unicode letters and digits.
TOKEN = r"[\p{L}\p{N}_]+(?:[-'][\p{L}\p{N}_]+)*"
MAX_QUERY_WORDS = 320


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def token_starts(text: Column) -> Column:
    """0-based character starts of the tokens: lengths of all gaps and tokens before each."""
    found, gaps = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), F.split(text, TOKEN, -1)
    pairs = F.zip_with(found, gaps, lambda t, g: F.struct(F.length(g).alias("g"), F.length(t).alias("t")))
    pairs = F.filter(pairs, lambda x: x["t"].isNotNull())
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda s, x: F.struct(
        (s["at"] + x["g"] + x["t"]).alias("at"), F.concat(s["out"], F.array(s["at"] + x["g"])).alias("out")
    )
    return F.aggregate(pairs, state, step)["out"]


def is_abbreviation(word: Column) -> Column:
    """Whether the last six characters of the word hold an abbreviation."""
    return F.lower(F.right(word, F.lit(6))).rlike(ABBREVIATION_PATTERN)


def is_abbreviation_at(text: Column, pos: Column) -> Column:
    """The same test for a character position inside a text (0-based)."""
    start = F.greatest(F.lit(0), pos - 5)
    return F.lower(F.substring(text, start + 1, pos + 1 - start)).rlike(ABBREVIATION_PATTERN)


def is_break(word: Column, marks: str = BREAKS) -> Column:
    return word.rlike(marks) & ~is_abbreviation(word)


def joined(words: Column) -> Column:
    """Trimmed words, blank ones left out, with single spaces."""
    return F.array_join(F.filter(F.transform(words, F.trim), lambda w: w != ""), " ")


def head_and_tail(words: Column, most: int = MAX_QUERY_WORDS) -> Column:
    """All words, or the first and last halves of ``most``."""
    half = most // 2
    return F.when(F.size(words) <= most, words).otherwise(F.concat(F.slice(words, 1, half), F.slice(words, -half, half)))


def sentence_start(text: Column, start: Column, reach: int = 320) -> Column:
    """start moved back to just behind the last sentence mark, by ``reach`` characters at most (0-based)."""
    low = F.greatest(F.lit(0), start - reach)
    return start - F.length(F.regexp_extract(F.substring(text, low + 1, start - low), r"[^.!?\n]*\z", 0))


def sentence_end(text: Column, end: Column, reach: int = 320) -> Column:
    """end moved on to just behind the next sentence mark, by ``reach`` characters at most (0-based, exclusive)."""
    return end + F.length(F.regexp_extract(F.substring(text, end + 1, F.lit(reach)), r"\A[^.!?\n]*[.!?\n]?", 0))


def real_sentence_end(text: str, pos: int) -> int:
    """Last position that still belongs to the sentence whose mark is at pos.

    White space behind the mark is skipped, and so is everything from an opening bracket to its close; a quote opens and
    never closes, so the sentence then runs to the end of the text.
    """
    if pos >= len(text):
        return pos
    quoted, brackets = False, 0
    for i in range(pos + 1, len(text)):
        c = text[i]
        if c in "\"'":
            quoted = True
        elif c == "(":
            brackets += 1
        elif c == ")":
            brackets -= brackets > 0 and not quoted
        elif c not in " \t\n" and not quoted and not brackets:
            return i - 1
    return len(text) - 1


def real_sentence_end_column(text: Column, pos: Column) -> Column:
    def ends(texts: pd.Series, places: pd.Series) -> pd.Series:
        pairs = zip(texts, places, strict=True)
        return pd.Series([None if t is None or pd.isna(p) else real_sentence_end(t, int(p)) for t, p in pairs], dtype="Int32")

    return F.pandas_udf(ends, "int")(text, pos)


def complete_sentence(text: Column) -> Column:
    """First character upper case, and a sentence mark at the end, perhaps behind closing quotes or brackets."""
    return F.substring(text, 1, 1).rlike(r"^\p{Lu}") & text.rlike(r"""[.!?]([")']|\)"|\)'|"\)|'\)|\)\.)?\z""")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def rewritten(path: Column, old: str, new: str) -> Column:
    """A path below session ``old`` moved below ``new``; any other by name into its folder of processed audio."""
    inside = path.startswith(f"{old}/")
    return F.when(inside, F.concat(F.lit(new), F.substring(path, len(old) + 1, 10_000))).otherwise(
        F.concat(F.lit(f"{new}/audio_sources/processed/"), basename(path))
    )


def chapter_index(stem: Column) -> Column:
    """All digits of the stem as a number, less one; 0 without digits."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_replace(stem, "[^0-9]", ""), F.lit("")), F.lit("9" * 18)).cast("long") - 1, F.lit(0))


def is_old_gpu(name: Column) -> Column:
    """Names of a GPU generation that needs reduced settings."""
    return name.rlike("1060|1070|1080|1660|1650")


def language(code: Column, pairs: dict[str, str]) -> Column:
    """The mapped code, else the code itself."""
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv)), code), code)


def proportion(value: Column) -> Column:
    """7_3 is 0.7: two whole numbers that add up to ten; null for anything else."""
    left, right = F.regexp_extract(value, r"^(\d{1,9})_(\d{1,9})\z", 1), F.regexp_extract(value, r"^(\d{1,9})_(\d{1,9})\z", 2)
    fits = (left != "") & (left.try_cast("int") + right.try_cast("int") == 10)
    return F.when(fits, left.try_cast("int") / 10)


def minutes(seconds: Column) -> Column:
    """Elapsed minutes to two places."""
    return F.round(seconds / 60, 2)
