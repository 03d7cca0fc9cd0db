"""Quality rules: fixed base rules, then divergence from language references. DataFrame functions only.

Each document gets two histograms: classes of characters, and the common words of its language against all other
words. Their Jensen-Shannon distances (base 2) to the reference of its language decide. A reference is the sum of the
histograms of all documents of the language that pass the base rules, taken once more without those that the first
reference finds far off. Short documents are not judged by histograms: distances of few words mean little.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from utterloom.llm.common import cut, text_of, unique_name, words_of

# Common words of four languages.
COMMON_WORDS = {
    "de": "der die und in den von zu das sich mit des auf für ist im nicht dem ein eine als",
    "en": "the of and to a in is that it for was on with as be by are this at from",
    "es": "de la que el en y los las se del un por con no una su para es al lo",
    "fr": "de la le et les en des un du une que est pour par dans avec qui pas sur au",
}
#: More references than this are joined by a shuffle instead of being broadcast.
BROADCAST_LANGUAGES = 10_000
WINDOW = 5


@dataclass(frozen=True)
class Limits:
    """Distances beyond which a document goes, and the words from which it is judged at all."""

    min_words: int = 50
    chars: float = 0.30
    joint_chars: float = 0.16
    joint_words: float = 0.25
    min_words_alone: int = 100
    words_alone: float = 0.28


def _let(value: Column, body) -> Column:
    """body(value), with value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that come twice or more; windows are compared by 64-bit hashes."""
    n = F.size(words)

    def windows(h: Column) -> Column:
        at = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW))))

    def covered(win: Column) -> Column:
        return _let(F.array_sort(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), _from_sorted)

    def _from_sorted(s: Column) -> Column:
        twice = F.filter(
            s,
            lambda x, i: (x["h"] == F.when(i > 0, F.get(s, i - 1)["h"])).eqNullSafe(F.lit(True))
            | (x["h"] == F.get(s, i + 1)["h"]).eqNullSafe(F.lit(True)),
        )
        return _let(F.array_sort(F.transform(twice, lambda x: x["i"])), _length)

    def _length(pos: Column) -> Column:
        each = F.transform(pos, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(pos, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(each, F.lit(0), lambda a, x: a + x)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return _let(
        _let(hashed, windows),
        lambda win: F.when(F.size(F.array_distinct(win)) < F.size(win), covered(win)).otherwise(F.lit(0)),
    ).cast("long")


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, chars, ""))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, lang, the counts of the base rules, base_failed, chars, common), a row for each row of docs."""
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text_of().alias("t")
    )
    lists = F.create_map(*(x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v.split())))))
    known = F.coalesce(F.when(F.col("lang").isin(list(COMMON_WORDS)), F.element_at(lists, F.col("lang"))), F.array().cast("array<string>"))
    split = given.select("*", words_of(F.col("t")).alias("w"), F.xxhash64("t").alias("digest"), known.alias("known"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    counted = split.select(
        "doc_id", "digest", "lang", "known",
        F.size("w").cast("long").alias("n_words"),
        F.length("t").cast("long").alias("n_chars"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _without(F.col("t"), r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
        _without(F.col("t"), "[A-Z]+").cast("long").alias("upper"),
        _without(F.col("t"), "[0-9]+").cast("long").alias("digits"),
        _without(F.col("t"), r"[!\x22'(),\-./:;?\[\]_{}~=+@`^\x5c]+").cast("long").alias("points"),
        _without(F.col("t"), r"[^\x00-\x7F]+").cast("long").alias("beyond"),
        _let(
            F.filter("w", lambda w: F.array_contains("known", w)),
            lambda c: F.transform("known", lambda k: F.size(F.filter(c, lambda x: x == k)).cast("double")),
        ).alias("hits"),
    )
    space = F.col("n_chars") - F.col("word_chars")
    letters = F.col("word_chars") - F.col("upper") - F.col("digits") - F.col("points") - F.col("n_symbols") - F.col("beyond")
    chars = [letters, F.col("upper"), F.col("digits"), space, F.col("points"), F.col("n_symbols"), F.col("beyond")]
    rest = F.col("n_words") - F.aggregate("hits", F.lit(0.0), lambda a, x: a + x)
    return counted.select(
        "doc_id", "digest", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        F.array(*(c.cast("double") for c in chars)).alias("chars"),
        F.when(F.size("known") > 0, F.concat("hits", F.array(rest))).otherwise(F.array().cast("array<double>")).alias("common"),
    )


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms; 0 where either is empty."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, b: a + b)
    term = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)
    both = F.zip_with(p, q, lambda x, y: term(x / total(p), y / total(q)) + term(y / total(q), x / total(p)))
    far = F.sqrt(F.greatest(F.lit(0.0), F.aggregate(both, F.lit(0.0), lambda a, x: a + x) / 2))
    return F.when((total(p) > 0) & (total(q) > 0), far).otherwise(0.0)


def references(rows: DataFrame) -> DataFrame:
    """(ref_lang, ref_chars, ref_common): summed histograms of each language."""
    wide = {"chars": 7, "common": max(len(v.split()) for v in COMMON_WORDS.values()) + 1}
    sums = [F.sum(F.coalesce(F.get(c, F.lit(i)), F.lit(0.0))).alias(f"{c}{i}") for c, n in wide.items() for i in range(n)]
    summed = rows.groupBy("lang").agg(*sums)
    arrays = [F.array(*(F.col(f"{c}{i}") for i in range(n))).alias(f"ref_{c}") for c, n in wide.items()]
    return cut(summed.select(F.col("lang").alias("ref_lang"), *arrays))


def _measured(rows: DataFrame, refs: DataFrame) -> DataFrame:
    few = refs.limit(BROADCAST_LANGUAGES + 1).count() <= BROADCAST_LANGUAGES
    joined = rows.join(F.broadcast(refs) if few else refs, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    none = F.array().cast("array<double>")
    far = [
        _distance(F.col(c), F.slice(F.coalesce(F.col(f"ref_{c}"), none), F.lit(1), F.size(c))).alias(f"far_{c}")
        for c in ("chars", "common")
    ]
    return joined.select(*rows.columns, *far)


def _off(limits: Limits) -> Column:
    chars, common, n = F.col("far_chars"), F.col("far_common"), F.col("n_words")
    judged = (chars > limits.chars) | ((chars > limits.joint_chars) & (common > limits.joint_words))
    return ((n >= limits.min_words) & judged) | ((n >= limits.min_words_alone) & (common > limits.words_alone))


def judged(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per row of docs: doc_id, digest, n_words, the base counts, base_failed, far_chars, far_common, kept.

    Null text has no words and fails the base rules. A language without a list of common words, null included, is
    judged by characters alone, against its own reference. An empty table gives no rows; repeated rows repeat.
    """
    rows = cut(features(docs))
    passed = rows.where("not base_failed")
    near = _measured(passed, references(passed)).where((F.col("n_words") >= limits.min_words) & ~_off(limits))
    final = _measured(rows, references(near.select(*rows.columns)))
    return final.withColumn("kept", ~F.col("base_failed") & ~_off(limits)).drop("chars", "common", "lang")


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """docs without the rows that the rules reject; all columns come back under their names."""
    key, digest = unique_name(docs, "quality_key"), unique_name(docs, "quality_digest")
    bad = judged(docs, limits).where("not kept").select(F.col("doc_id").alias(key), F.col("digest").alias(digest)).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(text_of()) == F.col(digest))
    return docs.join(bad, same, "left_anti")
