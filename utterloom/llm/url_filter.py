"""URL filter: rules first, then word segmentation and multinomial naive Bayes.

Concatenated names in hosts are split into words by a unigram Viterbi search; naive Bayes then scores the words of host
and path. Word counts come from the titles of all pages and the labelled sample; the classifier from the labelled
sample alone. Both models are broadcast: the vocabulary has a bound of its own (MAX_WORDS most frequent words that
come at least MIN_COUNT times), whatever the number of pages; it never decides which pages are judged.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from utterloom.llm.common import arrow_pass

# Rules (host, path prefix, verdict); a rule holds for its host and all subdomains.
RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]
# Words of the labelled sample, by label.
BLOCK_WORDS = (
    "casino poker bet betting slots jackpot roulette lottery gambling bingo porn sex xxx nude adult escort cams fetish hentai "
    "viagra cialis pills pharmacy loan loans payday credit cheap replica torrent warez crack keygen cracked nulled free money "
    "rich quick miracle diet hot girls dating hookup singles spam proxy vpn clickbait win prize bonus spins sexy erotic naked"
).split()
ALLOW_WORDS = (
    "news wiki blog school university college library museum science history research journal article articles archive "
    "docs documentation guide manual learn learning course courses education health hospital weather map maps travel city "
    "government council public service services community forum support help about contact people culture music art book "
    "books review reviews recipe recipes food garden home family sport sports football technology software code developer "
    "open source data project projects world local times post daily press report story stories index page en de fr es"
).split()
MIN_COUNT = 2
MAX_WORDS = 200_000
#: Log-probability ratio from which a page without a rule is blocked.
THRESHOLD = 1.0
_LETTERS = re.compile(r"[^\W\d_]+")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host after the first :// up to /, ?, # or the end, A-Z lower-cased; both empty without ://."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = re.search(r"[/?#]", rest)
    host, rest = (rest[: end.start()], rest[end.start() :]) if end else (rest, "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return host, re.split(r"[?#]", rest, maxsplit=1)[0]


def rule_of(host: str, path: str, rules: list[tuple[str, str, str]] = RULES) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule that fits; of equally long ones the first in the list."""
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0]) + len(r[1]), default=None)
    return best and (best[0] + best[1], best[2])


def labelled_sample() -> list[tuple[list[str], str]]:
    """(words, label): each sample pairs two words of one label, as names and paths do."""
    out = []
    for label, words in (("block", BLOCK_WORDS), ("allow", ALLOW_WORDS)):
        out += [([w, words[(7 * k + 3) % len(words)]], label) for k, w in enumerate(words)]
    return out


@dataclass
class Segmenter:
    """Unigram Viterbi: the split of a name with the greatest product of word probabilities."""

    counts: dict[str, int]

    def __post_init__(self):
        self.total = sum(self.counts.values()) + 1
        self.longest = min(24, max(map(len, self.counts), default=1))
        self.log = {w: math.log(n / self.total) for w, n in self.counts.items()}

    def cost(self, word: str) -> float:
        """Unknown words get less probability, the longer they are: ten times for each letter."""
        return self.log.get(word, -math.log(self.total) - 2.3 * len(word))

    def __call__(self, name: str) -> list[str]:
        best, back = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
        for end in range(1, len(name) + 1):
            for start in range(max(0, end - self.longest), end):
                score = best[start] + self.cost(name[start:end])
                if score > best[end]:
                    best[end], back[end] = score, start
        out, at = [], len(name)
        while at:
            out.append(name[back[at] : at])
            at = back[at]
        return out[::-1]


@dataclass
class NaiveBayes:
    """Multinomial naive Bayes of two labels with add-one smoothing; words it never saw say nothing."""

    words: dict[str, float]  # log P(word | block) - log P(word | allow)
    prior: float

    @classmethod
    def fit(cls, sample: Iterable[tuple[list[str], str]]) -> NaiveBayes:
        seen, docs = {"block": Counter(), "allow": Counter()}, Counter()
        for words, label in sample:
            seen[label].update(words)
            docs[label] += 1
        vocabulary = seen["block"].keys() | seen["allow"].keys()
        size = {k: sum(c.values()) + len(vocabulary) for k, c in seen.items()}
        log = lambda w, k: math.log((seen[k][w] + 1) / size[k])
        prior = math.log((docs["block"] + 1) / (docs["allow"] + 1))
        return cls({w: log(w, "block") - log(w, "allow") for w in vocabulary}, prior)

    def score(self, words: Iterable[str]) -> float:
        return self.prior + sum(self.words.get(w, 0.0) for w in words)


def tokens(host: str, path: str, segment: Segmenter) -> list[str]:
    """Words of host and path: runs of letters, those of the host segmented."""
    names = _LETTERS.findall(host)
    return [w for name in names for w in segment(name)] + [w.lower() for w in _LETTERS.findall(path)]


def word_counts(pages: DataFrame) -> dict[str, int]:
    """Counts of lower-cased title words over all pages, and those of the labelled sample."""
    title = F.regexp_extract(F.coalesce(F.col("html").cast("string"), F.lit("")), "(?is)<title[^>]*>([^<]*)</title>", 1)
    words = pages.select(F.explode(F.regexp_extract_all(F.lower(title), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    counts = words.where(F.length("w") <= 24).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)
    out = {r.w: r.n for r in counts.orderBy(F.desc("n"), "w").limit(MAX_WORDS).collect()}
    for words_, _ in labelled_sample():
        for w in words_:
            out[w] = out.get(w, 0) + 20
    return out


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict, score, words.

    ``rule`` is the longest rule that fits, else null; ``verdict`` the rule's, else block where the score of naive Bayes
    passes the threshold. Null urls and urls without :// have empty host and path and no words: allowed, unless the
    threshold is below the prior. Repeated rows repeat; an empty table gives no rows.
    """
    sent = pages.sparkSession.sparkContext.broadcast((Segmenter(word_counts(pages)), NaiveBayes.fit(labelled_sample())))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, bayes = sent.value
        kept: dict[str, list[str]] = {}

        def split(name: str) -> list[str]:
            if name not in kept:
                if len(kept) > 100_000:
                    kept.clear()
                kept[name] = segment(name)
            return kept[name]

        def row(url: str | None) -> tuple:
            host, path = split_url(url)
            words, rule = tokens(host, path, split), rule_of(host, path, rules)
            score = bayes.score(words)
            return host, path, rule and rule[0], rule[1] if rule else "block" if score > threshold else "allow", score, " ".join(words)

        for batch in batches:
            got = list(zip(*map(row, batch.column(1).to_pylist()), strict=True)) or [()] * 6
            types = [pa.string()] * 4 + [pa.float64(), pa.string()]
            columns = [batch.column(0), *map(pa.array, map(list, got), types)]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict", "score", "words"])

    chosen = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    return arrow_pass(chosen, rows, "page_id long, host string, path string, rule string, verdict string, score double, words string")
