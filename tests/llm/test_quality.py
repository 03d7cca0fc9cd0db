import collections
import math
import re

from utterloom.llm import quality
from utterloom.llm.quality import COMMON_WORDS, Limits


def base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = collections.Counter(grams)
    rep = {k for i, g in enumerate(grams) if n[g] > 1 for k in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep),
        len(w) < 10 or 100 * len(rep) > 20 * len(w),
    )


def js(p, q):
    if not sum(p) or not sum(q):
        return 0.0
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    k = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b, strict=True) if x > 0)
    return math.sqrt(max(0.0, (k(p, q) + k(q, p)) / 2))


def histograms(t, lang):
    t = t or ""
    count = lambda p: len(re.findall(p, t))
    up, dg, sy, ws, far = count("[A-Z]"), count("[0-9]"), count(r"[#*$%&|<>]"), count(r"[\x20\x09-\x0D]"), count(r"[^\x00-\x7F]")
    pt = count(r"[!\x22'(),\-./:;?\[\]_{}~=+@`^\x5c]")
    c = collections.Counter(re.findall(r"[^\x20\x09-\x0D]+", t))
    hits = [c[x] for x in COMMON_WORDS[lang].split()] if lang in COMMON_WORDS else []
    return [len(t) - up - dg - sy - ws - far - pt, up, dg, ws, pt, sy, far], hits + [sum(c.values()) - sum(hits)] * bool(hits)


def brute(rows):
    lim = Limits()
    b, h = [base(t) for _, t, _ in rows], [histograms(t, lang) for _, t, lang in rows]

    def refs(which):
        out = {}
        for k in which:
            a = out.setdefault(rows[k][2], [[0] * len(x) for x in h[k]])
            for x, y in zip(a, h[k], strict=True):
                x[:] = [u + v for u, v in zip(x, y, strict=True)]
        return out

    def off(k, ref):
        n, r = b[k][0], ref.get(rows[k][2], [[], []])
        chars, common = (js(x, y) if y else 0.0 for x, y in zip(h[k], r, strict=True))
        one = n >= lim.min_words and (chars > lim.chars or (chars > lim.joint_chars and common > lim.joint_words))
        return one or (n >= lim.min_words_alone and common > lim.words_alone)

    passed = [k for k in range(len(rows)) if not b[k][5]]
    first = refs(passed)
    ref = refs([k for k in passed if b[k][0] >= lim.min_words and not off(k, first)])
    return [(rows[k][0], *b[k], not b[k][5] and not off(k, ref)) for k in range(len(rows))]


def test_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.collect()]
    rows += [(900, None, "en"), (901, "", None), (902, "a b c\n" * 30, "xx"), (None, "Ünï " * 12, None), (903, rows[0][1], "en")]
    rows += [(904, "the\x0bof\x0cx\ty " * 4 + "\n \n\n|a|", "en"), (904, "x y z w v " * 20, "fr")]
    d = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, lang string, n_words int, kept string")
    got = quality.judged(d)
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, brute(rows)))
    kept = quality.keep_good(d)
    assert kept.columns == d.columns
    assert kept.count() == sum(x[-1] for x in brute(rows))


def test_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert quality.judged(d).count() == 0 and quality.keep_good(d).count() == 0


def test_no_python_in_the_plan(spark):
    d = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")
    plan = quality.features(d)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
