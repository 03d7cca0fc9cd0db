import hashlib
import random
import re

from utterloom.llm import decontam

DOCS = "doc_id long, text string, spans string"


def brute(docs, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, text in items:
            v = words(text)
            for k in range(max(1, len(v) - window + 1) if v else 0):
                p = v[k : k + window]
                for at in range(len(w) - len(p) + 1):
                    if w[at : at + len(p)] == p:
                        hit.update(range(at, at + len(p)))
                        ids.add(str(item))
        ids = sorted(ids)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def made(seed, n=60):
    rng = random.Random(seed)
    vocab = ["the", "Of", "é", "a1", "naïve", "x", "日本"]
    text = lambda m: "".join(rng.choice(vocab) + rng.choice([" ", ", ", "\n", " - "]) for _ in range(m))
    items = [(k, text(rng.choice([0, 1, 3, 10, 14]))) for k in range(12)] + [(12, None)]
    docs = [(k, text(rng.randint(0, 40)) + rng.choice([t or "" for _, t in items]) + text(5)) for k in range(n)]
    return [*docs, (n, None), (n + 1, ""), (0, docs[0][1])], items


def test_against_brute_force(spark, monkeypatch):
    for seed, block in ((1, 16 << 20), (2, 60)):
        monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
        docs, items = made(seed)
        d = spark.createDataFrame([(i, t, "x") for i, t in docs], DOCS)
        got = decontam.contamination(d, spark.createDataFrame(items, "item_id long, text string"))
        rows = [tuple(r)[:6] for r in got.collect()]
        assert sorted(rows, key=str) == brute(docs, items)


def test_small_shards_and_empty_tables(spark, monkeypatch):
    docs, items = made(3, 20)
    ids = decontam.Phrases([(i, (t or "").encode()) for i, t in items], 10)
    assert decontam.search_shard(ids, []) == []
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], DOCS)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(d, none).where("contaminated").count() == 0
    assert decontam.contamination(d.limit(0), none).count() == 0


def test_remove_cuts_spans_only(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(1, f"Before, {item.upper()}! After.", "s"), (2, item, "s"), (3, "clean text", "s"), (4, None, "s"), (5, "", "s")]
    d = spark.createDataFrame(rows, DOCS)
    got = decontam.remove(d, spark.createDataFrame([(9, item)], "item_id long, text string"))
    assert got.columns == d.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, "Before, ! After."), (3, "clean text"), (4, None), (5, "")]
