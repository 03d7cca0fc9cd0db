import random
import re

import xxhash

from utterloom.llm import simhash


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    fps = [brute_fp(t) for _, t in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = part[i], part[j]
                part = [b if x == a else x for x in part]
    least = {p: min((rows[k][0] for k in range(len(rows)) if part[k] == p and rows[k][0] is not None), default=None) for p in part}
    return [(rows[k][0], f"{fps[k]:016x}", least[part[k]]) for k in range(len(rows))]


def made(seed, n=70):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.choice([1, 2, 3, 9, 60]))) for _ in range(12)]
    rows = []
    for k in range(n):
        w = rng.choice(base).split(" ")
        if rng.random() < 0.6:
            w[rng.randrange(len(w))] = rng.choice(["X", "é", "\x0b", "\x85"])
        rows.append((n - k, "\n ".join(w)))
    return [*rows, (500, None), (400, ""), (None, rows[0][1]), (700, "one lone text"), (700, "one lone text")]


def test_against_brute_force(spark):
    for seed in (1, 2):
        rows = made(seed)
        d = spark.createDataFrame([(i, t, 0, "c") for i, t in rows], "doc_id long, text string, fp int, component_id string")
        got = [tuple(r) for r in simhash.near_duplicates(d).collect()]
        assert sorted(got, key=str) == sorted(brute(rows), key=str)
        kept = simhash.keep_one(d)
        assert kept.columns == d.columns
        want = {c if c is not None else f for _, f, c in brute(rows)}
        assert kept.count() == len(want) and {r.doc_id for r in kept.collect()} == want


def test_hot_blocks_lose_no_link(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    fps |= {rng.getrandbits(64) for _ in range(50)}
    d = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    want = {frozenset((a, b)) for a in fps for b in fps if 0 < (a ^ b).bit_count() <= 2}

    def parts(links):
        part = {x: x for x in fps}
        for a, b in map(tuple, links):
            a, b = part[a], part[b]
            part = {x: b if p == a else p for x, p in part.items()}
        return {frozenset(x for x in fps if part[x] == p) for p in part.values()}

    for hot in (2, 10, 1000):
        got = {frozenset((r.u % 2**64, r.v % 2**64)) for r in simhash.close_pairs(d, hot).collect()}
        assert got <= want and parts(got) == parts(want)
        assert hot < 1000 or got == want


def test_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(d).count() == 0 and simhash.keep_one(d).count() == 0
