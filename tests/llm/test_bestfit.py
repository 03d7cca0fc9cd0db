import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from utterloom.llm import bestfit
from utterloom.llm.bestfit import best_fit_decreasing, matrix

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain(lengths, capacity):
    """Best fit decreasing by looking at every open row; row contents by length only."""
    rows = []
    for n in sorted(lengths, reverse=True):
        open_rows = [r for r in rows if capacity - sum(r) >= n]
        if open_rows:
            min(open_rows, key=lambda r: capacity - sum(r)).append(n)
        else:
            rows.append([n])
    return rows


def test_best_fit_against_plain_search():
    rng = random.Random(5)
    for _ in range(200):
        capacity = rng.choice([1, 2, 7, 16, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        rows = best_fit_decreasing(lengths, capacity)
        assert sorted(k for r in rows for k in r) == list(range(len(lengths)))
        got = sorted(sum(lengths[k] for k in r) for r in rows)
        assert got == sorted(map(sum, plain(lengths, capacity)))


def test_round_trip(spark, tmp_path):
    texts = [(1, "a b c"), (2, None), (None, "x " * 500), (1, "a b c"), (4, "")] + [(k, "word " * (k % 90)) for k in range(5, 80)]
    d = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, ids int").coalesce(2)
    packed = bestfit.pack(d, PATH, capacity=64)
    rows = packed.collect()
    tok = Tokenizer.from_file(PATH)
    pieces = []
    ids, position = matrix(rows, 64)
    for k, r in enumerate(rows):
        assert r.cu_seqlens[-1] == r.n_tokens <= 64 and r.resets == r.cu_seqlens[:-1]
        assert (ids[k, r.n_tokens :] == 50256).all() and (position[k, r.resets] == 0).all()
        pieces += [(d, s, ids[k, a:b].tolist()) for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False)]
    docs, whole = [], []
    for doc, start, part in sorted(pieces, key=lambda x: (str(x[0]), x[1])):
        if start == 0 and doc != 1:
            whole = []
        whole = whole + part if doc != 1 else part
        if part[-1] == 50256:
            docs.append((doc, whole))
    want = [(i, [*tok.encode(t or "", add_special_tokens=False).ids, 50256]) for i, t in texts]
    assert sorted(docs, key=str) == sorted(want, key=str)
    assert len({r.sequence_id for r in rows}) == len(rows)
    bestfit.write_matrices(packed, str(tmp_path / "m"))
    back = spark.read.parquet(str(tmp_path / "m")).collect()
    assert np.array_equal(np.sort(matrix(back, 64)[0], axis=0), np.sort(ids, axis=0))
    assert bestfit.pack(d.limit(0), PATH).count() == 0
