import numpy as np

from utterloom.llm.fm_index import FMIndex, WaveletMatrix, suffix_array


def test_suffix_array_against_sorting():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 60):
        for sigma in (1, 2, 5):
            x = rng.integers(0, sigma, n)
            assert suffix_array(x).tolist() == sorted(range(n), key=lambda i: x[i:].tolist())


def test_wavelet_ranks():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 11, 500)
    w = WaveletMatrix(x, 11)
    at = np.arange(501)
    for c in range(11):
        assert w.rank(np.full(501, c), at).tolist() == np.concatenate(([0], np.cumsum(x == c))).tolist()
    assert w.access(np.arange(500)).tolist() == x.tolist()


def test_every_occurrence_is_found():
    rng = np.random.default_rng(5)
    for _ in range(30):
        runs = [rng.integers(1, 4, rng.integers(1, 30)) for _ in range(rng.integers(1, 12))]
        text = np.concatenate([[0], *[np.append(r, 0) for r in runs]])
        index = FMIndex(text, 4, sample=3)
        for m in (1, 2, 4):
            phrases = rng.integers(1, 4, (20, m))
            low, high = index.search(phrases)
            for p, a, b in zip(phrases, low, high, strict=True):
                want = [i for i in range(len(text) - m + 1) if text[i : i + m].tolist() == p.tolist()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want
