"""An FM-index over integer symbols, vectorised: all phrases are searched at once."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order, by prefix doubling; a suffix that ends sorts before its extensions."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64).reshape(-1)
    order, step = np.argsort(rank, kind="stable"), 1
    while n:
        after = np.zeros(n, np.int64)
        after[:-step or n] = rank[step:] + 1 if step < n else 0
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank, step = new, 2 * step
        if rank[order[-1]] == n - 1 or step >= 2 * n:
            break
    return order


class WaveletMatrix:
    """Ranks of symbols in a sequence, from one bit vector for each bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.n, self.bits = len(symbols), max(1, int(sigma - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        seq = symbols.astype(np.int64)
        for b in reversed(range(self.bits)):
            bit = (seq >> b) & 1
            packed = np.packbits(np.pad(bit, (0, -self.n % 64 + 64)).astype(np.uint8), bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1])))
            self.zeros.append(int(self.n - bit.sum()))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each position, on one level."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[level][word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[level][word] + np.bitwise_count(below)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol comes before each position."""
        low = np.zeros_like(at)
        for level, b in enumerate(reversed(range(self.bits))):
            one = (symbol >> b) & 1 == 1
            la, lb = self._ones(level, low), self._ones(level, at)
            low = np.where(one, self.zeros[level] + la, low - la)
            at = np.where(one, self.zeros[level] + lb, at - lb)
        return at - low

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbol at each position."""
        out = np.zeros_like(at)
        for level, b in enumerate(reversed(range(self.bits))):
            ones = self._ones(level, at)
            one = (self.words[level][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            out |= one.astype(np.int64) << b
            at = np.where(one, self.zeros[level] + ones, at - ones)
        return out


class FMIndex:
    """Index of runs of symbols (1 to sigma - 1), that are set apart by 0.

    ``text`` starts and ends with 0. Breaks are told apart by their place while suffixes are sorted, so no comparison
    passes one. Every ``sample``-th place of a run, counted from its start, keeps its position; a walk back from any
    row reaches one before it would pass a break.
    """

    def __init__(self, text: np.ndarray, sigma: int, sample: int = 8):
        text = np.asarray(text, np.int64)
        breaks = np.flatnonzero(text == 0)
        apart = text + len(breaks)
        apart[breaks] = np.arange(len(breaks))
        rows = suffix_array(apart)
        self.bwt = WaveletMatrix(text[rows - 1], sigma)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        start = np.maximum.accumulate(np.where(text == 0, np.arange(len(text)), 0)) + 1
        sampled = (text[rows] != 0) & ((rows - start[rows]) % sample == 0)
        self.sampled, self.count = sampled, np.cumsum(sampled) - 1
        self.places = rows[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of phrases (one a line, equal lengths), by backward search."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.bwt.n, np.int64)
        for column in phrases.T[::-1]:
            column = np.ascontiguousarray(column, np.int64)
            low = self.less[column] + self.bwt.rank(column, low)
            high = self.less[column] + self.bwt.rank(column, high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows that don't start with a break."""
        out, steps, left = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.astype(np.int64)
        while len(left):
            done = self.sampled[rows]
            out[left[done]] = self.places[self.count[rows[done]]] + steps
            left, rows = left[~done], rows[~done]
            symbol = self.bwt.access(rows)
            rows = self.less[symbol] + self.bwt.rank(symbol, rows)
            steps += 1
        return out
