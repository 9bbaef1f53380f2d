"""FM-index over a sequence of symbols: wavelet-matrix ranks and sampled suffix positions.

The sequence consists of runs. Symbol 0 ends a run and never matches anything. All queries
are answered for many patterns at once.
"""

from __future__ import annotations

import numpy as np

#: Every so many symbols of a run have their position stored, and so has each run's first.
SAMPLE = 16


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling. Run ends are all different (ordered by position), so
    no comparison goes beyond a run, and copies of runs cost only their length."""
    n = len(text)
    ends = text == 0
    k = int(ends.sum())
    rank = text.astype(np.int64) + k
    rank[ends] = np.arange(k)
    step = 1
    while True:
        following = np.zeros(n, np.int64)
        following[: n - step] = rank[step:] + 1 if step < n else 0
        key = rank * (int(rank.max()) + 2 if n else 1) + following
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = new
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        step *= 2
        if step >= n:
            return order


class WaveletMatrix:
    """Ranks of symbols in a sequence, bit by bit from the highest."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma).bit_length())
        self.ones, self.zeros = [], []
        current = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(len(bit) - int(bit.sum()))
            current = np.concatenate((current[bit == 0], current[bit == 1]))
        everything = np.arange(sigma + 1)
        self.begin = self._descend(everything, np.zeros(sigma + 1, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            up = ones[at]
            at = np.where((symbol >> (self.levels - 1 - i)) & 1, zeros + up, at - up)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(symbol, at) - self.begin[symbol]

    def access_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it occurs before."""
        symbol = np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            up = ones[at]
            bit = ones[at + 1] - up
            symbol = symbol * 2 + bit
            at = np.where(bit == 1, zeros + up, at - up)
        return symbol, at - self.begin[symbol]


class FMIndex:
    """Index of one sequence over symbols 0..sigma."""

    def __init__(self, text: np.ndarray, sigma: int):
        order = suffix_array(text)
        previous = text[order - 1]
        self.size = len(text)
        self.matrix = WaveletMatrix(previous.astype(np.int64), sigma)
        counts = np.bincount(text, minlength=sigma + 1)
        self.before = np.cumsum(counts) - counts
        # A walk back over the text must not step across the end of a run, so the first
        # position of every run is stored besides the regular sample.
        stored = (order % SAMPLE == 0) | (previous == 0) | (order == 0)
        self.stored = np.concatenate(([0], np.cumsum(stored))).astype(np.int64)
        self.positions = order[stored]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of patterns given one per row, padded in front with 0."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.size, np.int64)
        alive = np.arange(len(patterns))
        for j in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, j]
            alive, symbol = alive[symbol > 0], symbol[symbol > 0]
            lo[alive] = self.before[symbol] + self.matrix.rank(symbol, lo[alive])
            hi[alive] = self.before[symbol] + self.matrix.rank(symbol, hi[alive])
            alive = alive[hi[alive] > lo[alive]]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, walking back to the nearest stored position."""
        found = np.full(len(rows), -1, np.int64)
        walking, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(walking):
            here = self.stored[at + 1] > self.stored[at]
            found[walking[here]] = self.positions[self.stored[at[here]]] + steps
            walking, at = walking[~here], at[~here]
            symbol, rank = self.matrix.access_rank(at)
            at = self.before[symbol] + rank
            steps += 1
        return found

    def occurrences(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern number, text position) of every occurrence of every pattern."""
        lo, hi = self.search(patterns)
        times = np.maximum(hi - lo, 0)
        which = np.repeat(np.arange(len(patterns)), times)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        return which, self.locate(lo[which] + inside)
