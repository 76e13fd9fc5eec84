"""FM-index over a sequence of small integers, in numpy: wavelet matrix ranks, sampled
suffix positions, many patterns searched at once."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order, by prefix doubling."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    ranked = text[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.r_[False, ranked[1:] != ranked[:-1]])
    step = 1
    while n and rank[order[-1]] < n - 1:
        second = np.zeros(n, np.int64)
        second[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank[order] = np.cumsum(np.r_[False, ranked[1:] != ranked[:-1]])
        step *= 2
    return order


class WaveletMatrix:
    """``rank`` and ``access`` over a sequence, one bit of the symbols a level, high bits first."""

    def __init__(self, symbols: np.ndarray, largest: int) -> None:
        self.n, self.levels = len(symbols), max(1, int(largest).bit_length())
        self.ones: list[np.ndarray] = []  # number of ones before each position
        self.zeros: list[int] = []
        for level in reversed(range(self.levels)):
            bits = (symbols >> level) & 1
            self.ones.append(np.r_[0, np.cumsum(bits)].astype(np.int32))
            self.zeros.append(self.n - int(self.ones[-1][-1]))
            symbols = np.r_[symbols[bits == 0], symbols[bits == 1]]

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        begin, end = np.zeros_like(at), at.copy()
        for k, level in enumerate(reversed(range(self.levels))):
            ones, zeros = self.ones[k], self.zeros[k]
            one = ((symbols >> level) & 1).astype(bool)
            begin_ones, end_ones = ones[begin].astype(np.int64), ones[end].astype(np.int64)
            begin = np.where(one, zeros + begin_ones, begin - begin_ones)
            end = np.where(one, zeros + end_ones, end - end_ones)
        return end - begin

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol at each position, how often it stands before it)."""
        symbol, begin, end = np.zeros_like(at), np.zeros_like(at), at.copy()
        for k in range(self.levels):
            ones, zeros = self.ones[k], self.zeros[k]
            begin_ones, end_ones = ones[begin].astype(np.int64), ones[end].astype(np.int64)
            one = ones[end + 1] > end_ones
            symbol = symbol * 2 + one
            begin = np.where(one, zeros + begin_ones, begin - begin_ones)
            end = np.where(one, zeros + end_ones, end - end_ones)
        return symbol, end - begin


class FMIndex:
    """Index of ``text``, whose symbols are 1 .. ``largest``; 0 may stand between parts."""

    def __init__(self, text: np.ndarray, largest: int, sample: int = 8) -> None:
        text = np.r_[text + 1, 0].astype(np.int64)  # 0 ends the text and stands nowhere else
        order = suffix_array(text)
        self.n = len(text)
        self.last = WaveletMatrix(text[order - 1], largest + 1)  # the symbol before each suffix
        counts = np.bincount(text, minlength=largest + 2)
        self.before = np.r_[0, np.cumsum(counts)]  # suffixes that begin with a lesser symbol
        self.is_sampled = order % sample == 0
        self.sampled_before = np.cumsum(self.is_sampled) - self.is_sampled
        self.samples = order[self.is_sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each pattern, read from its end.

        ``patterns`` holds a pattern in each row, right-aligned.
        """
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live, width = np.arange(len(patterns)), patterns.shape[1]
        for step in range(width):
            live = live[(low[live] < high[live]) & (lengths[live] > step)]
            if not len(live):
                break
            symbol = patterns[live, width - 1 - step] + 1
            low[live] = self.before[symbol] + self.last.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.last.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: step back through the text to a sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.is_sampled[rows])
        while len(walking):
            symbol, rank = self.last.access(rows[walking])
            rows[walking] = self.before[symbol] + rank
            steps[walking] += 1
            walking = walking[~self.is_sampled[rows[walking]]]
        return self.samples[self.sampled_before[rows]] + steps
