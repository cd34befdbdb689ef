"""A wavelet matrix over small symbols: rank and select by counting set bits level by level."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Symbols below ``2 ** bits``; queries take and return NumPy arrays, one entry a query.

    Level by level from the highest bit, the symbols are dealt stably: zeros of
    the bit first, ones behind them.  A level keeps its bits packed and the
    number of ones before each 64-bit word, so a rank is a table look-up and
    a popcount.
    """

    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.bits = len(symbols), bits
        self.words: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(bits - 1, -1, -1):
            ones = (symbols >> level & 1).astype(bool)
            padded = np.zeros((self.n // 64 + 1) * 64, dtype=bool)
            padded[:self.n] = ones
            words = np.packbits(padded, bitorder="little").view("<u8")
            self.words.append(words)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64))))
            self.zeros.append(int(self.n - self.before[-1][-1]))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits of a level before position ``at``."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[level][word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[level][word] + np.bitwise_count(below)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before position ``at`` (0 to ``n``)."""
        at = np.asarray(at, dtype=np.int64)
        start = np.zeros_like(at)
        for level in range(self.bits):
            if symbol >> (self.bits - 1 - level) & 1:
                start, at = self.zeros[level] + self.ones(level, start), self.zeros[level] + self.ones(level, at)
            else:
                start, at = start - self.ones(level, start), at - self.ones(level, at)
        return at - start

    def rank_any(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """Occurrences of any of ``symbols`` before ``at``: the sum of their ranks."""
        return sum((self.rank(s, at) for s in symbols), np.zeros(np.shape(at), dtype=np.int64))

    def select_any(self, symbols: tuple[int, ...], count: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest position in ``low`` .. ``high`` with at least ``count`` such symbols before it,
        by bisection on ranks; ``high`` must have that many."""
        low, high = np.array(low, dtype=np.int64), np.array(high, dtype=np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            enough = self.rank_any(symbols, middle) >= count[open_]
            high[open_[enough]] = middle[enough]
            low[open_[~enough]] = middle[~enough] + 1
