"""Compressed full-text index over integer sequences: Burrows-Wheeler transform
in a wavelet matrix, queried by backward search, many patterns at a time.

Suffixes are ordered by their first ``depth`` symbols only, which is enough
for patterns of up to ``depth`` symbols.
"""

from __future__ import annotations

import numpy as np

from pulse.llm.common import ship

ship(__name__)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols (integers from 0), by prefix doubling."""
    n, rank, width = len(text), text.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        key = rank * (int(rank.max(initial=0)) + 2)
        key[:n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        new = np.ones(n, np.int64)
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank[order] = np.cumsum(new) - 1
        width *= 2
    return order


class Wavelet:
    """Rank over a sequence of integers below ``size``: one packed bit vector per binary digit."""

    def __init__(self, values: np.ndarray, size: int):
        self.levels = []
        values = values.astype(np.int64)
        for digit in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bit = (values >> digit & 1).astype(bool)
            padded = np.zeros((len(bit) // 64 + 1) * 64, bool)
            padded[:len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((digit, words, before, int(len(bit) - bit.sum())))
            values = np.concatenate([values[~bit], values[bit]])

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where ``at`` falls in the fully sorted order when only ``symbol`` is followed."""
        for digit, words, before, zeros in self.levels:
            word = at >> 6
            low = words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            ones = before[word] + np.bitwise_count(low)
            at = np.where(symbol >> digit & 1, zeros + ones, at - ones)
        return at


class FMIndex:
    def __init__(self, text: np.ndarray, size: int, depth: int):
        """text: integers below ``size``; 0 separates sequences."""
        self.order = suffix_order(text, depth)
        self.bwt = Wavelet(text[self.order - 1], size)
        every = np.arange(size)
        self.origin = self.bwt.place(every, np.zeros(size, np.int64))
        self.first = np.zeros(size + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=size), out=self.first[1:])

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of symbol + pattern from the patterns' intervals."""
        both = self.bwt.place(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.first[symbol] - self.origin[symbol]
        return base + both[:len(symbol)], base + both[len(symbol):]

    def matching(self, text: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of the indexed text's own places: for the patterns that
        end before ``ends``, how many symbols (up to ``most``) to the left still occur
        more than once, and the interval of that many."""
        length = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), len(text), np.int64)
        active = np.arange(len(ends))
        for step in range(1, most + 1):
            a, b = self.extend(text[ends[active] - step], low[active], high[active])
            more = b - a > 1
            active = active[more]
            low[active], high[active], length[active] = a[more], b[more], step
            if not len(active):
                break
        return length, low, high
