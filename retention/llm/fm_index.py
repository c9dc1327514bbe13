"""A bidirectional FM-index over a shard's word ids, searched for all patterns of a depth at once.

The text is an integer array: words are 1 and up, 0 breaks the text; it ends with a 0. Its positions
are sorted by their first ``depth`` symbols, which makes the intervals of patterns of up to ``depth``
symbols exact. A pattern is an interval in the index and one in the index of the reversed text;
extending it by a symbol on one side is a step in one index and moves the other interval by the
number of smaller symbols that stand on that side.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class Index:
    """Burrows-Wheeler transform of ``x`` with ranks: extends patterns by the symbol before them."""

    def __init__(self, x: np.ndarray, depth: int):
        self.size = len(x)
        order = _sorted_positions(x, depth)
        self.bwt = x[order - 1]  # before the first symbol stands the last, a break
        places = np.argsort(self.bwt, kind="stable")
        # (symbol, place) in order: how many come before (c, i) is where c's suffixes begin plus c's rank at i
        self.ranks = self.bwt[places].astype(np.int64) * self.size + places

    def step(self, symbol: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Where the intervals begin that ``symbol`` before the intervals beginning at ``low`` leads to."""
        return np.searchsorted(self.ranks, symbol.astype(np.int64) * self.size + low)

    def before(self, low: np.ndarray, count: np.ndarray):
        """(owner, symbol, count, smaller) for each symbol before each interval: the interval's number, how
        often the symbol stands there and how many smaller ones do. Breaks are left out."""
        owner = np.repeat(np.arange(len(low)), count)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        width = int(self.bwt.max()) + 1
        pairs, n = np.unique(owner * width + self.bwt[at], return_counts=True)
        owner, symbol = pairs // width, pairs % width
        smaller = np.cumsum(n) - n  # of all pairs; less those of the owners before
        smaller -= (np.cumsum(count) - count)[owner]
        word = symbol > 0
        return owner[word], symbol[word], n[word], smaller[word]


def _sorted_positions(x: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``x`` in the order of their next ``depth`` symbols (a power of two), by doubling."""
    rank, span = x.astype(np.int64), 1
    while span < depth:
        after = np.zeros_like(rank)
        after[:-span] = rank[span:]
        rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1]
        span *= 2
    return np.argsort(rank, kind="stable")


@dataclass
class Patterns:
    """Patterns of one length: their symbols (a column a place), counts and where both intervals begin."""

    words: list[np.ndarray]
    count: np.ndarray
    low: np.ndarray
    low_back: np.ndarray

    def where(self, kept: np.ndarray) -> Patterns:
        return Patterns([w[kept] for w in self.words], self.count[kept], self.low[kept], self.low_back[kept])


class Bidirectional:
    def __init__(self, x: np.ndarray, depth: int):
        self.forward, self.back = Index(x, depth), Index(x[::-1], depth)
        self.counts = np.bincount(x)

    def words(self) -> Patterns:
        """The patterns of one symbol; in both indexes they begin after all smaller symbols."""
        low = np.cumsum(self.counts) - self.counts
        word = np.flatnonzero(self.counts)
        word = word[word > 0]
        return Patterns([word], self.counts[word], low[word], low[word])

    def extend_left(self, p: Patterns) -> Patterns:
        owner, symbol, n, smaller = self.forward.before(p.low, p.count)
        return Patterns([symbol, *(w[owner] for w in p.words)], n, self.forward.step(symbol, p.low[owner]), p.low_back[owner] + smaller)

    def extend_right(self, p: Patterns) -> Patterns:
        owner, symbol, n, smaller = self.back.before(p.low_back, p.count)
        return Patterns([*(w[owner] for w in p.words), symbol], n, p.low[owner] + smaller, self.back.step(symbol, p.low_back[owner]))

    def grams(self, most: int, kept=None):
        """Patterns of 2 to ``most`` symbols, each once: extended to the right and to the left by turns. Those
        that ``kept`` (a mask from their symbols' columns) leaves out aren't extended either."""
        found = self.words()
        for k in range(2, most + 1):
            found = self.extend_right(found) if k % 2 == 0 else self.extend_left(found)
            found = found.where(kept(found.words)) if kept else found
            yield found
