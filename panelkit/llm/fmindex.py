"""FM-index of a sequence of whole numbers: suffix order, Burrows-Wheeler transform, wavelet ranks, sampled positions."""

from __future__ import annotations

import numpy as np

from panelkit.llm.words import ranges


def suffix_order(text: np.ndarray, separators: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order, by prefix doubling. Separators (a mask) order by place, so that no comparison runs on
    past one; they come before all other symbols."""
    n = len(text)
    rank = text.astype(np.int64) + n
    rank[separators] = np.arange(int(separators.sum()))
    order, step = np.argsort(rank, kind="stable"), 1
    while True:
        sorted_rank = rank[order]
        fresh = np.zeros(n, dtype=np.int64)
        if step == 1:
            new = sorted_rank[1:] != sorted_rank[:-1]
        else:
            new = key[order][1:] != key[order][:-1]  # noqa: F821  (set by the round before)
        fresh[order[1:]] = np.cumsum(new)
        rank = fresh
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        ahead = np.zeros(n, dtype=np.int64)
        ahead[:max(n - step, 0)] = rank[step:] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        step *= 2


class FmIndex:
    """Finds runs of symbols in ``text``. Symbol 0 separates runs; no pattern may hold it. ``text`` must end with a separator."""

    def __init__(self, text: np.ndarray, sample: int = 8):
        separators = text == 0
        order = suffix_order(text, separators)
        self.n, self.bwt = len(text), text[order - 1]
        self.bits = max(1, int(text.max()).bit_length())
        counts = np.bincount(text, minlength=(1 << self.bits) + 1)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.zeros, level = [], self.bwt
        for bit in range(self.bits - 1, -1, -1):
            ones = (level >> bit) & 1
            self.zeros.append(np.concatenate([[0], np.cumsum(1 - ones)]).astype(np.int32))
            level = np.concatenate([level[ones == 0], level[ones == 1]])
        # the first place of every run is sampled, so a walk to the left never crosses a separator
        begins = np.flatnonzero(np.concatenate([[True], separators[:-1]]))
        inside = np.arange(self.n) - np.repeat(begins, np.diff(np.append(begins, self.n)))
        taken = (inside % sample == 0)[order]
        self.sampled = np.concatenate([[0], np.cumsum(taken)])
        self.positions = order[taken]

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before each place."""
        low, high = np.zeros(len(at), dtype=np.int64), at.astype(np.int64)
        for level, zeros in enumerate(self.zeros):
            one = ((symbols >> (self.bits - 1 - level)) & 1).astype(bool)
            zl, zh = zeros[low], zeros[high]
            low, high = np.where(one, zeros[-1] + low - zl, zl), np.where(one, zeros[-1] + high - zh, zh)
        return high - low

    def search(self, patterns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all patterns together (rows of ``patterns``, ``sizes`` symbols each): suffix ranges, empty if absent."""
        low, high = np.zeros(len(sizes), dtype=np.int64), np.full(len(sizes), self.n, dtype=np.int64)
        active = np.arange(len(sizes))
        for step in range(int(sizes.max()) if len(sizes) else 0):
            active = active[(sizes[active] > step) & (high[active] > low[active])]
            if not len(active):
                break
            symbols = patterns[active, sizes[active] - 1 - step]
            known = symbols < (1 << self.bits)
            high[active[~known]] = low[active[~known]]
            active, symbols = active[known], symbols[known]
            low[active] = self.before[symbols] + self.rank(symbols, low[active])
            high[active] = self.before[symbols] + self.rank(symbols, high[active])
        return low, high

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the pattern and position of every occurrence, by walks to the nearest sampled place."""
        sizes = np.maximum(high - low, 0)
        at = ranges(low, sizes)
        steps = np.zeros(len(at), dtype=np.int64)
        todo = np.arange(len(at))
        while len(todo):
            here = at[todo]
            todo = todo[self.sampled[here + 1] == self.sampled[here]]
            symbols = self.bwt[at[todo]]
            at[todo] = self.before[symbols] + self.rank(symbols, at[todo])
            steps[todo] += 1
        return np.repeat(np.arange(len(sizes)), sizes), self.positions[self.sampled[at]] + steps
