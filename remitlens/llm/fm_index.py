"""FM-index over a sequence of small integers, queried in bulk."""

from __future__ import annotations

import numpy as np


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in lexicographic order (a suffix that is a
    prefix of another comes first), by doubling the sorted length."""
    n = len(seq)
    rank = seq.astype(np.int64)
    width = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - width if width < n else 0] = rank[width:] + 1 if width < n else 0
        key = rank * (int(ahead.max(initial=0)) + 1) + ahead
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.diff(key[order], prepend=key[order[:1]]) != 0)
        rank, width = new, 2 * width
        if n == 0 or rank[order[-1]] == n - 1 or width >= 2 * n:
            return order


class WaveletTree:
    """Rank and access over a sequence, one bit vector for each bit of its
    symbols; each level sorts the sequence stably by that bit."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.levels = []
        for shift in range(bits - 1, -1, -1):
            bit = (seq >> shift) & 1
            ones = np.concatenate([[0], np.cumsum(bit)]).astype(np.int32)
            self.levels.append((shift, ones, len(seq) - int(ones[-1])))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        first, end = np.zeros_like(ends), ends
        for shift, ones, zeros in self.levels:
            bit = (symbols >> shift) & 1 == 1
            first = np.where(bit, zeros + ones[first], first - ones[first])
            end = np.where(bit, zeros + ones[end], end - ones[end])
        return end - first

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at the given places."""
        symbols = np.zeros_like(at)
        for shift, ones, zeros in self.levels:
            bit = ones[at + 1] - ones[at]
            symbols |= bit.astype(symbols.dtype) << shift
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return symbols


class FMIndex:
    """Symbols are 1..top; 0 separates texts and is never searched for."""

    def __init__(self, seq: np.ndarray, top: int, sample: int = 8):
        seq = np.append(np.asarray(seq, np.int64), 0)
        order = suffix_array(seq)
        self.tree = WaveletTree(seq[order - 1], max(1, int(top).bit_length()))
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=top + 1))])
        # no step ever crosses a separator: what follows one is kept as well
        kept = (order % sample == 0) | (seq[order - 1] == 0)
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.kept_starts = order[kept]
        self.size = len(seq)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of the suffixes that begin with each phrase, extended from
        its last symbol to its first. ``phrases``: one row each, padded right."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        for step in range(phrases.shape[1] if len(phrases) else 0):
            at = np.flatnonzero((lengths > step) & (low < high))
            symbol = phrases[at, lengths[at] - 1 - step]
            low[at] = self.smaller[symbol] + self.tree.rank(symbol, low[at])
            high[at] = self.smaller[symbol] + self.tree.rank(symbol, high[at])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Start of the suffix in each row: steps back through the text until
        a row whose start is kept."""
        starts = np.empty(len(rows), np.int64)
        left, at = np.arange(len(rows)), rows.astype(np.int64)
        steps = 0
        while len(left):
            kept = self.kept_before[at + 1] > self.kept_before[at]
            starts[left[kept]] = self.kept_starts[self.kept_before[at[kept]]] + steps
            left, at = left[~kept], at[~kept]
            symbol = self.tree.access(at)
            at = self.smaller[symbol] + self.tree.rank(symbol, at)
            steps += 1
        return starts
