"""A full-text index over a run of small whole numbers: Burrows-Wheeler transform, wavelet matrix, sampled suffixes.

All queries take arrays of patterns, so that each step is a few vector operations however many patterns there are.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of text in ascending order, by prefix doubling over those that are still tied."""
    n = len(text)
    rank = np.zeros(n + 1, np.int64)  # how many suffixes are smaller by what has been compared; the empty one is least
    tied = np.argsort(text, kind="stable")
    first = np.concatenate(([True], text[tied][1:] != text[tied][:-1]))
    rank[tied] = np.maximum.accumulate(np.where(first, np.arange(n), 0)) + 1
    single = first & np.concatenate((first[1:], [True]))
    tied = tied[~single]
    h = 1
    while len(tied):
        behind = rank[np.minimum(tied + h, n)]
        key = rank[tied] * (n + 2) + behind
        order = np.argsort(key, kind="stable")
        tied, key = tied[order], key[order]
        own = rank[tied]
        index = np.arange(len(tied))
        group = np.concatenate(([True], own[1:] != own[:-1]))
        first = np.concatenate(([True], key[1:] != key[:-1]))
        begin = np.maximum.accumulate(np.where(group, index, 0))
        rank[tied] = own + np.maximum.accumulate(np.where(first, index, 0)) - begin
        single = first & np.concatenate((first[1:], [True]))
        tied = tied[~single]
        h *= 2
    out = np.empty(n, np.int64)
    out[rank[:n] - 1] = np.arange(n)
    return out


class FmIndex:
    """Over symbols 1 and up. 0 is kept for the end of the text."""

    #: Every so many positions of the text one suffix position is kept.
    SAMPLE = 8

    def __init__(self, symbols: np.ndarray, highest: int):
        text = np.concatenate((symbols, [0])).astype(np.int64)
        order = suffix_order(text)
        last = text[order - 1]
        self.size = len(text)
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=highest + 1))))
        self.sampled = order % self.SAMPLE == 0
        self.sample_row = np.concatenate(([0], np.cumsum(self.sampled)))
        self.sample = order[self.sampled]
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []  # bits, zeros before each place, zeros
        for shift in range(max(1, int(highest).bit_length()) - 1, -1, -1):
            bit = (last >> shift) & 1
            zeros = np.concatenate(([0], np.cumsum(1 - bit))).astype(np.int32)
            self.levels.append((bit.astype(np.int8), zeros, int(zeros[-1])))
            last = np.concatenate((last[bit == 0], last[bit == 1]))
        every = np.arange(highest + 1)
        self.first = self._trace(every, np.zeros(len(every), np.int64))

    def _trace(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (_, zeros, n_zeros) in enumerate(self.levels):
            one = (symbol >> (len(self.levels) - 1 - k)) & 1
            before = zeros[at]
            at = np.where(one == 1, n_zeros + at - before, before)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before each place."""
        return self._trace(symbol, at) - self.first[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [from, to) of the suffixes that begin with each pattern (one a line, all of one length), backwards."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        alive = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, k]
            low[alive] = self.smaller[symbol] + self.rank(symbol, low[alive])
            high[alive] = self.smaller[symbol] + self.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where in the text the suffixes of these rows begin: steps back until a kept position is met."""
        out, steps, open_ = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        at = rows.copy()
        while len(open_):
            hit = self.sampled[at]
            out[open_[hit]] = self.sample[self.sample_row[at[hit]]] + steps
            open_, at = open_[~hit], at[~hit]
            symbol, place = np.zeros(len(at), np.int64), at
            for bits, zeros, n_zeros in self.levels:
                one, before = bits[place], zeros[place]
                symbol = symbol * 2 + one
                place = np.where(one == 1, n_zeros + place - before, before)
            at = self.smaller[symbol] + place - self.first[symbol]
            steps += 1
        return out
