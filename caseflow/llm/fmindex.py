"""An FM-index over word identifiers: wavelet-tree ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 8


class Wavelet:
    """A wavelet matrix of small non-negative integers: symbol at a place, occurrences before it."""

    def __init__(self, symbols: np.ndarray, highest: int):
        self.bits: list[tuple[int, np.ndarray, int]] = []
        for level in range(max(1, int(highest).bit_length()) - 1, -1, -1):
            bit = symbols >> level & 1
            ones = np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32)
            zeros = len(symbols) - int(ones[-1])
            self.bits.append((level, ones, zeros))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def descend(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Where prefixes that end at ``places`` end on the bottom level, following ``symbols``."""
        for level, ones, zeros in self.bits:
            before = ones[places]
            places = np.where(symbols >> level & 1, zeros + before, places - before)
        return places

    def access(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at ``places`` and their places on the bottom level."""
        symbols = np.zeros(len(places), np.int64)
        for level, ones, zeros in self.bits:
            before = ones[places]
            bit = ones[places + 1] - before
            symbols |= bit.astype(np.int64) << level
            places = np.where(bit, zeros + before, places - before)
        return symbols, places


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes by doubling; every separator (0) is smaller than any word and than
    the separators after it, so that no comparison passes the end of a run."""
    size = len(text)
    separators = np.flatnonzero(text == 0)
    key = text.astype(np.int64) + len(separators)
    key[separators] = np.arange(len(separators))
    order = np.argsort(key, kind="stable")
    span = 1
    while True:
        new = np.empty(size, bool)
        new[:1] = True
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(size, np.int64)
        rank[order] = np.cumsum(new) - 1
        if new.all():
            return order
        after = np.zeros(size, np.int64)
        after[:-span] = rank[span:] + 1
        key = rank * (size + 1) + after
        order = np.argsort(key, kind="stable")
        span *= 2


class FMIndex:
    """Index of runs of words: ``text`` holds word identifiers from 1 on and 0 between runs.

    Must begin with a separator. Positions are sampled at every ``SAMPLE``-th place and at the
    first word of every run, so that walks to a sampled position never leave a run.
    """

    def __init__(self, text: np.ndarray, highest: int):
        order = suffix_array(text)
        self.size = len(text)
        before = text[order - 1]
        self.wavelet = Wavelet(before, highest)
        # Rows whose suffix starts with a smaller word, and where a word's block starts at the bottom.
        counts = np.bincount(text, minlength=highest + 1)
        self.smaller = np.concatenate(([0], np.cumsum(counts)[:-1]))
        every = np.arange(highest + 1)
        self.origin = self.wavelet.descend(every, np.zeros(highest + 1, np.int64))
        sampled = (order % SAMPLE == 0) | (before == 0)
        self.samples = np.concatenate(([0], np.cumsum(sampled)))
        self.positions = order[sampled]

    def _map(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        bottom = self.wavelet.descend(symbols, places)
        return self.smaller[symbols] + bottom - self.origin[symbols]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the rows that start with each pattern (a row of ``patterns``), equal if none."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        alive = np.arange(len(patterns))
        for column in patterns.T[::-1]:
            symbols = column[alive]
            low[alive] = self._map(symbols, low[alive])
            high[alive] = self._map(symbols, high[alive])
            alive = alive[low[alive] < high[alive]]
        high = np.maximum(low, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, walking back to the nearest sampled one."""
        found = np.empty(len(rows), np.int64)
        at, walked = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(at):
            place = self.samples[rows]
            here = self.samples[rows + 1] > place
            found[at[here]] = self.positions[place[here]] + walked
            at, rows = at[~here], rows[~here]
            symbols, bottom = self.wavelet.access(rows)
            rows = self.smaller[symbols] + bottom - self.origin[symbols]
            walked += 1
        return found
