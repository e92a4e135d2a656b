"""Full-text index of a shard: Burrows-Wheeler transform, wavelet ranks, sampled suffix positions.

The text is an array of symbols in which 0 ends a run. All functions work on many patterns or
places at once. Runs are told apart by their ends: no pattern holds a 0, so matches stay in a run.
"""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places in suffix order by doubling; each 0 sorts by its place, so a run's length bounds the rounds."""
    size = len(text)
    ends = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    width = 1
    while True:
        # The end of a run has a rank of its own, so what follows it never decides.
        following = np.zeros(size, dtype=np.int64)
        following[:-width] = rank[width:] + 1
        keys = rank * (int(rank.max()) + 2) + following
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(size, dtype=np.int64)
        rank[order] = fresh
        width *= 2
        if fresh[-1] == size - 1 or width >= size:
            return order


class WaveletRanks:
    """Counts of any symbol before any place of a sequence, one bit of the symbol per level."""

    def __init__(self, symbols: np.ndarray, highest: int):
        self.levels, self.zeros = [], []
        current = symbols
        for shift in range(max(1, int(highest).bit_length()) - 1, -1, -1):
            bits = (current >> shift) & 1
            ones = np.zeros(len(bits) + 1, dtype=np.int32)
            np.cumsum(bits, out=ones[1:])
            self.levels.append((shift, ones))
            self.zeros.append(len(bits) - int(ones[-1]))
            current = np.concatenate([current[bits == 0], current[bits == 1]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        first, last = np.zeros(len(places), dtype=np.int64), places.astype(np.int64)
        for (shift, ones), zeros in zip(self.levels, self.zeros):
            one = (symbols >> shift) & 1 == 1
            before_first, before_last = ones[first], ones[last]
            first = np.where(one, zeros + before_first, first - before_first)
            last = np.where(one, zeros + before_last, last - before_last)
        return last - first

    def symbol(self, places: np.ndarray) -> np.ndarray:
        at, found = places.astype(np.int64), np.zeros(len(places), dtype=np.int64)
        for (shift, ones), zeros in zip(self.levels, self.zeros):
            one = ones[at + 1] - ones[at]
            found |= one.astype(np.int64) << shift
            at = np.where(one == 1, zeros + ones[at], at - ones[at])
        return found


class FmIndex:
    def __init__(self, text: np.ndarray):
        """`text` ends with 0 and has at least one symbol."""
        order = suffix_array(text)
        highest = int(text.max())
        # The symbol before each suffix; before the first one stands the last, a 0.
        self.ranks = WaveletRanks(text[order - 1].astype(np.int64), highest)
        self.below = np.zeros(highest + 2, dtype=np.int64)
        np.cumsum(np.bincount(text, minlength=highest + 1), out=self.below[1:])
        run_start = np.concatenate([[True], text[:-1] == 0])
        kept = (order % SAMPLE_EVERY == 0) | run_start[order]
        self.sampled = kept
        self.sample = np.cumsum(kept) - 1
        self.samples = order[kept]

    def search(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [first, last) of the patterns symbols[start : start + length], backwards."""
        first = np.zeros(len(starts), dtype=np.int64)
        last = np.full(len(starts), self.below[-1], dtype=np.int64)
        alive = np.arange(len(starts))
        for step in range(int(lengths.max(initial=0))):
            alive = alive[lengths[alive] > step]
            wanted = symbols[starts[alive] + lengths[alive] - 1 - step]
            known = wanted < len(self.below) - 1
            last[alive[~known]] = first[alive[~known]] = 0
            alive, wanted = alive[known], wanted[known]
            first[alive] = self.below[wanted] + self.ranks.rank(wanted, first[alive])
            last[alive] = self.below[wanted] + self.ranks.rank(wanted, last[alive])
            alive = alive[first[alive] < last[alive]]
        return first, np.maximum(first, last)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of the suffixes with these ranks: steps back to the nearest sample."""
        at, steps = rows.astype(np.int64), np.zeros(len(rows), dtype=np.int64)
        moving = np.flatnonzero(~self.sampled[at])
        while len(moving):
            symbols = self.ranks.symbol(at[moving])
            at[moving] = self.below[symbols] + self.ranks.rank(symbols, at[moving])
            steps[moving] += 1
            moving = moving[~self.sampled[at[moving]]]
        return self.samples[self.sample[at]] + steps
