"""An FM-index over word codes: suffix order, wavelet ranks and sampled positions, in numpy."""

from __future__ import annotations

import numpy as np

# Every so manieth position of the text is stored.
SAMPLE_RATE = 16


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes of a text of codes, in which every 0 is a separator of its own.

    Ranks are doubled in length until all differ, which they do once they reach past the
    longest stretch between separators. Only places that still share a rank are sorted again.
    """
    length = len(text)
    breaks = text == 0
    separators = int(breaks.sum())
    rank = np.where(breaks, np.cumsum(breaks) - 1, text.astype(np.int64) + separators)
    _, rank = np.unique(rank, return_inverse=True)
    order = np.argsort(rank, kind="stable")
    start = np.concatenate([[True], rank[order][1:] != rank[order][:-1]])
    rank = np.empty(length, np.int64)
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(length), 0))
    width = 1
    while not start.all():
        tied = ~(start & np.append(start[1:], True))
        places = np.flatnonzero(tied)
        own = order[places]
        after = rank[np.minimum(own + width, length - 1)]
        by = np.lexsort((after, rank[own]))
        own, after = own[by], after[by]
        order[places] = own
        groups = rank[own]
        start[places] = np.concatenate(
            [[True], (groups[1:] != groups[:-1]) | (after[1:] != after[:-1])])
        rank[own] = np.maximum.accumulate(np.where(start[places], places, 0))
        width *= 2
    return order


class _Bits:
    """A bit row with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        filled = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        filled[:len(bits)] = bits
        self.words = np.packbits(filled, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]])
        self.zeros = len(bits) - int(ones.sum())

    def rank(self, places: np.ndarray) -> np.ndarray:
        block, bit = places >> 6, (places & 63).astype(np.uint64)
        below = self.words[block] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[block] + np.bitwise_count(below)

    def at(self, places: np.ndarray) -> np.ndarray:
        return (self.words[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) == 1


class FMIndex:
    """Counts and locates sequences of codes from 1 to ``symbols`` in a text; 0 separates."""

    def __init__(self, text: np.ndarray, symbols: int, rate: int = SAMPLE_RATE):
        text = np.append(text, 0)
        order = suffix_order(text)
        counts = np.bincount(text, minlength=symbols + 2)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.size = len(text)
        # A walk back ends at a stored place, at the latest where its stretch begins.
        begins = np.concatenate([[True], text[:-1] == 0])
        kept = begins[order] | (order % rate == 0)
        self.sampled = _Bits(kept)
        self.positions = order[kept]
        last = text[order - 1]
        self.levels = []
        self.bits = max(1, int(symbols).bit_length())
        for level in range(self.bits - 1, -1, -1):
            row = (last >> level) & 1
            self.levels.append((level, _Bits(row)))
            last = np.concatenate([last[row == 0], last[row == 1]])
        self.begin = self._down(np.arange(symbols + 1), np.zeros(symbols + 1, np.int64))

    def _down(self, codes: np.ndarray, places: np.ndarray) -> np.ndarray:
        for level, bits in self.levels:
            ones = bits.rank(places)
            places = np.where((codes >> level) & 1 == 1, bits.zeros + ones, places - ones)
        return places

    def rank(self, codes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each code stands before a place of the transformed text."""
        return self._down(codes, places) - self.begin[codes]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of suffixes that begin with each row of ``patterns``; empty if none."""
        low, high = self.first[patterns[:, -1]], self.first[patterns[:, -1] + 1]
        for column in range(patterns.shape[1] - 2, -1, -1):
            alive = np.flatnonzero(low < high)
            if not len(alive):
                break
            codes = patterns[alive, column]
            low[alive] = self.first[codes] + self.rank(codes, low[alive])
            high[alive] = self.first[codes] + self.rank(codes, high[alive])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of rows, by walking back to a stored one."""
        found, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        waiting, rows = np.arange(len(rows)), rows.copy()
        while len(waiting):
            stored = self.sampled.at(rows)
            done = waiting[stored]
            found[done] = self.positions[self.sampled.rank(rows[stored])] + steps[done]
            waiting, rows = waiting[~stored], rows[~stored]
            steps[waiting] += 1
            codes, places = np.zeros(len(rows), np.int64), rows
            for level, bits in self.levels:
                one, ones = bits.at(places), bits.rank(places)
                codes |= one.astype(np.int64) << level
                places = np.where(one, bits.zeros + ones, places - ones)
            rows = self.first[codes] + places - self.begin[codes]
        return found
