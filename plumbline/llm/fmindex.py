"""An FM-index over whole numbers: suffix order, wavelet ranks, sampled positions.

Symbol 0 ends a run; no pattern holds it. All searches work on many patterns at once.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. Ends of runs differ from each other, the earlier is smaller."""
    n = len(symbols)
    bits = max(1, int(symbols.max(initial=0)).bit_length())
    depth = max(1, 62 // bits)
    stop = np.flatnonzero(symbols == 0)
    until = np.full(n, n, np.int64)
    until[:] = np.r_[stop, n][np.searchsorted(stop, np.arange(n))]
    key = np.zeros(n, np.int64)
    padded = np.r_[symbols.astype(np.int64), np.zeros(depth, np.int64)]
    at = np.arange(n)
    for step in range(depth):
        key = (key << bits) | np.where(at + step < until, padded[step:step + n], 0)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    ended = (until - at < depth)[order]
    start = np.r_[True, (sorted_key[1:] != sorted_key[:-1]) | ended[1:] | ended[:-1]]
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(start, slots, 0))
    del key, sorted_key, padded, until
    open_slots = np.flatnonzero(~start | ~np.r_[start[1:], True])
    while len(open_slots):
        suffixes = order[open_slots]
        group, then = rank[suffixes], rank[suffixes + depth]
        by = np.lexsort((then, group))
        suffixes, group, then = suffixes[by], group[by], then[by]
        order[open_slots] = suffixes
        start = np.r_[True, (group[1:] != group[:-1]) | (then[1:] != then[:-1])]
        rank[suffixes] = np.maximum.accumulate(np.where(start, open_slots, 0))
        open_slots = open_slots[~start | ~np.r_[start[1:], True]]
        depth *= 2
    return order


class Bits:
    """A bit vector that counts the ones before a position."""

    def __init__(self, flags: np.ndarray):
        n = len(flags)
        words = np.zeros(n // 64 + 1, np.uint64)
        packed = np.packbits(flags.astype(bool), bitorder="little")
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)]

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class Wavelet:
    """Wavelet tree, level by level: rank of a symbol before a position, and access."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for shift in range(bits - 1, -1, -1):
            flags = (values >> shift) & 1 == 1
            self.levels.append((shift, Bits(flags), len(values) - int(flags.sum())))
            values = np.concatenate([values[~flags], values[flags]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(at), at.copy()
        for shift, bits, zeros in self.levels:
            one = (symbol >> shift) & 1 == 1
            low_ones, high_ones = bits.rank(low), bits.rank(high)
            low = np.where(one, zeros + low_ones, low - low_ones)
            high = np.where(one, zeros + high_ones, high - high_ones)
        return high - low

    def get(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(at), np.int64)
        for shift, bits, zeros in self.levels:
            one, ones = bits.get(at), bits.rank(at)
            symbol |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones, at - ones)
        return symbol


class FMIndex:
    """Index of a sequence that starts and ends with 0."""

    def __init__(self, symbols: np.ndarray, top: int):
        order = suffix_order(symbols)
        self.below = np.r_[0, np.cumsum(np.bincount(symbols, minlength=top + 1))]
        last = symbols[order - 1]  # the suffix at 0 is preceded by the closing 0
        self.wavelet = Wavelet(last.astype(np.int64), max(1, top.bit_length()))
        known = (order % SAMPLE == 0) | (last == 0)
        self.known, self.positions = Bits(known), order[known]
        self.size = len(symbols)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` of each pattern, right-aligned in its row of ``patterns``."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        live = np.arange(len(patterns))
        for step in range(patterns.shape[1]):
            live = live[(lengths[live] > step) & (high[live] > low[live])]
            if not len(live):
                break
            symbol = patterns[live, patterns.shape[1] - 1 - step]
            base = self.below[symbol]
            low[live] = base + self.wavelet.rank(symbol, low[live])
            high[live] = base + self.wavelet.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows start: step back until a sampled one."""
        found = np.empty(len(rows), np.int64)
        open_at, steps = np.arange(len(rows)), 0
        while len(open_at):
            known = self.known.get(rows)
            found[open_at[known]] = self.positions[self.known.rank(rows[known])] + steps
            open_at, rows = open_at[~known], rows[~known]
            symbol = self.wavelet.get(rows)
            rows = self.below[symbol] + self.wavelet.rank(symbol, rows)
            steps += 1
        return found
