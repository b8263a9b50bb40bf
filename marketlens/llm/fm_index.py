"""An FM-index over the word symbols of one shard, with vectorised queries.

Symbol 0 is a break: the end of a text, or words that no phrase uses. Every
break counts as different from every other, so no suffix comparison and no
phrase crosses one, and suffix order settles within the longest run of phrase
words. The Burrows-Wheeler transform is held in a wavelet matrix (one bit
vector with ranks for each bit of the symbols).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class Bits:
    """A bit vector with constant-time counts of ones before a position."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 2, dtype=np.uint64)
        words.view(np.uint8)[:len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        cell = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[cell] + np.bitwise_count(self.words[cell] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, top: int):
        self.levels: list[tuple[int, Bits, int]] = []
        symbols = symbols.astype(np.uint16 if top < 1 << 16 else np.uint32)
        for shift in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = symbols & (1 << shift) != 0
            self.levels.append((shift, Bits(ones), len(symbols) - int(np.count_nonzero(ones))))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.start = self._map(np.arange(top + 1), np.zeros(top + 1, dtype=np.int64))

    def _map(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1 != 0, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        return self._map(symbol, at) - self.start[symbol]

    def get_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and how often it occurs before."""
        symbol = np.zeros(len(at), dtype=np.int64)
        for shift, bits, zeros in self.levels:
            one = bits.get(at)
            ones = bits.rank(at)
            at = np.where(one, zeros + ones, at - ones)
            symbol |= one.astype(np.int64) << shift
        return symbol, at - self.start[symbol]


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions by suffix; breaks (0) come first, each on its own, by position. Prefix doubling.

    A round sorts only the suffixes that are still tied.
    """
    n = len(symbols)
    is_break = symbols == 0
    rank = np.where(is_break, np.cumsum(is_break) - 1, symbols.astype(np.int64) + int(is_break.sum()))
    order = np.argsort(rank, kind="stable")
    ordered = rank[order]
    new = np.ones(n, dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    # slots of the order whose suffix is tied with a neighbour
    slots = np.flatnonzero(~(new & np.append(new[1:], True)))
    width = 1
    while len(slots):
        at = order[slots]
        after = at + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[at] << 32 | second
        place = np.argsort(key)
        at, key = at[place], key[place]
        order[slots] = at
        new = np.ones(len(at), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        rank[at] = slots[np.flatnonzero(new)[np.cumsum(new) - 1]]
        slots = slots[~(new & np.append(new[1:], True))]
        width *= 2
    return order


@dataclass
class FMIndex:
    """Backward search and location of phrases in one shard's symbols."""

    matrix: WaveletMatrix
    first: np.ndarray  # where the suffixes of each symbol begin in the order
    marked: Bits
    sample: np.ndarray
    n: int

    @classmethod
    def build(cls, symbols: np.ndarray, top: int, every: int = 16) -> FMIndex:
        """``top``: the largest symbol. Positions at ``every`` steps from a break are sampled.

        The first position of each run is always sampled, so a walk back never passes a break.
        """
        n = len(symbols)
        order = suffix_order(symbols)
        before = np.where(order > 0, symbols[np.maximum(order, 1) - 1], 0)
        at = np.arange(n)
        last_break = np.maximum.accumulate(np.where(symbols == 0, at, -1))
        offset = at - last_break - 1
        keep = ((offset >= 0) & (offset % every == 0))[order]
        counts = np.bincount(symbols, minlength=top + 1)
        first = np.zeros(top + 2, dtype=np.int64)
        np.cumsum(counts, out=first[1:])
        return cls(WaveletMatrix(before, top), first, Bits(keep), order[keep], n)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For a matrix of phrases (a row each): rows that occur, and their ranges of the suffix order."""
        alive = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.n, dtype=np.int64)
        for j in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, j]
            low = self.first[symbol] + self.matrix.rank(symbol, low)
            high = self.first[symbol] + self.matrix.rank(symbol, high)
            some = low < high
            alive, low, high = alive[some], low[some], high[some]
        return alive, low, high

    def locate(self, slots: np.ndarray) -> np.ndarray:
        """Text positions of places in the suffix order: walks back to sampled suffixes."""
        out = np.zeros(len(slots), dtype=np.int64)
        at, waiting, steps = slots, np.arange(len(slots)), 0
        while len(waiting):
            found = self.marked.get(at)
            out[waiting[found]] = self.sample[self.marked.rank(at[found])] + steps
            at, waiting, steps = at[~found], waiting[~found], steps + 1
            symbol, before = self.matrix.get_and_rank(at)
            at = self.first[symbol] + before
        return out
