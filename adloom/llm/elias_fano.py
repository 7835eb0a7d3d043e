"""Elias-Fano sequences and n-gram levels in flat buffers, queried many at a time."""

from __future__ import annotations

import numpy as np

ONE = np.uint64(1)


class Bits:
    """A bit vector with counts before each 64-bit word, for selection."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        ones = np.bitwise_count(words).astype(np.int64)
        self.ones = np.r_[0, np.cumsum(ones)]
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    @classmethod
    def of(cls, places: np.ndarray, size: int) -> Bits:
        flat = np.zeros(-(-size // 64) * 64, np.uint8)
        flat[places] = 1
        return cls(np.packbits(flat, bitorder="little").view("<u8"))

    def select(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Place of the ``k``-th (from 0) one or zero."""
        before = self.ones if bit else self.zeros
        at = np.searchsorted(before, k, "right") - 1
        word = self.words[at] if bit else ~self.words[at]
        left, place = k - before[at], np.zeros(len(k), np.uint64)
        for half in (32, 16, 8, 4, 2, 1):  # halve the word until one bit is left
            low = np.bitwise_count((word >> place) & np.uint64((1 << half) - 1)).astype(np.int64)
            up = left >= low
            left = left - np.where(up, low, 0)
            place += np.where(up, np.uint64(half), np.uint64(0))
        return at * 64 + place.astype(np.int64)


class EliasFano:
    """A sequence of integers that never falls: low bits packed, high parts as a bit vector with a one for each value."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray) -> None:
        self.n, self.bits, self.low, self.high = n, bits, low, Bits(high)

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        bits = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits and n:
            part, at = values & np.uint64((1 << bits) - 1), np.arange(n, dtype=np.int64) * bits
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.add.at(low, word, part << shift)  # the bits of different values do not overlap
            over = shift + np.uint64(bits) > np.uint64(64)
            np.add.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        high = (values >> np.uint64(bits)).astype(np.int64)
        top = (max(1, universe) >> bits) + 1
        return cls(n, bits, low, Bits.of(high + np.arange(n), n + top + 1).words)

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        first = self.low[word] >> shift
        second = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (first | second) & np.uint64((1 << self.bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i``."""
        high = (self.high.select(i, 1) - i).astype(np.uint64)
        return (high << np.uint64(self.bits)) | self.lows(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value not below each ``x``, ``n`` if there is none; ``x`` lies in the universe."""
        x = x.astype(np.uint64)
        high = (x >> np.uint64(self.bits)).astype(np.int64)
        low = x & np.uint64((1 << self.bits) - 1)
        end = self.high.select(high, 0) - high
        start = np.where(high > 0, self.high.select(np.maximum(high - 1, 0), 0) - high + 1, 0)
        while (open_ := np.flatnonzero(start < end)).size:
            mid = (start[open_] + end[open_]) // 2
            less = self.lows(mid) < low[open_]
            start[open_[less]] = mid[less] + 1
            end[open_[~less]] = mid[~less]
        return start

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each ``x``, -1 where it is not in the sequence."""
        if not self.n or not len(x):
            return np.full(len(x), -1)
        at = self.successor(x)
        hit = at < self.n
        hit[hit] = self.access(at[hit]) == x[hit].astype(np.uint64)
        return np.where(hit, at, -1)

    def dump(self) -> bytes:
        head = np.array([self.n, self.bits, len(self.low), len(self.high.words)], "<u8")
        return b"".join(a.astype("<u8").tobytes() for a in (head, self.low, self.high.words))

    @classmethod
    def load(cls, data: bytes) -> EliasFano:
        """Read in place: the arrays are views of the buffer."""
        n, bits, low, high = np.frombuffer(data, "<u8", 4).tolist()
        return cls(n, bits, np.frombuffer(data, "<u8", low, 32), np.frombuffer(data, "<u8", high, 32 + 8 * low))


# Logarithms are stored as 16-bit steps below zero.
STEPS, DEEPEST = 65535, 16.0


def quantise(log: np.ndarray) -> np.ndarray:
    return np.round(np.clip(-log, 0, DEEPEST) / DEEPEST * STEPS).astype("<u2")


def restore(code: np.ndarray) -> np.ndarray:
    return code.astype(float) * (-DEEPEST / STEPS)


class Trie:
    """Words and their successors. Level 1 holds word hashes, level 2 the successors of each word.

    A successor is named by its place among all successors known here; level 2 holds word place * number of names + name, so
    a word's successors are one range, which monotone pointers delimit and a successor search relative to the word looks up.
    """

    def __init__(self, words: EliasFano, names: EliasFano, pointers: EliasFano, next_: EliasFano, codes: np.ndarray) -> None:
        self.words, self.names, self.pointers, self.next, self.codes = words, names, pointers, next_, codes

    @classmethod
    def of(cls, first: np.ndarray, second: np.ndarray, log: np.ndarray, bits: int) -> Trie:
        """From different pairs sorted by (first, second), and the logarithm of each."""
        words, place = np.unique(first, return_inverse=True)
        names, name = np.unique(second, return_inverse=True)
        universe = max(1, len(words)) * max(1, len(names))
        ends = np.searchsorted(place, np.arange(len(words) + 1))
        parts = EliasFano.of(words, 1 << bits), EliasFano.of(names, 1 << bits), EliasFano.of(ends, len(first) + 1)
        return cls(*parts, EliasFano.of(place * max(1, len(names)) + name, universe), quantise(log))

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Place of each pair in level 2, -1 if it is not there."""
        out = np.full(len(first), -1)
        firsts, of_first = np.unique(first, return_inverse=True)
        seconds, of_second = np.unique(second, return_inverse=True)
        word, name = self.words.find(firsts), self.names.find(seconds)
        known = np.maximum(word, 0)
        begin, end = (self.pointers.access(known + k).astype(np.int64) for k in (0, 1)) if self.words.n else (known, known)
        both = np.flatnonzero((word >= 0)[of_first] & (name >= 0)[of_second])
        if len(both):
            w = of_first[both]
            at = self.next.find(word[w] * self.names.n + name[of_second[both]])
            out[both] = np.where((at >= begin[w]) & (at < end[w]), at, -1)
        return out
