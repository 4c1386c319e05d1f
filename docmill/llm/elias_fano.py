"""Monotone sequences in Elias-Fano form, in files that tasks map into memory.

Each value is split: the low bits lie side by side, the high parts are unary in a
bit vector, for which the numbers of ones and zeros before each 64-bit word are
kept. All lookups are vectorised over many queries.
"""

from __future__ import annotations

import numpy as np

_W = np.uint64(64)
_ONE = np.uint64(1)
#: A sequence is decoded once there is a query for every so many values.
_DENSE = 16

_BYTE_SELECT = np.zeros((256, 8), dtype=np.uint8)
for _byte in range(256):
    for _k, _bit in enumerate([i for i in range(8) if _byte >> i & 1]):
        _BYTE_SELECT[_byte, _k] = _bit


def encode(values: np.ndarray, universe: int) -> np.ndarray:
    """Ascending values below ``universe`` as one array of 64-bit words: four numbers of
    head, then low bits, high bits, ones before each word, zeros before each word."""
    values = values.astype(np.uint64)
    n = len(values)
    low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
    low = np.zeros(-(-n * low_bits // 64) + 1, dtype=np.uint64)
    if low_bits and n:
        part = values & np.uint64((1 << low_bits) - 1)
        at = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        _or_at(low, word, part << shift)
        over = shift + np.uint64(low_bits) > _W
        _or_at(low, word[over] + 1, part[over] >> (_W - shift[over]))
    high = (values >> np.uint64(low_bits)).astype(np.int64)
    top = int(high[-1]) if n else 0
    words = np.zeros((n + top + 1) // 64 + 1, dtype=np.uint64)
    ones_at = high + np.arange(n)
    _or_at(words, ones_at >> 6, _ONE << (ones_at & 63).astype(np.uint64))
    per_word = np.bitwise_count(words).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(per_word)[:-1]])
    zeros = np.arange(len(words)) * 64 - before
    head = np.array([n, low_bits, len(low), len(words)], dtype=np.uint64)
    return np.concatenate([head, low, words, before.astype(np.uint64), zeros.astype(np.uint64)])


def _or_at(out: np.ndarray, word: np.ndarray, bits: np.ndarray) -> None:
    """Or into ascending words: equal ones are first combined."""
    if len(word):
        starts = np.concatenate([[0], np.nonzero(np.diff(word))[0] + 1])
        out[word[starts]] |= np.bitwise_or.reduceat(bits, starts)


class EliasFano:
    """An encoded sequence; ``data`` may be a memory map."""

    def __init__(self, data: np.ndarray):
        n, low_bits, low_words, high_words = (int(x) for x in data[:4])
        self.n, self.low_bits = n, low_bits
        at = 4
        self.low, at = data[at : at + low_words], at + low_words
        self.high, at = data[at : at + high_words], at + high_words
        self.ones, at = data[at : at + high_words], at + high_words
        self.zeros = data[at : at + high_words]

    def _select(self, before: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
        """Positions of the k-th ones, or with ``flip`` zeros (from 0)."""
        word = np.searchsorted(before, k.astype(np.uint64), side="right") - 1
        left = k - before[word].astype(np.int64)
        bits = self.high[word]
        if flip:
            bits = ~bits
        at = word * 64
        for width in (32, 16, 8):  # halve the word around the bit
            lower = np.bitwise_count(bits & np.uint64((1 << width) - 1))
            beyond = left >= lower
            left = left - np.where(beyond, lower, 0)
            bits = np.where(beyond, bits >> np.uint64(width), bits)
            at = at + np.where(beyond, width, 0)
        return at + _BYTE_SELECT[(bits & np.uint64(255)).astype(np.int64), np.minimum(left, 7)]

    def _ones_from(self, bit: np.ndarray) -> np.ndarray:
        """How many ones follow from a bit on, up to 64."""
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        follow = self.high[np.minimum(word + 1, len(self.high) - 1)]
        window = self.high[word] >> shift
        over = shift > 0
        window[over] |= follow[over] << (_W - shift[over])
        unset = ~window
        lowest = unset & (~unset + _ONE)
        return np.where(unset == 0, 64, np.log2(np.maximum(lowest, _ONE)).astype(np.int64))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        out = self.low[word] >> shift
        over = shift + np.uint64(self.low_bits) > _W
        out[over] |= self.low[word[over] + 1] << (_W - shift[over])
        return out & np.uint64((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        """All values, decoded one after another."""
        bits = np.unpackbits(np.ascontiguousarray(self.high).view(np.uint8), bitorder="little")
        high = (np.flatnonzero(bits) - np.arange(self.n)).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low(np.arange(self.n))

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        high = (self._select(self.ones, i, False) - i).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The position of the first value that is not smaller than each x (or, if it has
        another high part, of the end of that of x), and whether it equals x."""
        x = x.astype(np.uint64)
        if self.n and len(x) * _DENSE > self.n:
            # so many queries that decoding the sequence once costs less than searching it
            values = self.all()
            at = np.searchsorted(values, x)
            return at, values[np.minimum(at, self.n - 1)] == x
        if not self.n:
            return np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=bool)
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        all_zeros = len(self.high) * 64 - self.n
        inside = high < all_zeros
        h = np.where(inside, high, 0)
        # The bucket of a high part starts behind the zero before it; its ones follow.
        bit = np.where(h > 0, self._select(self.zeros, np.maximum(h - 1, 0), True) + 1, 0)
        start, end = bit - h, bit - h + self._ones_from(bit)
        full = np.nonzero(end - start == 64)[0]
        if len(full):
            end[full] = self._select(self.zeros, h[full], True) - h[full]
        end = np.where(inside, end, 0)
        start = np.where(inside, np.minimum(start, end), 0)
        want = x & np.uint64((1 << self.low_bits) - 1)
        low, high_ = start.copy(), end.copy()
        open_ = np.nonzero(low < high_)[0]
        while len(open_):
            middle = (low[open_] + high_[open_]) >> 1
            less = self._low(middle) < want[open_]
            low[open_] = np.where(less, middle + 1, low[open_])
            high_[open_] = np.where(less, high_[open_], middle)
            open_ = open_[low[open_] < high_[open_]]
        found = low < end
        at = np.minimum(low, max(self.n - 1, 0))
        equal = np.zeros(len(x), dtype=bool)
        equal[found] = self._low(at[found]) == want[found]
        return low, equal
