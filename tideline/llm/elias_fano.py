"""Elias-Fano coding of rising sequences, read in place from mapped bytes, with vectorised access and search.

n values under u take 2 bits each, l = log2(u / n) more for their low parts, and half a bit for a directory. The high
parts are a bit vector in which value i sets bit (value >> l) + i; the directory holds the ones before each 64-bit word.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


def encode(values: np.ndarray) -> bytes:
    """The coded bytes of rising (not strictly) unsigned values."""
    values = values.astype(np.uint64)
    n = len(values)
    most = int(values[-1]) if n else 0
    low = max(0, (most // n).bit_length() - 1) if n else 0
    high = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    size = (int(high[-1]) + 2 if n else 1) // 64 + 1
    bits = np.zeros(size * 64, dtype=np.uint8)
    bits[high] = 1
    words = np.packbits(bits, bitorder="little").view("<u8")
    before = np.concatenate(([0], np.cumsum(np.bitwise_count(words))[:-1])).astype("<u4" if n < 1 << 32 else "<u8")
    lows = np.zeros(n * low // 64 + 2, dtype=np.uint64)
    if low:
        part = values & np.uint64((1 << low) - 1)
        at = np.arange(n, dtype=np.uint64) * np.uint64(low)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(lows, word, part << shift)
        over = np.flatnonzero(shift + np.uint64(low) > 64)
        np.bitwise_or.at(lows, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
    head = np.array([n, low, len(words), len(lows), before.itemsize], dtype="<u8")
    pad = b"\0" * (-before.nbytes % 8)
    return b"".join((head.tobytes(), words.tobytes(), lows.astype("<u8").tobytes(), before.tobytes(), pad))


class EliasFano:
    """A coded sequence over the bytes of data from `at` on."""

    def __init__(self, data, at: int = 0) -> None:
        self.n, self.low, n_words, n_lows, width = np.frombuffer(data, "<u8", 5, at).tolist()
        at += 40
        self.words = np.frombuffer(data, "<u8", n_words, at)
        self.lows = np.frombuffer(data, "<u8", n_lows, at + 8 * n_words)
        self.before = np.frombuffer(data, f"<u{width}", n_words, at + 8 * (n_words + n_lows))
        self.end = at + 8 * (n_words + n_lows) + -(-width * n_words // 8) * 8

    def _select(self, rank: np.ndarray, ones: bool) -> np.ndarray:
        """Positions of the rank-th (from 0) ones or zeros."""
        before = self.before if ones else 64 * np.arange(len(self.before)) - self.before.astype(np.int64)
        word = np.searchsorted(before, rank, side="right") - 1
        left = rank - before[word].astype(np.int64)
        bits = self.words[word] if ones else ~self.words[word]
        place = np.zeros(len(rank), dtype=np.uint64)
        for step in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count((bits >> place) & np.uint64((1 << step) - 1)).astype(np.int64)
            go = left >= count
            left = left - count * go
            place += np.uint64(step) * go
        return word * 64 + place.astype(np.int64)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), dtype=np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        value = self.lows[word] >> shift
        over = shift + np.uint64(self.low) > 64
        value[over] |= self.lows[word[over] + 1] << (np.uint64(64) - shift[over])
        return value & np.uint64((1 << self.low) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        if not len(i):
            return np.empty(0, dtype=np.uint64)
        high = self._select(i.astype(np.int64), True) - i
        return (high.astype(np.uint64) << np.uint64(self.low)) | self._low(i)

    def find(self, values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """For each value the first place in [start, stop) that holds it, or -1: the run of equal high parts is bounded by
        two zeros of the bit vector, and searched by low parts."""
        out = np.full(len(values), -1, dtype=np.int64)
        if not len(values) or not self.n:
            return out
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.low)).astype(np.int64)
        zeros = 64 * len(self.words) - self.n
        ok = np.flatnonzero((high < zeros) & (start < stop))
        if not len(ok):
            return out
        h = high[ok]
        last = self._select(h, False) - h
        first = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - h + 1, 0)
        a, b = np.maximum(first, start[ok]), np.minimum(last, stop[ok])
        wanted = values[ok] & np.uint64((1 << self.low) - 1)
        lo, hi = a.copy(), np.maximum(b, a)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            middle = (lo[open_] + hi[open_]) >> 1
            less = self._low(middle) < wanted[open_]
            lo[open_[less]] = middle[less] + 1
            hi[open_[~less]] = middle[~less]
            open_ = open_[lo[open_] < hi[open_]]
        inside = np.flatnonzero(lo < b)
        hit = inside[self._low(lo[inside]) == wanted[inside]]
        out[ok[hit]] = lo[hit]
        return out
