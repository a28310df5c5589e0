"""Elias-Fano sequences and bit vectors over memory-mapped words, vectorised.

A monotone sequence is split into low parts of whole bytes and high parts in
unary: one set bit per value after as many zeros as its high part. Finding a
value selects two zeros (the limits of its high part) and searches the low
parts between them. All queries take arrays and touch only the mapped pages
they need.
"""

from __future__ import annotations

import numpy as np

BLOCK = 8  # words of 64 bits per directory entry


def _zero_places() -> np.ndarray:
    """Place of the k-th zero bit of every byte (8 where there is none)."""
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    out = np.full((256, 8), 8, np.uint8)
    for byte in range(256):
        zeros = np.flatnonzero(bits[byte] == 0)
        out[byte, : len(zeros)] = zeros
    return out


_PLACE = _zero_places()
_SHIFTS = (np.arange(8, dtype=np.uint64) * np.uint64(8))


class Unary:
    """Bit vector with constant-step selection of zeros."""

    def __init__(self, words: np.ndarray, zeros_before: np.ndarray):
        self.words, self.zeros_before = words, zeros_before

    @staticmethod
    def build(highs: np.ndarray, n_zeros: int) -> dict[str, np.ndarray]:
        """Arrays of the vector in which value ``i`` is a one after ``highs[i]`` zeros."""
        size = len(highs) + n_zeros
        n_words = -(-size // (64 * BLOCK)) * BLOCK
        bits = np.zeros(n_words * 64, np.uint8)
        bits[highs.astype(np.int64) + np.arange(len(highs))] = 1
        bits[size:] = 1  # padding holds no zeros
        words = np.packbits(bits, bitorder="little").view("<u8")
        zeros = 64 * BLOCK - np.bitwise_count(words).astype(np.int64).reshape(-1, BLOCK).sum(axis=1)
        return {"words": words, "zeros_before": np.concatenate(([0], np.cumsum(zeros)[:-1])).astype("<u8") if len(zeros) else np.zeros(0, "<u8")}

    def select0(self, k: np.ndarray) -> np.ndarray:
        """Place of zero number ``k`` (from 0)."""
        block = np.searchsorted(self.zeros_before, k.astype(np.uint64), "right") - 1
        left = k - self.zeros_before[block].astype(np.int64)
        word = block * BLOCK
        for _ in range(BLOCK - 1):
            zeros = 64 - np.bitwise_count(self.words[word]).astype(np.int64)
            step = left >= zeros
            left -= np.where(step, zeros, 0)
            word += step
        value = self.words[word]
        byte = np.zeros(len(k), np.int64)
        for _ in range(7):
            zeros = 8 - np.bitwise_count((value >> _SHIFTS[byte]).astype(np.uint8)).astype(np.int64)
            step = left >= zeros
            left -= np.where(step, zeros, 0)
            byte += step
        last = (value >> _SHIFTS[byte]).astype(np.uint8)
        return word * 64 + byte * 8 + _PLACE[last, left]

    def ones_before_zero(self, k: np.ndarray) -> np.ndarray:
        """Number of ones before zero number ``k``; -1 stands before them all."""
        out = np.zeros(len(k), np.int64)
        some = k >= 0
        out[some] = self.select0(k[some]) - k[some]
        return out


def to_bytes(values: np.ndarray, width: int) -> np.ndarray:
    """Low ``width`` bytes of each value, row by row."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).reshape(-1)


def from_bytes(raw: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for b in range(width):
        out |= raw[at * width + b].astype(np.uint64) << _SHIFTS[b]
    return out


def search(raw: np.ndarray, width: int, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of ``x`` among the ascending byte rows ``[lo, hi)``, or -1."""
    lo, end = lo.copy(), hi
    hi = hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            break
        mid = (lo[open_] + hi[open_]) >> 1
        less = from_bytes(raw, width, mid) < x[open_]
        lo[open_] = np.where(less, mid + 1, lo[open_])
        hi[open_] = np.where(less, hi[open_], mid)
    out = np.full(len(x), -1, np.int64)
    inside = np.flatnonzero(lo < end)
    hit = inside[from_bytes(raw, width, lo[inside]) == x[inside]]
    out[hit] = lo[hit]
    return out


class EliasFano:
    """Strictly ascending unsigned values below ``universe``."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.width = (int(v) for v in arrays["shape"])
        self.high = Unary(arrays["words"], arrays["zeros_before"])
        self.low = arrays["low"]
        self.n_zeros = int(arrays["n_zeros"][0])

    @staticmethod
    def build(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
        n = len(values)
        best = max(0, (universe // max(n, 1)).bit_length() - 1)
        width = min(7, (best + 4) // 8)  # whole bytes: the nearest number of them
        values = values.astype(np.uint64)
        highs = values >> np.uint64(8 * width)
        n_zeros = ((universe - 1) >> (8 * width)) + 1 if universe else 1
        return Unary.build(highs, n_zeros) | {
            "low": to_bytes(values, width), "shape": np.array([n, width], "<u8"), "n_zeros": np.array([n_zeros], "<u8"),
        }

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each value of ``x``, or -1."""
        if not self.n:
            return np.full(len(x), -1, np.int64)
        shift = np.uint64(8 * self.width)
        high = (x >> shift).astype(np.int64)
        inside = high < self.n_zeros
        high = np.where(inside, high, 0)
        lo, hi = self.high.ones_before_zero(high - 1), self.high.ones_before_zero(high)
        if not self.width:
            return np.where(inside & (lo < hi), lo, -1)
        found = search(self.low, self.width, lo, hi, x & ((np.uint64(1) << shift) - np.uint64(1)))
        return np.where(inside, found, -1)
