"""A wavelet matrix over small codes: rank and select for many positions at once.

The codes are split by bits, highest first. Each level keeps one bit a code in 64-bit
words with the number of set bits before every word, and deals the codes stably by that
bit, zeros first. A rank walks down the levels, a select down and up again; neither looks
at the codes.
"""

from __future__ import annotations

import numpy as np


class BitVector:
    """Bits with rank and select; positions and counts are arrays."""

    def __init__(self, flags: np.ndarray):
        self.n = len(flags)
        padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
        padded[: self.n] = flags
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.ones = int(self.before[-1])

    def rank(self, bit: int, i: np.ndarray) -> np.ndarray:
        """How many of the first i bits are ``bit``."""
        word = i >> 6
        inside = self.words[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        ones = self.before[word] + np.bitwise_count(inside)
        return ones if bit else i - ones

    def select(self, bit: int, k: np.ndarray) -> np.ndarray:
        """Where the k-th (from 0) ``bit`` stands; it must exist."""
        before = self.before if bit else 64 * np.arange(len(self.before)) - self.before
        word = np.searchsorted(before, k, side="right") - 1
        bits = np.unpackbits(self.words[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.cumsum(bits == bit, axis=1)
        return word * 64 + np.argmax(counts > (k - before[word])[:, None], axis=1)


class WaveletMatrix:
    """Codes below 2^depth."""

    def __init__(self, codes: np.ndarray, depth: int):
        self.n, self.levels = len(codes), []
        for bit in range(depth - 1, -1, -1):
            flags = codes >> bit & 1
            bits = BitVector(flags)
            self.levels.append((bit, bits, bits.n - bits.ones))
            codes = np.concatenate([codes[flags == 0], codes[flags == 1]])

    def rank(self, code: int, i: np.ndarray) -> np.ndarray:
        """How many of the first i codes are ``code``."""
        low, high = np.zeros_like(i), i
        for bit, bits, zeros in self.levels:
            one = code >> bit & 1
            low, high = (bits.rank(one, x) + one * zeros for x in (low, high))
        return high - low

    def select(self, code: int, k: np.ndarray) -> np.ndarray:
        """Where the k-th (from 0) ``code`` stands; it must exist."""
        at = np.zeros_like(k)
        for bit, bits, zeros in self.levels:
            one = code >> bit & 1
            at = bits.rank(one, at) + one * zeros
        at = at + k
        for bit, bits, zeros in reversed(self.levels):
            one = code >> bit & 1
            at = bits.select(one, at - one * zeros)
        return at

    def rank_of(self, codes: tuple[int, ...], i: np.ndarray) -> np.ndarray:
        """How many of the first i codes are one of ``codes``."""
        return sum((self.rank(c, i) for c in codes), np.zeros_like(i))

    def select_of(self, codes: tuple[int, ...], k: np.ndarray) -> np.ndarray:
        """Where the k-th of ``codes`` stands: select for one, bisection on ranks for several."""
        if len(codes) == 1:
            return self.select(codes[0], k)
        low, high = np.zeros_like(k), np.full_like(k, self.n)
        while (low < high).any():  # first place whose rank with itself exceeds k
            middle = (low + high) >> 1
            enough = self.rank_of(codes, np.minimum(middle + 1, self.n)) > k
            high = np.where(enough, middle, high)
            low = np.where(enough | (low >= high), low, middle + 1)
        return low
