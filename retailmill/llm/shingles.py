"""Word shingles as 64-bit hashes, for many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WIDTH = 5
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint64) + np.uint64(1)
SPACE = np.isin(_BYTES, [32, 9, 10, 11, 12, 13])


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n + 1, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = pow(_BASE, -1, 1 << 64)


def inverse_powers(n: int) -> np.ndarray:
    out = np.full(n + 1, _INVERSE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Hashes of the lower-cased words of texts, all in one array; ``first`` has where
    each text's words begin. Whitespace is ASCII's; A-Z become a-z."""

    def __init__(self, texts: list[str]):
        col = pa.array(texts, pa.large_binary()) if texts else pa.array([], pa.large_binary())
        offsets = np.frombuffer(col.buffers()[1], np.int64, len(texts) + 1)
        data = np.frombuffer(col.buffers()[2] or b"", np.uint8, offsets[-1])
        n = len(data)
        is_word = np.empty(n + 1, bool)
        np.logical_not(SPACE[data], out=is_word[:n])
        is_word[n] = False
        begin = is_word.copy()
        begin[1:] &= ~is_word[:-1]
        cut = offsets[:-1][offsets[:-1] < n]
        begin[cut] = is_word[cut]
        starts = np.flatnonzero(begin)
        stops = ~is_word
        stops[cut] = True
        stops[n] = True
        ends = np.flatnonzero(stops)
        ends = ends[np.searchsorted(ends, starts, side="right")] if len(starts) else starts
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(LOWER[data] * powers(n)[:n], out=total[1:])
        raw = (total[ends] - total[starts]) * inverse_powers(n)[starts]
        self.hashes = mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        self.first = np.searchsorted(starts, offsets)


#: Characters that are hashed at once; the arrays take about 60 bytes for each.
AT_ONCE = 500_000


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; one of all its words
    if they are fewer than a shingle's, none without words."""
    out, first, size = [], 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > AT_ONCE:
            out += _sets_of(texts[first:k])
            first, size = k, 0
        size += len(text)
    return out + _sets_of(texts[first:])


def _sets_of(texts: list[str]) -> list[np.ndarray]:
    words = Words(texts)
    h = words.hashes
    whole = np.zeros(max(0, len(h) - WIDTH + 1), np.uint64)
    factor = powers(WIDTH + 1)[1:]
    for k in range(WIDTH):
        whole += h[k : len(h) - WIDTH + 1 + k] * factor[k] if len(whole) else 0
    whole = mixed(whole)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= WIDTH:
            own = np.sort(whole[a : b - WIDTH + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif b > a:
            own = h[a:b]
            out.append(mixed(np.array([(own * factor[: b - a]).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
