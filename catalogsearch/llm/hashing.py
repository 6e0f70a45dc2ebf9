"""Hashes of words, shingles and byte windows of a text, computed for all places at once."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
BLOCK = 1 << 20

#: White space between words.
SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a hash over all bits (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


class ByteHasher:
    """Polynomial hashes of spans of a text's bytes, modulo 2^64."""

    def __init__(self):
        self.up = powers(BASE, BLOCK + 1)
        self.down = powers(pow(BASE, -1, 1 << 64), BLOCK + 1)

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each span; starts ascend. Blocks of a long text are hashed one after the other."""
        if len(data) <= BLOCK:
            return self._spans(data, starts, ends)
        out = np.zeros(len(starts), np.uint64)
        first = 0
        while first < len(starts):
            base = int(starts[first])
            last = int(np.searchsorted(ends, base + BLOCK, "right"))
            if last <= first:  # a span longer than a block: the hash of its blocks' hashes
                parts = np.arange(base, int(ends[first]), BLOCK)
                each = np.concatenate([self._spans(data[p : min(p + BLOCK, int(ends[first]))], np.array([0]), np.array([min(BLOCK, int(ends[first]) - p)])) for p in parts])
                out[first] = np.bitwise_xor.reduce(mix(each + np.arange(1, len(each) + 1, dtype=np.uint64)))
                last = first + 1
            else:
                part = data[base : base + BLOCK]
                out[first:last] = self._spans(part, starts[first:last] - base, ends[first:last] - base)
            first = last
        return out

    def _spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text's bytes begin and end."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~SPACE_BYTES[data]
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes, sorted, of all runs of `size` words; of all words together if there are fewer."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = (out + words[j : j + n]) * np.uint64(BASE + 2 * j)
    return np.unique(mix(out))
