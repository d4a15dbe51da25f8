"""Vectorised 64-bit fingerprints of words and of runs of words."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at once.
STRETCH = 4 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Any fixed odd multiplier and table of random values does.
_BASE = np.uint64(0x9FB21C651E98DF25)
_VALUES = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64)
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    x = np.asarray(x, dtype=np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of a multiplier and of its inverse, as many as were asked for."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 2**64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            self.up, self.down = (
                np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b)], dtype=np.uint64) for b in (self.base, self.inverse))
        return self.up, self.down


_BYTES = _Powers(_BASE)
_WORDS = _Powers(np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie side by side in ``data``.

    Words are runs of bytes other than space and 0x09 to 0x0D; a text's end ends its word.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    before = np.r_[False, inside[:-1]]
    bounds = offsets[(offsets > 0) & (offsets < len(data))]
    before[bounds] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.r_[inside[1:], False]
    after[bounds - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A hash of each word's bytes, A-Z lower-cased if asked for: a polynomial over random byte values, mixed with the length."""
    values = _VALUES[_LOWER] if lower else _VALUES
    out, first = np.empty(len(starts), dtype=np.uint64), 0
    while first < len(starts):
        origin = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, origin + STRETCH, side="right")))
        stop = int(ends[last - 1])
        up, down = _BYTES.upto(stop - origin)
        sums = np.zeros(stop - origin + 1, dtype=np.uint64)
        np.cumsum(values[data[origin:stop]] * up[: stop - origin], out=sums[1:])
        a, b = starts[first:last] - origin, ends[first:last] - origin
        out[first:last] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * _BASE)
        first = last
    return out


def run_hashes(words: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """A hash of each run of ``length`` neighbouring words, whatever text they belong to."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _WORDS.upto(len(words))
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(mix(words, salt) * up[: len(words)], out=sums[1:])
    return mix((sums[length:] - sums[:n]) * down[:n], salt)
