"""Vectorised hashes of words and byte windows (numpy), for the operators on whole texts.

A prefix sum of table[byte] * B**i modulo 2**64 gives the value of any substring as a difference
times B**-start; a 64-bit finaliser mixes it.  Equal bytes have equal values; unequal ones agree
with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

import functools

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240607).integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Sums:
    """Prefix sums over an array of bytes."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(19, int(len(data) + 1).bit_length())
        up, self._down = _powers(size)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * up[: len(data)], out=self._sums[1:])

    def value(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Unmixed values of data[start:end], for arrays of positions."""
        return (self._sums[end] - self._sums[start]) * self._down[start]

    def grams(self, n: int) -> np.ndarray:
        """Mixed values of all n-grams."""
        if len(self._sums) <= n:
            return np.empty(0, np.uint64)
        return mix((self._sums[n:] - self._sums[:-n]) * self._down[: len(self._sums) - n])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    blocks = -(-len(x) // w)
    padded = np.full(blocks * w, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    table = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of non-space, A-Z lower-cased) and the text that each is in."""
    parts = [t.encode() for t in texts]
    data = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)]
    inside = ~_SPACE[data]
    before = np.concatenate(([False], inside[:-1]))
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
    sums = Sums(data)
    value = mix(sums.value(start, end) ^ mix((end - start).astype(np.uint64)))
    ends = np.cumsum([len(p) + 1 for p in parts])
    return value, np.searchsorted(ends, start, side="right")


def shingles(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct n-word shingle hashes of each text; of fewer words, the whole sequence as one; none without words."""
    value, owner = words(texts)
    counts = np.bincount(owner, minlength=len(texts))
    m = max(0, len(value) - n + 1)
    whole = np.zeros(m, np.uint64)
    for i in range(n):
        whole = mix(whole ^ (value[i : i + m] + _U(i + 1)))
    out, at = [], 0
    for count in counts.tolist():
        if count >= n:
            out.append(np.unique(whole[at : at + count - n + 1]))
        elif count:
            h = np.zeros(1, np.uint64)
            for i in range(count):
                h = mix(h ^ (value[at + i : at + i + 1] + _U(i + 1)))
            out.append(mix(h + _U(count)))
        else:
            out.append(np.empty(0, np.uint64))
        at += count
    return out
