"""Hashes of the words of many texts at once, with array operations over their UTF-8 bytes.

A word is a maximal run of ASCII letters, digits and non-ASCII characters; A-Z count as a-z.
A word's hash is a polynomial in its bytes modulo 2**64, read off prefix sums, then mixed.
"""

from __future__ import annotations

import numpy as np

SPAN = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTES = _rng.integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = np.zeros(256, bool)
_WORD[ord("0") : ord("9") + 1] = _WORD[ord("a") : ord("z") + 1] = _WORD[ord("A") : ord("Z") + 1] = True
_WORD[128:] = True
_BYTES[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit value."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    n = SPAN if n <= SPAN else n
    if n not in _powers:
        tables = []
        for base in (_BASE, _INVERSE):
            t = np.full(n, base, np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        if n > SPAN:
            return tables[0], tables[1]
        _powers[n] = (tables[0], tables[1])
    return _powers[n]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; a word never spans two texts."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = _WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and for each text the number of words before it (one more at the end)."""
    starts, ends = word_bounds(data, offsets)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + SPAN, "right")))
        part = data[lo : ends[j - 1]]
        power, inverse = _power_tables(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[part] * power[: len(part)], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * inverse[s]
        i = j
    return mix(out), np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and their bounds by text.

    A text of fewer words has one shingle of all its words; a text without words has none.
    """
    counts = np.diff(first)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(n)))
    out = np.zeros(bounds[-1], np.uint64)
    doc = np.repeat(np.arange(len(n)), n)
    at = first[:-1][doc] + (np.arange(len(out)) - bounds[:-1][doc])
    size = np.minimum(counts, width)[doc]
    for k in range(width):
        have = k < size
        if have.all():
            out = out * np.uint64(0x9FB21C651E98DF25) + words[at + k]
        else:
            out[have] = out[have] * np.uint64(0x9FB21C651E98DF25) + words[at[have] + k]
    return mix(out + size.astype(np.uint64)), bounds
