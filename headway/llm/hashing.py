"""Vectorised 64-bit hashes of spans of a byte array, by prefix sums modulo 2**64."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: A random number for each byte value, from a fixed seed.
BYTES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Space and the bytes 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 1 << 23:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Murmur's final mixing of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefix_sums(flat: np.ndarray) -> np.ndarray:
    """The n+1 running sums from which ``span_hashes`` takes any span."""
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(BYTES[flat] * powers(BASE, len(flat)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each span's bytes, wherever it stands; lengths count too."""
    raw = (sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


def word_spans(is_word: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes in each text, and the n+1 offsets of texts into them."""
    n = len(is_word)
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    starts = is_word & cut[:-1]
    starts[1:] |= is_word[1:] & ~is_word[:-1]
    ends = is_word & cut[1:]
    ends[:-1] |= is_word[:-1] & ~is_word[1:]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return first, last, np.searchsorted(first, bounds)


def gram_hashes(flat: np.ndarray, n: int) -> np.ndarray:
    """The hash of the ``n`` bytes from every position on that has so many, by doubling."""
    if len(flat) < n:
        return np.zeros(0, np.uint64)
    parts, size, have = [], 1, BYTES[flat]
    rest = n
    while rest:
        if rest & 1:
            parts.append((size, have))
        rest >>= 1
        if rest:
            have = have[:-size] * np.uint64(pow(BASE, size, 1 << 64)) + have[size:]
            size *= 2
    count = len(flat) - n + 1
    total, at = np.zeros(count, np.uint64), 0
    for size, values in parts:
        total = total * np.uint64(pow(BASE, size, 1 << 64)) + values[at : at + count]
        at += size
    return mix(total)
