"""Vectorised hashing of words, windows and byte ranges in numpy.

A range's hash is a pair of polynomials over random tables of byte values, modulo two primes
near 2**31, taken from prefix sums, so that all words of a batch cost a few array passes.
(Modulo a power of two some texts of one form would always hash alike, whatever the base.)"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
MULTIPLIERS = _RNG.integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)
PRIMES = (2**31 - 1, 2**31 - 19)
_BASES = tuple(int(_RNG.integers(2**29, p)) for p in PRIMES)
BYTE_VALUES = tuple(_RNG.integers(1, p, 256, dtype=np.uint64) for p in PRIMES)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}

#: The six ASCII white-space bytes that separate words.
SPACE_BYTES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
IS_WORD_BYTE = np.ones(256, bool)
IS_WORD_BYTE[list(SPACE_BYTES)] = False


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(n: int, which: int, up: bool) -> np.ndarray:
    """The first n powers of a base, or of its inverse, modulo its prime."""
    made, prime = _POWERS.get((which, up)), PRIMES[which]
    if made is None:
        made = np.ones(1, np.uint32)
    base = _BASES[which] if up else pow(_BASES[which], -1, prime)
    while len(made) < n:
        step = np.uint64(pow(base, len(made), prime))
        made = np.concatenate([made, (made.astype(np.uint64) * step % np.uint64(prime)).astype(np.uint32)])
    _POWERS[which, up] = made
    return made[:n]


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums of a byte array (one longer than it), a row for each prime.
    Terms are below 2**31, so the sums of up to 2**32 bytes are exact."""
    out = np.zeros((len(PRIMES), len(buf) + 1), np.uint64)
    for k, prime in enumerate(PRIMES):
        np.cumsum(BYTE_VALUES[k][buf] * _powers(len(buf), k, True) % np.uint64(prime), out=out[k, 1:])
    return out


def range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges: equal for equal bytes, wherever they stand."""
    parts = []
    for k, prime in enumerate(PRIMES):
        p = np.uint64(prime)
        parts.append((sums[k][end] - sums[k][start]) % p * _powers(sums.shape[1], k, False)[start] % p)
    size = (np.asarray(end) - np.asarray(start)).astype(np.uint64)
    return mix((parts[0] << np.uint64(32) | parts[1]) + size * np.uint64(0x9E3779B97F4A7C15))


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a byte array."""
    edge = np.diff(np.concatenate(([False], IS_WORD_BYTE[buf], [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` consecutive word hashes."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for i in range(n):
        h += words[i:i + m] * MULTIPLIERS[i]
        h ^= h >> np.uint64(29)
    return mix(h)


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One byte array of all texts, a newline after each, and each text's start and end in it."""
    size = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    end = np.cumsum(size + 1) - 1
    return np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8), end - size, end
