"""Vectorised hashes of words and word shingles over whole Arrow batches."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240607)
_BYTES = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(max(n, 1 << 20), base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, bounds): text i's words are ``hashes[bounds[i]:bounds[i + 1]]``.

    Words are runs of anything but ASCII white space; a word's hash is a
    polynomial of its bytes modulo 2**64, read off one running sum.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    power, inverse = _power_tables(len(data))
    inside = ~_SPACE[data]
    before = np.concatenate([[False], inside[:-1]])
    before[starts[starts < len(data)]] = False
    after = np.concatenate([inside[1:], [False]])
    after[starts[starts > 0] - 1] = False
    first, last = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[data] * power[:len(data)], dtype=np.uint64)])
    return mix((sums[last + 1] - sums[first]) * inverse[first]), np.searchsorted(first, starts)


def shingle_sets(texts: list[str | None], words: int = 2, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``words`` words (A-Z lower-cased).

    A text with fewer words has one shingle, all of them; one without words none.
    """
    encoded = [(t or "").encode() for t in texts]
    if lower:
        encoded = [t.lower() for t in encoded]
    hashes, bounds = word_hashes(encoded)
    chained = _chain(hashes, words)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= words:
            out.append(np.unique(chained[a:b - words + 1]))
        elif b > a:
            out.append(_chain(hashes[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _chain(hashes: np.ndarray, words: int) -> np.ndarray:
    n = len(hashes) - words + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, words, np.uint64)
    for k in range(words):
        out = mix(out * _BASE + hashes[k:k + n])
    return out
