"""Words and shingles of whole texts as 64-bit numbers, without a Python step per word."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20_240_607)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_MIX = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of them."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(14, int(n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scattered over the whole range (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_numbers(text: bytes) -> np.ndarray:
    """One number per word, A-Z in lower case, words parted by ASCII white space."""
    b = np.frombuffer(text.lower(), np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    up, down = _power(len(b) + 1)
    word = np.concatenate([[False], ~_BLANK[b], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * up[: len(b)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct shingles of ``width`` words; a shorter text is one shingle, one without words none."""
    w = word_numbers(text or b"")
    if not len(w):
        return w
    n = min(width, len(w))
    out = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        out = mixed(out * _MIX[i] + w[i : len(w) - n + 1 + i])
    return np.unique(out)
