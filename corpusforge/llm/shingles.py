"""Vectorised word hashes and word shingles of one text (NumPy, no loop over words)."""

from __future__ import annotations

import numpy as np

_GEN = np.random.Generator(np.random.PCG64(20240229))
_TABLE = _GEN.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TABLE[65:91] = _TABLE[97:123]                        # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2 ** 64)
_K = _GEN.integers(1, 2 ** 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones((2, 1), np.uint64)


def _grow(n: int) -> np.ndarray:
    """Powers of the base and of its inverse modulo 2**64 up to n."""
    global _powers
    if _powers.shape[1] <= n:
        size = 1 << int(n).bit_length()
        steps = np.full((2, size), [[_BASE], [_INVERSE]], np.uint64)
        steps[:, 0] = 1
        _powers = np.cumprod(steps, axis=1, dtype=np.uint64)
    return _powers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K[6]
    x = (x ^ (x >> np.uint64(29))) * _K[7]
    return x ^ (x >> np.uint64(32))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the runs of non-white-space (ASCII white space), A-Z lower-cased."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    inside = np.concatenate([[False], ~_SPACE[raw], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    power = _grow(len(raw))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[raw] * power[0, :len(raw)], dtype=np.uint64)])
    return _mix((total[end] - total[start]) * power[1][start] + (end - start).astype(np.uint64))


def word_shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of all words as one where they are fewer."""
    h = word_hashes(text)
    if not len(h):
        return h
    k = min(k, len(h))
    out = np.full(len(h) - k + 1, np.uint64(k))
    for i in range(k):
        out = _mix(out + h[i:len(h) - k + 1 + i] * _K[i % 6] + np.uint64(i))
    return np.unique(out)
