"""Spark's ``xxhash64(long, long)`` for whole numpy arrays (public XXH64 algorithm, seed 42)."""

from __future__ import annotations

import numpy as np

# The five primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _left(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def xxhash64_long(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    h = seed + P5 + np.uint64(8)
    h = h ^ (_left(x * P2, 31) * P1)
    h = _left(h, 27) * P1 + P4
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def xxhash64_pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    seed = xxhash64_long(a.view(np.uint64), np.full(len(a), 42, np.uint64))
    return xxhash64_long(b.astype(np.int64).view(np.uint64), seed)
