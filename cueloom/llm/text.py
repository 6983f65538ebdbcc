"""Vectorised word and n-gram hashing over Arrow string columns.

Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes. A word's hash is a
polynomial of random byte values modulo 2**64, read off one running sum over
the buffer, so the cost is a few numpy operations a byte and no Python call a
word. Buffers are taken in blocks that end between words: memory stays bounded
for texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: tuple[np.ndarray, np.ndarray] | None = None
U = np.uint64


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, BLOCK + 4096)
        both = []
        for x in (_BASE, _INVERSE):
            a = np.full(size, x, np.uint64)
            a[0] = 1
            both.append(np.cumprod(a))
        _powers = (both[0], both[1])
    return _powers


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ U(seed & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def unmix(h: np.ndarray) -> np.ndarray:
    """The inverse of :func:`mix` with seed 0."""
    for factor in (0xC4CEB9FE1A85EC53, 0xFF51AFD7ED558CCD):
        h = (h ^ (h >> U(33))) * U(pow(factor, -1, 1 << 64))
    return h ^ (h >> U(33))


def _block(data: np.ndarray, breaks: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of one block; a word also ends at each break."""
    n = len(data)
    space = _SPACE[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = space[:-1], space[1:]
    if breaks is not None and len(breaks):
        before[breaks] = True
        after[breaks - 1] = True
    inside = ~space
    starts, ends = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    power, inverse = _power(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * power[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64) * U(0x2545F4914F6CDD1D)), starts, ends


def _long(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, block by block."""
    out, at, n = [], 0, len(data)
    while at < n:
        to = min(at + BLOCK, n)
        while to < n:
            gap = np.flatnonzero(_SPACE[data[at:to]])
            if len(gap):
                to = at + int(gap[-1]) + 1
                break
            to = min(to + BLOCK, n)
        out.append(_block(data[at:to], None)[0])
        at = to
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def layout(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, at, data = texts.buffers()
    if len(texts) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8), offsets.astype(np.int64)


def streams(texts: pa.Array, lower: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, words of each row, word hashes) for runs of consecutive rows."""
    data, offsets = layout(texts)
    row, n = 0, len(texts)
    while row < n:
        to = int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1
        to = min(max(to, row + 1), n)
        a, b = int(offsets[row]), int(offsets[to])
        part = data[a:b]
        if lower:
            part = _LOWER[part]
        if b == a:
            counts, h = np.zeros(to - row, np.int64), np.zeros(0, np.uint64)
        elif to == row + 1:
            h = _long(part)
            counts = np.array([len(h)])
        else:
            edges = offsets[row : to + 1] - a
            inner = edges[1:-1]
            h, starts, _ = _block(part, inner[(inner > 0) & (inner < b - a)])
            counts = np.diff(np.searchsorted(starts, edges))
        yield row, counts, h
        row = to


def left_in_row(counts: np.ndarray) -> np.ndarray:
    """For each word, how many words its row has from there on."""
    ends = np.cumsum(counts)
    return np.repeat(ends, counts) - np.arange(int(ends[-1]) if len(ends) else 0)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; what runs over the end is to be masked by the caller."""
    m, out, done, power, size = U(0x9E6C63D0876A9A47), None, 0, h, 1
    factor = m  # m ** size
    while True:
        if k & size:
            if out is None:
                out, done = power, size
            else:  # power's words come first, then the ones gathered so far
                nxt = np.zeros_like(out)
                nxt[: max(len(h) - size, 0)] = out[size:]
                f = U(pow(int(m), done, 1 << 64))
                out, done = power * f + nxt, done + size
        size *= 2
        if size > k:
            break
        half = size // 2
        nxt = np.zeros_like(power)
        nxt[: max(len(h) - half, 0)] = power[half:]
        power = power * factor + nxt
        factor = U(pow(int(m), size, 1 << 64))
    return mix(out + U(k))


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
