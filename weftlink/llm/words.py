"""Words of many texts at once, read from their bytes.

A word is known by a key of 128 bits: its own bytes and their number if it has up to EXACT, else 120 bits of hash."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from xxhash import xxh3_128_intdigest

#: Most bytes of a word whose key holds them.
EXACT = 15
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """64 bits of hash of the keys."""
    with np.errstate(over="ignore"):
        m = (lo.view(np.uint64) ^ (hi.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        m ^= m >> np.uint64(31)
        m *= np.uint64(0x94D049BB133111EB)
    return m ^ (m >> np.uint64(29))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts, A-Z in lower case: halves lo and hi of their keys, a number of the last two bytes, and how many
    words each text has."""
    column = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    n = int(offsets[-1] - offsets[0])
    buf = np.full(n + 16, 32, np.uint8)
    if n:
        _FOLD.take(np.frombuffer(data, np.uint8, n, int(offsets[0])), out=buf[:n])
    edges = offsets - offsets[0]
    ok = ~_BLANK[buf[: n + 1]]
    begin, end = ok[:n].copy(), ok[:n] & ~ok[1:]
    begin[1:] &= ~ok[: max(n - 1, 0)]
    inside = edges[(edges > 0) & (edges < n)]  # words end where a text does
    begin[inside], end[inside - 1] = ok[inside], ok[inside - 1]
    starts, stops = np.flatnonzero(begin), np.flatnonzero(end) + 1
    size = stops - starts
    eight = np.ndarray((n + 9,), "<u8", buf.data, strides=(1,))  # the 8 bytes from each place on
    lo = eight[starts] & _MASK[np.minimum(size, 8)]
    hi = (eight[starts + 8] & _MASK[np.clip(size - 8, 0, 7)]) | (size.astype(np.uint64) << np.uint64(56))
    for i in np.flatnonzero(size > EXACT).tolist():
        h = xxh3_128_intdigest(buf[starts[i] : stops[i]])
        lo[i], hi[i] = h & ((1 << 64) - 1), h >> 64 | 0xFF << 56
    ending = buf[stops - 1].astype(np.int64) + np.where(size > 1, buf[stops - 2], 0).astype(np.int64) * 263
    return lo.view(np.int64), hi.view(np.int64), ending, np.diff(np.searchsorted(starts, edges))
