"""Words of UTF-8 texts in Arrow batches, as spans of one byte array."""

from __future__ import annotations

import numpy as np


def byte_class(*members: int | tuple[int, int]) -> np.ndarray:
    """Which of the 256 byte values are members: single values and inclusive ranges."""
    table = np.zeros(256, bool)
    for m in members:
        first, last = (m, m) if isinstance(m, int) else m
        table[first : last + 1] = True
    return table


def word_spans(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every maximal run of ``inside`` bytes; no run crosses
    from one row of ``offsets`` into the next."""
    flag = inside[raw]
    first, last = flag.copy(), flag.copy()
    first[1:] &= ~flag[:-1]
    last[:-1] &= ~flag[1:]
    filled = np.flatnonzero(np.diff(offsets) > 0)
    at = offsets[filled]
    first[at] = flag[at]
    at = offsets[filled + 1] - 1
    last[at] = flag[at]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(offsets, start, "right") - 1


def span_bytes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the spans, one after the other, and their n + 1 offsets."""
    size = end - start
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    place = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return raw[place], offsets
