"""Texts as flat byte arrays: the numpy helpers that the text operators share inside tasks.

All of them see UTF-8 bytes of one slice of an Arrow column, so one numpy call covers
thousands of documents, and they work on slices of a bounded number of bytes, so memory does
not grow with a batch. A single longer text forms a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: numpy needs some 40 bytes for each byte of a slice, and a worker keeps most of that until its executor ends.
SLICE_BYTES = 1 << 18

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, bounds)`` for runs of rows; null counts as empty.

    ``bounds`` has one more entry than rows and starts at 0.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    bounds = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high, flat[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        low = high


def word_bounds(separator: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of the runs of bytes that are no separators."""
    n = len(separator)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    inside = ~separator
    starts = inside.copy()
    starts[1:] &= separator[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= separator[1:] | cut[1:n]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(bounds, first, "right") - 1


def mix(values: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    values = (values ^ (values >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> _U64(27))) * _U64(0x94D049BB133111EB)
    return values ^ (values >> _U64(31))


def byte_values(lower: bool) -> np.ndarray:
    """A 64-bit value for each byte; A-Z get those of a-z if ``lower``."""
    codes = np.arange(256, dtype=_U64)
    if lower:
        codes[65:91] += _U64(32)
    return mix(codes + _U64(0x51_7C_C1_B7_27_22_0A_95))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``: a polynomial over random byte values, mixed."""
    n = len(data)
    if not n or not len(starts):
        return np.zeros(len(starts), _U64)
    powers = np.full(n, _BASE & (1 << 64) - 1, _U64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    total = np.zeros(n + 1, _U64)
    np.cumsum(values[data] * powers, out=total[1:])
    back = np.full(n, _INVERSE, _U64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(_U64))
