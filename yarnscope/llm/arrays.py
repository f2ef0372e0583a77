"""Numpy helpers over Arrow text batches: slices of whole texts, words, hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts of one batch are worked on in slices of about this many bytes, whole rows each.
SLICE_BYTES = 2 << 20

_MULT = np.uint64(0x9E3779B97F4A7C15)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """Yield ``(first, last, data, offsets)`` over consecutive rows of a string column.

    ``data`` holds the UTF-8 bytes of the rows ``first..last-1`` without gaps and
    ``offsets`` their bounds in it; a null is an empty text. A row is never cut.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if n == 0:
        return
    buffers = column.buffers()
    bounds = np.frombuffer(buffers[1], dtype=kind)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first]
        first = last


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values (multiply, shift, xor)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class RangeHash:
    """Polynomial hashes (mod 2**64) of byte ranges of one slice, from prefix sums."""

    _base = 0xB5AD4ECEDA1CE2A9
    _inverse = pow(_base, -1, 1 << 64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        step = np.full(n + 1, self._base, np.uint64)
        step[0] = 1
        power = np.cumprod(step)
        step = np.full(n + 1, self._inverse, np.uint64)
        step[0] = 1
        self.inverse = np.cumprod(step)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.prefix[end] - self.prefix[start]) * self.inverse[start] + (end - start).astype(np.uint64) * _MULT)


def words_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """Start, end and row of every maximal run of bytes with ``inside[byte]``; runs end with their row."""
    flag = inside[data]
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], before[1:] = False, flag[:-1]
        after[-1], after[:-1] = False, flag[1:]
        edge = offsets[:-1]
        before[edge[edge < len(data)]] = False
        edge = offsets[1:]
        after[edge[edge > 0] - 1] = False
    start = np.flatnonzero(flag & ~before)
    end = np.flatnonzero(flag & ~after) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def byte_table(excluded: bytes) -> np.ndarray:
    table = np.ones(256, bool)
    table[list(excluded)] = False
    return table


def ascii_lower(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]
