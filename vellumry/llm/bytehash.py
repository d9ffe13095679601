"""Vectorised hashing of byte ranges over Arrow string columns.

All texts of a chunk lie in one buffer; every function here works on the whole
buffer at once, so the cost per document is a few numpy calls shared by many.
Hashes are fixed functions of the bytes: alike on every executor and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15 | 1)
BASE_INV = U64(pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64))
#: Small, as the arrays made of a chunk take up to 100 bytes for each of its own, in every worker.
CHUNK_BYTES = 1 << 17


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, in place on a copy."""
    x = x + U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: A random-looking 64-bit value for each byte.
BYTE_VALUE = mix64(np.arange(1, 257, dtype=U64) * U64(0xD1B54A32D192ED03))

_pow = np.ones(1, U64)
_inv = np.ones(1, U64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        size = max(n, 2 * len(_pow), 1 << 16)
        with np.errstate(over="ignore"):
            p = np.full(size, BASE, U64)
            p[0] = 1
            q = np.full(size, BASE_INV, U64)
            q[0] = 1
            _pow, _inv = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _pow[:n], _inv[:n]


class RangeHash:
    """64-bit hashes of any byte ranges of one buffer, after one pass over it."""

    def __init__(self, values: np.ndarray):
        p, self._inverse = _powers(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * p[:-1], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._sums[end] - self._sums[start]) * self._inverse[start]
        return mix64(h ^ ((end - start).astype(U64) * U64(0xA24BAED4963EE407)))


def string_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n + 1 offsets) of an Arrow string column; nulls have no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, kind, n + 1, col.offset * kind().itemsize).astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about limit bytes; a longer text is a run of its own."""
    buf, off = string_buffer(col)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, buf[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j
