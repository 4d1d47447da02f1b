"""Arrow columns of text as flat byte arrays, so that work over whole batches can be vectorised."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# ASCII upper case to lower case, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column and the n + 1 offsets of its rows; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_large_binary(column.type) else "")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_bytes(data: np.ndarray, offsets: np.ndarray, row: int) -> bytes:
    return data[offsets[row] : offsets[row + 1]].tobytes()


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task over batches that at its end returns freed memory to the system, as workers live on beside later stages."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass  # another C library

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3's), so that sums of products spread over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
