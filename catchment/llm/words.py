"""Words of flat byte arrays: where they are, and a 64-bit hash of each."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from catchment.llm.buffers import mix

#: A number for each byte value, the same everywhere.
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

_BASE = 0x9E3779B97F4A7C15
_PIECE = 1 << 20


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    power = np.full(n, _BASE, np.uint64)
    back = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    power[0] = back[0] = 1
    return np.cumprod(power), np.cumprod(back)


def bounds(inside: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows; inside: which bytes belong to words; cuts: places where one ends at the latest."""
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    starts[firsts] = inside[firsts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[firsts[1:] - 1] = inside[firsts[1:] - 1]
    if cuts is not None and len(cuts):
        starts[cuts] = inside[cuts]
        before = cuts[cuts > 0] - 1
        ends[before] = inside[before]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word, from running sums over pieces of bounded size."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + _PIECE, side="right")))
        piece = data[base : ends[last - 1]]
        power, back = _powers(_PIECE) if len(piece) <= _PIECE else _powers.__wrapped__(len(piece))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(np.take(BYTES, piece) * power[: len(piece)], out=sums[1:])
        at = starts[first:last] - base
        out[first:last] = (sums[ends[first:last] - base] - sums[at]) * back[at]
        first = last
    return mix(out)
