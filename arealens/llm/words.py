"""Words of whole texts as numpy arrays: one pass over the bytes of an Arrow batch, no loop per word."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; the work arrays take about 80 times as much memory.
CHUNK_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODE = np.random.default_rng(20_011).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 & ~7 | 3
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


class Words(NamedTuple):
    """Words of some rows: hash, byte range, and for each row its first word (one more entry than rows)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    offsets: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_table(base: int, size: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < size:
        table = np.full(max(size, CHUNK_BYTES + 1), base, np.uint64)
        table[0] = 1
        table = np.cumprod(table, dtype=np.uint64)
        if len(table) <= 4 * CHUNK_BYTES:
            _powers[base] = table
    return table


def give_back() -> None:
    """Return freed memory to the system: a worker that waits for its next task keeps its heap otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def chunks(text: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about ``limit`` bytes; null is the empty text.

    Behind the last run, freed memory is given back.
    """
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    if not (pa.types.is_string(text.type) or pa.types.is_large_string(text.type)):
        text = text.cast(pa.string())
    if text.null_count:
        text = pc.fill_null(text, "")
    buffers = text.buffers()  # read in place: a batch of long texts is not copied
    width = np.int64 if pa.types.is_large_string(text.type) else np.int32
    offsets = np.frombuffer(buffers[1], width)[text.offset : text.offset + len(text) + 1].astype(np.int64) if len(text) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(text):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
    give_back()


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Words are runs of bytes other than blanks and 0x09-0x0D; A-Z may be lower-cased first."""
    n = len(data)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[begins[:-1]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[begins[1:]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * _power_table(_BASE, n + 1)[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power_table(_BASE_INVERSE, n + 1)[starts]
    hashes = mix(hashes ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets), offsets)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` neighbouring words; the last ``size - 1`` words begin none."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[k : len(hashes) - size + 1 + k]
    return mix(total)


def shingle_set(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct shingles of one text; fewer words than ``size`` make one shingle, no word none."""
    if not len(hashes):
        return hashes
    if len(hashes) < size:
        return mix(window_hashes(hashes, len(hashes)) + np.uint64(len(hashes)))
    return np.unique(window_hashes(hashes, size))
