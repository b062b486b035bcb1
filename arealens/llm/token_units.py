"""Whole texts to token ids, each distinct stretch between safe blanks encoded once.

A blank between two characters that are no white space is a safe place to cut for a tokenizer without tokens
that hold a blank after such a character: encoding the parts gives the tokens of the whole. The stretches of
a batch are told apart by Arrow's dictionary encoding, so Python touches only the distinct ones.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from arealens.llm.words import mix

#: Bytes of distinct stretches that a worker remembers at most.
REMEMBERED_BYTES = 32 << 20
#: Longer stretches are encoded in each batch that holds them.
LONGEST = 4096
_BYTE_CODE, _PLACE_CODE = (np.random.default_rng(k).integers(1, 1 << 63, n, dtype=np.int64).astype(np.uint64) * 2 + 1 for k, n in ((7, 256), (8, LONGEST)))

_BEFORE = np.zeros(256, bool)
_BEFORE[0x21:0x7F] = True
_BEFORE[0x80:] = True
_BEFORE[[*range(0x80, 0x8B), 0x85, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = False  # last bytes of white space beyond ASCII
_AFTER = np.zeros(256, bool)
_AFTER[0x21:0x7F] = True
_AFTER[0x80:] = True
_AFTER[[0xC2, 0xE1, 0xE2, 0xE3]] = False  # first bytes of white space beyond ASCII


def safe_places(data: np.ndarray) -> np.ndarray:
    """Positions of blanks where a text may be cut."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    return np.flatnonzero((data[1:-1] == 0x20) & _BEFORE[data[:-2]] & _AFTER[data[2:]]) + 1


def may_follow(stretch: bytes) -> bool:
    """Whether a stretch, which begins with a blank, leaves a safe place before and behind it among others of its kind."""
    return len(stretch) > 1 and bool(_AFTER[stretch[1]] and _BEFORE[stretch[-1]])


def crosses_blank(token: bytes) -> bool:
    """Whether a token holds a blank after a character that is no white space."""
    return any(token[p] == 0x20 and _BEFORE[token[p - 1]] for p in range(1, len(token)))


def ragged(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions first, first + 1, ... of each run, one run after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(first - (ends - counts), counts) + np.arange(total)


def stretch_hashes(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each stretch of ``data``, which lie side by side and hold 1 to ``LONGEST`` bytes."""
    if not len(sizes):
        return np.zeros(0, np.uint64)
    terms = _BYTE_CODE[data] * _PLACE_CODE[ragged(np.zeros_like(sizes), sizes)]
    return mix(np.add.reduceat(terms, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))


class _Rows:
    """An array that grows at its end, by doubling: room not yet written to takes no memory."""

    def __init__(self, like: np.ndarray):
        self.held, self.size = np.empty((1 << 16, *like.shape[1:]), like.dtype), 0

    def append(self, rows: np.ndarray) -> None:
        size = self.size + len(rows)
        if size > len(self.held):
            held = np.empty((max(size, 2 * len(self.held)), *self.held.shape[1:]), self.held.dtype)
            held[: self.size] = self.held[: self.size]
            self.held = held
        self.held[self.size : size] = rows
        self.size = size


class Pool:
    """Rows for each token of each remembered stretch.

    ``encode`` gives, for a list of stretches, how many tokens each has and the rows of all, one after the other. After
    ``entries`` stretches all are forgotten. They are held as arrays, about 60 bytes each where a dict took 200 and more:
    found by a hash, then compared byte by byte. Of two stretches with one hash only the first is found again.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], entries: int):
        self.encode, self.entries = encode, entries
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted by hash
        self._data, self._begins, self._sizes = _Rows(np.zeros(0, np.uint8)), _Rows(np.zeros(0, np.int64)), _Rows(np.zeros(0, np.int32))
        self._first, self._counts = _Rows(np.zeros(0, np.int64)), _Rows(np.zeros(0, np.int64))
        self._tokens: _Rows | None = None

    @property
    def first(self) -> np.ndarray:
        return self._first.held[: self._first.size]

    @property
    def counts(self) -> np.ndarray:
        return self._counts.held[: self._counts.size]

    @property
    def tokens(self) -> np.ndarray | None:
        return None if self._tokens is None else self._tokens.held[: self._tokens.size]

    def _find(self, hashes: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The numbers of stretches that lie side by side in ``data``, -1 where one is not remembered."""
        found = np.full(len(sizes), -1)
        if not len(self.hashes):
            return found
        order = np.argsort(hashes)  # searched in order: neighbours lie in the same cache lines
        at = np.empty(len(hashes), np.int64)
        at[order] = np.searchsorted(self.hashes, hashes[order])
        at = np.minimum(at, len(self.hashes) - 1)
        numbers = self.numbers[at]
        same = (self.hashes[at] == hashes) & (self._sizes.held[numbers] == sizes)
        alike = np.flatnonzero(same)
        length = sizes[alike]
        differ = self._data.held[ragged(self._begins.held[numbers[alike]], length)] != data[ragged((np.cumsum(sizes) - sizes)[alike], length)]
        same[np.repeat(alike, length)[differ]] = False
        found[same] = numbers[same]
        return found

    def look_up(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each stretch data[bounds[i] : bounds[i + 1]] its number in ``first`` and ``counts``."""
        if self._first.size > self.entries or self._data.size > REMEMBERED_BYTES:
            self._clear()
        buffers = [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        found = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).dictionary_encode()
        distinct = found.dictionary
        _, ends, held = distinct.buffers()
        ends = np.frombuffer(ends, np.int64)[distinct.offset :][: len(distinct) + 1]
        held = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
        sizes = np.diff(ends)
        short = np.flatnonzero((sizes > 0) & (sizes <= LONGEST))
        own = held[ragged(ends[short], sizes[short])]
        hashes = stretch_hashes(own, sizes[short])
        numbers = np.full(len(sizes), -1)
        numbers[short] = self._find(hashes, own, sizes[short])
        new = np.flatnonzero(numbers < 0)
        if len(new):
            counts, rows = self.encode(distinct.take(pa.array(new)).to_pylist())
            if self._tokens is None:
                self._tokens = _Rows(rows)
            numbers[new] = self._first.size + np.arange(len(new))
            self._first.append(self._tokens.size + np.cumsum(counts) - counts)
            self._counts.append(counts)
            self._tokens.append(rows)
            self._begins.append(self._data.size + np.cumsum(sizes[new]) - sizes[new])
            self._sizes.append(np.minimum(sizes[new], LONGEST + 1))
            self._data.append(held[ragged(ends[new], sizes[new])])
            fresh = np.flatnonzero(numbers[short] >= numbers[new[0]])
            fresh = fresh[np.argsort(hashes[fresh], kind="stable")]
            at = np.searchsorted(self.hashes, hashes[fresh], "right")
            self.hashes = np.insert(self.hashes, at, hashes[fresh])
            self.numbers = np.insert(self.numbers, at, numbers[short[fresh]])
        return numbers[found.indices.to_numpy(zero_copy_only=False)]
