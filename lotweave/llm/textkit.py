"""Vectorised text helpers for Arrow batches inside tasks.

A batch is walked in slices of whole rows of about ``SLICE`` bytes, so memory in a
worker stays bounded whatever the batch holds; a longer row is a slice of its own.
Words are runs of bytes outside ``\\x20\\x09-\\x0D``. Word hashes are 64 bits of a
polynomial over the UTF-8 bytes, equal everywhere and in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
PIECE = 1 << 20

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32



def lower(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and the letters of Latin-1 (two bytes, the first 0xC3)."""
    out = LOWER[data]
    if len(data) > 1:
        tail = data[1:]
        out[1:] += ((data[:-1] == 0xC3) & (tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)).astype(np.uint8) * np.uint8(32)
    return out


_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
BYTES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the word (a bijection of 64 bits)."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_powers: dict[bool, np.ndarray] = {}


def power(n: int, down: bool = False) -> np.ndarray:
    """Powers 0 to ``n - 1`` of the base of the hash, or of its inverse."""
    have = _powers.get(down)
    if have is None or len(have) < n:
        step = np.full(max(n, PIECE + 1024), _BASE_INVERSE if down else _BASE, dtype=np.uint64)
        step[0] = 1
        have = _powers[down] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """``c`` such that ``(c[e] - c[s]) * up^-s`` identifies ``data[s:e]``."""
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(BYTES[data] * power(len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * power(len(sums), down=True)[starts])


@dataclass
class Slice:
    """Rows ``first .. first + rows`` of a batch: their bytes and where each begins."""

    first: int
    offsets: np.ndarray
    data: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[Slice]:
    """Slices of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return
    _, where, held = column.buffers()
    at = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield Slice(first, at[first : last + 1] - at[first], data[at[first] : at[last]])
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each row (one more entry than rows)."""
    solid = ~BLANK[data]
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[offsets[:-1]] = True
    begins = begins[:-1]
    starts = np.flatnonzero(solid & (begins | np.concatenate(([True], ~solid[:-1])))) if len(data) else np.zeros(0, np.int64)
    after = np.concatenate((begins[1:], [True])) if len(data) else begins
    ends = np.flatnonzero(solid & (after | np.concatenate((~solid[1:], [True])))) + 1 if len(data) else starts
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, computed piece by piece between words."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        origin = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, origin + PIECE, side="right")))
        sums = prefix_sums(data[origin : ends[upto - 1]])
        out[at:upto] = span_hashes(sums, starts[at:upto] - origin, ends[at:upto] - origin)
        at = upto
    return out


_ORDER = _U(0x8CB92BA72F3D8DD7)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive entries."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = (out + words[k : k + n]) * _ORDER
        out ^= out >> _U(29)
    return mix(out)


def row_windows(bounds: np.ndarray, size: int) -> np.ndarray:
    """Mask over the windows of a whole slice: those that stay inside one row."""
    n = int(bounds[-1]) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    inside = np.ones(n, dtype=bool)
    for cut in bounds[1:-1]:
        inside[max(0, cut - size + 1) : min(cut, n)] = False
    return inside


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets."""
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


#: ASCII bytes that are neither letters, digits nor blanks.
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def strip_edges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Move both ends of each span over punctuation, at most ``rounds`` bytes a side."""
    for _ in range(rounds):
        starts = starts + ((starts < ends) & PUNCTUATION[data[np.minimum(starts, len(data) - 1)]])
        ends = ends - ((starts < ends) & PUNCTUATION[data[ends - 1]])
    return starts, ends


class Slots:
    """A fixed-size bitmap of hashed keys: no key that was added is ever missed."""

    def __init__(self, bits: int):
        self.bits = bits
        self.words = np.zeros(1 << (bits - 3), dtype=np.uint8)

    def places(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def set_places(self, places: np.ndarray) -> None:
        np.bitwise_or.at(self.words, places >> 3, np.left_shift(1, places & 7).astype(np.uint8))

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = self.places(keys)
        return (self.words[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


class Places:
    """Place of each of some different 64-bit keys, by open addressing: no key is missed or taken for another."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.ascontiguousarray(keys).view(np.uint64)
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.table = np.full(1 << self.bits, -1, dtype=np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self._home(self.keys)
        while len(left):
            free = self.table[slot] < 0
            self.table[slot[free]] = left[free]
            on = self.table[slot] != left
            left, slot = left[on], (slot[on] + 1) & (len(self.table) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _BASE) >> _U(64 - self.bits)).astype(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Places of the wanted keys, -1 for one that is not among them."""
        wanted = np.ascontiguousarray(wanted).view(np.uint64)
        if not len(self.keys):
            return np.full(len(wanted), -1, dtype=np.int32)
        slot = self._home(wanted)
        out = self.table[slot]
        left = np.flatnonzero((out >= 0) & (self.keys[out] != wanted))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & (len(self.table) - 1)
            at = self.table[slot]
            out[left] = at
            on = (at >= 0) & (self.keys[at] != wanted[left])
            left, slot = left[on], slot[on]
        return out
