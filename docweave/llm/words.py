"""Words and word shingles of an Arrow text column as 64-bit hashes, by whole-array steps.

A word is a maximal run of bytes that a 256-entry table marks as word bytes; A-Z
count as a-z. A word's hash is a sum of its bytes times fixed random numbers, mixed;
a shingle's hash is the same over its words. Equal hashes stand for equal shingles:
at 64 bits two given documents of a million shingles each meet a false equality with
a chance below one in ten million.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that the array steps take at once (a longer row or word alone may exceed it).
CHUNK_BYTES = 1 << 20

_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: What ``randoms`` has made; not a cache decorator, which would not travel to executors without the package.
_MADE: dict[tuple[int, int], np.ndarray] = {}


def randoms(n: int, seed: int = 0) -> np.ndarray:
    """Fixed odd 64-bit numbers, not to be changed."""
    made = _MADE.get((n, seed))
    if made is None:
        if len(_MADE) > 200:
            _MADE.clear()
        made = _MADE[n, seed] = mixed(np.arange(n, dtype=_U) + _U(seed << 32)) | _U(1)
    return made


def space_separated() -> np.ndarray:
    """Word bytes are all but space and 0x09 to 0x0D."""
    table = np.ones(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def letters_and_digits() -> np.ndarray:
    """Word bytes are ASCII letters and digits and all bytes beyond ASCII."""
    table = np.zeros(256, dtype=bool)
    table[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True
    table[128:] = True
    return table


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each row, null rows being empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8), offsets


@dataclass
class Words:
    """Word hashes of the rows ``first`` to ``last``; row r has those from ``bounds[r - first]``."""

    first: int
    last: int
    hashes: np.ndarray
    bounds: np.ndarray

    def rows(self) -> Iterator[tuple[int, np.ndarray]]:
        for r in range(self.first, self.last):
            yield r, self.hashes[self.bounds[r - self.first] : self.bounds[r - self.first + 1]]


def words(column: pa.Array, table: np.ndarray, chunk: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of each row, for some rows at a time."""
    data, offsets = text_buffer(column)
    lower = _lower()
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + chunk, side="right")) - 1
        last = min(max(last, first + 1), n)
        part = data[offsets[first] : offsets[last]]
        edges = offsets[first : last + 1] - offsets[first]
        inside = np.zeros(len(part) + 1, dtype=bool)
        inside[:-1] = table[part]
        starts = inside[:-1].copy()
        starts[1:] &= ~inside[:-2]
        cut = edges[1:-1][edges[1:-1] < len(part)]
        starts[cut] = inside[cut]
        begin = np.flatnonzero(starts)
        ends = inside[:-1] & ~inside[1:]
        before = cut[cut > 0] - 1
        ends[before] = inside[before]
        end = np.flatnonzero(ends) + 1
        hashes = np.empty(len(begin), dtype=_U)
        at = 0
        while at < len(begin):
            to = max(at + 1, int(np.searchsorted(end, begin[at] + CHUNK_BYTES, side="right")))
            span = slice(begin[at], end[to - 1])
            hashes[at:to] = _word_hashes(lower[part[span][inside[span]]], end[at:to] - begin[at:to])
            at = to
        yield Words(first, last, hashes, np.searchsorted(begin, edges))
        first = last


def _word_hashes(letters: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``letters``: the bytes of words of the given lengths, one after the other."""
    begin = np.cumsum(length) - length
    within = np.arange(len(letters), dtype=np.int32) - np.repeat(begin.astype(np.int32), length)
    factor = randoms(int(length.max()), seed=1)
    sums = np.add.reduceat(letters * factor[within], begin)
    return mixed(sums + length.astype(_U) * _U(0xD6E8FEB86659FD93))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of ``size`` words; of fewer words, the one of them all; of none, none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    factor = randoms(size, seed=2)
    total = np.zeros(n - width + 1, dtype=_U)
    for k in range(width):
        total += hashes[k : n - width + 1 + k] * factor[k]
    return mixed(total + _U(width))


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def all_shingles(part: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of ``size`` words of all rows of ``part``, and their bounds by row; shorter rows have none."""
    n = max(len(part.hashes) - size + 1, 0)
    factor = randoms(size, seed=2)
    total = np.zeros(n, dtype=_U)
    for k in range(size):
        total += part.hashes[k : k + n] * factor[k]
    ends = np.repeat(part.bounds[1:], np.diff(part.bounds))[:n]
    inside = np.arange(n) + size <= ends
    counts = np.maximum(np.diff(part.bounds) - size + 1, 0)
    return mixed(total[inside] + _U(size)), np.append(0, np.cumsum(counts))
