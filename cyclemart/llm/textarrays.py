"""Texts of an Arrow batch as numpy arrays of word hashes, without a Python object per word.

Words are the maximal runs of bytes other than ASCII white space (0x20, 0x09-0x0D), with
A-Z lower-cased.  Hashes are 64-bit and the same in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: Odd multipliers of the hashes (64-bit golden ratio and splitmix64's two constants).
_BASE, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))

#: Bytes of text that are turned into arrays at a time; a longer text is taken alone.
CHUNK_BYTES = 2 << 20
#: Rows of a chunk at most: users pack the row number into 16 bits beside a 48-bit hash.
CHUNK_ROWS = 1 << 15


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = x + _BASE
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(256, dtype=np.uint64)) | np.uint64(1)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of an ordered pair of hashes."""
    return mix(a * _MIX1 + (b ^ _BASE))


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, row offsets) of consecutive rows; NULL counts as empty."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    if column.null_count:  # a NULL may have any length in the offsets
        lengths = np.where(column.is_valid().to_numpy(False), np.diff(offsets), 0)
        if (np.diff(offsets) != lengths).any():
            column = column.fill_null(b"")
            offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first, n = 0, len(column)
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        end = min(max(end, first + 1), n, first + CHUNK_ROWS)
        base = offsets[first]
        yield first, end - first, data[base:offsets[end]], offsets[first:end + 1] - base
        first = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, number of words of each row)."""
    rows = len(offsets) - 1
    if not data.size:
        return np.empty(0, np.uint64), np.zeros(rows, np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]  # a row's first byte begins a word, too
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    if not starts.size:
        return np.empty(0, np.uint64), np.zeros(rows, np.int64)
    number = np.cumsum(first) - 1  # of the word that each byte follows or is in
    place = np.arange(len(data)) - starts[np.maximum(number, 0)]
    np.maximum(place, 0, out=place)
    longest = int(place.max()) + 1
    powers = np.cumprod(np.full(longest, _BASE, np.uint64))
    values = _BYTE_VALUES[_LOWER[data]] * powers[place]
    values[~inside] = 0
    hashes = mix(np.add.reduceat(values, starts))
    counts = np.searchsorted(starts, offsets[1:], "left") - np.searchsorted(starts, offsets[:-1], "left")
    return hashes, counts


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of ``width`` words within a row, number of runs of each row)."""
    runs = np.maximum(counts - (width - 1), 0)
    n = len(hashes) - (width - 1)
    if n <= 0 or not runs.sum():
        return np.empty(0, np.uint64), np.zeros(len(counts), np.int64)
    all_runs = hashes[:n]
    for k in range(1, width):
        all_runs = combine(all_runs, hashes[k:n + k])
    ends = np.cumsum(counts)
    keep = np.arange(n) < np.repeat(ends - (width - 1), counts)[:n]
    return all_runs[keep], runs
