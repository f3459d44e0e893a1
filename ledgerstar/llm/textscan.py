"""Numpy helpers over the bytes of Arrow text columns, used inside tasks."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = (1 << 20) - 1  # with one more, the tables of powers stay at 2**20 numbers

# Word separators: space and the bytes 9 to 13.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

# A-Z lower-cased, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32


def give_back() -> None:
    """Return freed memory to the system: a Python worker serves many tasks,
    and what one of them needed at its peak would stay with it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes of text (one longer text alone) and
    at most `rows` rows."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, side="right"))
        stop = min(max(stop, start + 1), start + rows)
        yield start, stop
        start = stop


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, number of the first word of each text and, last, of
    words in all) of the words of texts laid end to end."""
    inside = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BASE = 0x9E3779B97F4A7C15 | 5
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    global _powers, _inverses
    if len(_powers) < n:
        n = 1 << int(n - 1).bit_length()
        with np.errstate(over="ignore"):
            _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, _BASE, np.uint64))])
            _inverses = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, pow(_BASE, -1, 1 << 64), np.uint64))])
    return _powers[:n], _inverses[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, from one running sum over all bytes: a
    word's polynomial is the difference of two sums, moved back to its start."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers, inverses = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


# Odd multipliers of the words of a shingle by their place.
PLACES = np.array([0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def shingles(hashes: np.ndarray, first: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of every text's shingles of n words, sorted and
    distinct; a text of fewer words has one of all its words, an empty none."""
    count = np.diff(first)
    made = np.where(count >= n, count - n + 1, (count > 0).astype(count.dtype))
    at = np.concatenate([[0], np.cumsum(made)])
    text = np.repeat(np.arange(len(count)), made)
    start = np.arange(at[-1]) - at[text] + first[text]
    length = np.minimum(count, n)[text]
    value = length.astype(np.uint64)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    for i in range(n):
        value = value + np.where(i < length, padded[start + i] * PLACES[i % len(PLACES)] * np.uint64(2 * (i // len(PLACES)) + 1), np.uint64(0))
    value = mixed(value)
    for a, b in zip(at[:-1], at[1:], strict=True):
        value[a:b].sort()
    keep = np.ones(len(value), bool)
    keep[1:] = value[1:] != value[:-1]
    keep[at[:-1][made > 0]] = True
    return value[keep], np.concatenate([[0], np.cumsum(keep)])[at]


def shingle_sets(texts: pa.Array, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = string_bytes(texts)
    starts, ends, first = words(data, offsets)
    return shingles(word_hashes(data, starts, ends), first, n)
