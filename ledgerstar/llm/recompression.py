"""Periodic runs of words, found with a grammar made by recompression.

The words of a slice of texts are numbered and laid end to end.  Recompression
replaces, in turns, every block of one repeated symbol by a new symbol and every
pair of a left and a right symbol (symbols take sides by a hash) by another, until
symbols are as long as the longest text.  Equal symbols of a level stand for equal
words and places that match are cut alike, so how far two places agree (forwards or
backwards) is read off by climbing while both stand at the edge of equal parents
and descending where symbols differ; a block is passed in one step.

A run of period q has a stretch of words equal to those q further on that is at
least q (and 12 - q) long, so it holds a multiple of max(q, 12 - q): only the
places of that harmonic grid, about n log n of them, are compared, and what agrees
there is extended exactly by two grammar queries.  A run found with several periods
keeps its smallest.  A text is worked on by one task, with some 300 bytes of
memory a word.

Defined results: a null or word-less text has no words, no runs and an empty
collapsed text; repeated rows have a row each; a null doc_id is kept; no documents
give no rows; runs never reach from one text into the next; runs are ordered by
start, then period; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import WORD, table
from .textscan import give_back, mixed, slices, string_bytes, words

MIN_LENGTH = 12  # words
CHUNK = 1 << 19  # grid places compared in one numpy step
COVERED_FROM = 64  # runs so long are remembered, so that multiples of their period are passed over
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Grammar:
    """Levels of symbols over numbered words, laid one behind the other, each
    between two sentinels that equal nothing.  A level's symbol knows its parent,
    whether it is that parent's first or last child, its own first and last
    child, its length in words, and how many symbols of its block follow and
    precede it (itself included)."""

    def __init__(self, text: np.ndarray, longest: int):
        symbols, length = text.astype(np.int64), np.ones(len(text), np.int64)
        self._levels: list[tuple] = []
        self._size = 0
        top, unit = int(symbols.max(initial=0)) + 1, np.ones(len(text), np.int32)
        first = np.arange(len(text), dtype=np.int64)  # of the children one level below
        last = first
        rounds = 0
        while len(symbols) > 1 and len(symbols) * longest > len(text) and rounds < 200:
            rounds += 1
            fresh = np.concatenate([[True], symbols[1:] != symbols[:-1]])
            if not fresh.all():
                begin = np.flatnonzero(fresh)
                count = np.diff(np.append(begin, len(symbols)))
                block = np.cumsum(fresh) - 1
                place = np.arange(len(symbols)) - begin[block]
                self._add(symbols, length, first, last, block, count[block] - place, place + 1)
                many = count > 1
                symbols, length = symbols[begin], length[begin] * count
                symbols[many], top = self._named(symbols[many], count[many], top)
                first, last = begin, begin + count - 1
            left = (mixed(symbols.astype(np.uint64) + np.uint64(rounds * 0x9E3779B9)) & np.uint64(1)).astype(bool)
            one, other = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
            pair = one if one.sum() >= other.sum() else other
            if not pair.any():
                continue
            heads = np.flatnonzero(np.concatenate([[True], ~pair]))
            two = np.append(pair, False)[heads]
            unit = np.ones(len(symbols), np.int32)
            self._add(symbols, length, first, last, np.cumsum(np.concatenate([[True], ~pair])) - 1, unit, unit)
            first, last = heads, heads + two
            made, top = self._named(symbols[heads[two]], symbols[heads[two] + 1], top)
            length = np.add.reduceat(length, heads)
            symbols = symbols[heads]
            symbols[two] = made
        unit = np.ones(len(symbols), np.int32)
        self._add(symbols, length, first, last, None, unit, unit)
        self._join()

    @staticmethod
    def _named(a: np.ndarray, b: np.ndarray, top: int) -> tuple[np.ndarray, int]:
        """One new symbol from `top` on for each distinct (a, b)."""
        distinct, number = np.unique(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64), return_inverse=True)
        return number + top, top + len(distinct)

    def _add(self, symbols, length, first, last, parent, ahead, behind) -> None:
        self._levels.append((symbols, length, first, last, parent, ahead, behind))

    def _join(self) -> None:
        """All levels in one row; numbers of a level's symbols become places."""
        size = sum(len(x[0]) + 2 for x in self._levels)
        self.symbol = np.full(size, -1, np.int32)
        self.length, self.ahead, self.behind = (np.ones(size, np.int32) for _ in range(3))
        self.parent, self.first_child, self.last_child = (np.zeros(size, np.int32) for _ in range(3))
        self.is_first, self.is_last = np.zeros(size, bool), np.zeros(size, bool)
        at, below = 0, 0
        for symbols, length, first, last, parent, ahead, behind in self._levels:
            own = slice(at + 1, at + 1 + len(symbols))
            end = at + len(symbols) + 1
            self.symbol[own], self.length[own], self.ahead[own], self.behind[own] = symbols, length, ahead, behind
            self.first_child[own], self.last_child[own] = first + below + 1, last + below + 1
            self.first_child[[at, end]] = self.last_child[[at, end]] = below, at - 1
            if parent is not None:
                self.parent[own] = parent + end + 2
                self.is_first[own] = np.concatenate([[True], parent[1:] != parent[:-1]])
                self.is_last[own] = np.concatenate([parent[1:] != parent[:-1], [True]])
            at, below = end + 1, at
        self.bottom = len(self._levels[0][0]) + 2
        self._levels = []

    def agreeing(self, x: np.ndarray, y: np.ndarray, cap: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from places x and y on (or, back, up to them) agree,
        at most cap."""
        edge, child, left, step = (self.is_last, self.last_child, self.behind, -1) if back else (self.is_first, self.first_child, self.ahead, 1)
        x, y = x + 1, y + 1  # behind the sentinel
        out = np.zeros(len(x), np.int64)
        open_ = np.flatnonzero(cap > 0)
        x, y, far, cap = x[open_], y[open_], np.zeros(len(open_), np.int64), cap[open_]
        while len(open_):
            a, b = self.parent[x], self.parent[y]
            up = edge[x] & edge[y] & (self.symbol[a] == self.symbol[b])
            symbol = self.symbol[x]
            same = ~up & (symbol == self.symbol[y]) & (symbol >= 0)
            count = np.where(same, np.minimum(left[x], left[y]), 0)
            far = far + count * self.length[x]
            over = (far >= cap) | (~up & ~same & (x < self.bottom))
            still = up | same
            x, y = (np.where(up, c, np.where(still, z + step * count, child[z])) for z, c in ((x, a), (y, b)))
            if over.any():
                out[open_[over]] = far[over]
                x, y, far, cap, open_ = (z[~over] for z in (x, y, far, cap, open_))
        return out


def found_runs(ids: np.ndarray, at: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (text, start, length, period) of all runs of at least min_length
    words and two periods in texts of numbered words, in that order."""
    n = np.diff(at)
    half = np.where(n >= min_length, n // 2, 0)
    text = np.repeat(np.arange(len(n)), half)
    period = np.arange(len(text)) - np.repeat(np.cumsum(half) - half, half) + 1
    order = np.argsort(period, kind="stable")  # small periods first
    text, period = text[order], period[order]
    grid = np.maximum(period, min_length - period)
    count = (n[text] - 1 - period) // grid + 1
    ends = np.cumsum(count)
    grammar, found = None, []
    cover_end, cover_period = np.zeros(len(ids), np.int64), np.ones(len(ids), np.int64)
    ahead = 3  # a stretch holds at least so many more words on one side when it has min_length / 2
    padded = np.concatenate([np.full(ahead, -1, ids.dtype), ids, np.full(ahead, -1, ids.dtype)])
    a = 0
    while a < len(text):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK, side="right")))
        own = count[a:b]
        k = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
        x = np.repeat(at[text[a:b]], own) + k * np.repeat(grid[a:b], own)
        p = np.repeat(period[a:b], own)
        alike = np.flatnonzero(ids[x] == ids[x + p])
        x, p = x[alike], p[alike]
        owner = np.repeat(text[a:b], own)[alike]
        a = b
        if min_length >= 4 * ahead:
            u, v = x + ahead, x + p + ahead
            after = np.logical_and.reduce([padded[u + d] == padded[v + d] for d in range(1, ahead + 1)])
            before = np.logical_and.reduce([padded[u - d] == padded[v - d] for d in range(1, ahead + 1)])
            likely = after | before
            x, p, owner = x[likely], p[likely], owner[likely]
        known = (x + p < cover_end[x]) & (p % cover_period[x] == 0)
        x, p, owner = x[~known], p[~known], owner[~known]
        if not len(x):
            continue
        if grammar is None:
            grammar = Grammar(ids, int(n.max()))
        right = at[owner + 1] - x - p
        forth = np.minimum(grammar.agreeing(x, x + p, right), right)
        room = x - at[owner]
        back = np.minimum(grammar.agreeing(x - 1, x + p - 1, room, back=True), room)
        length = forth + back + p
        good = length >= np.maximum(min_length, 2 * p)
        rows = np.unique(np.stack([owner[good], (x - back)[good], length[good], p[good]], axis=1), axis=0)
        found.append(rows)
        for _, start, m, q in rows[rows[:, 2] >= COVERED_FROM].tolist():
            if m > cover_end[start] - start:
                cover_end[start: start + m], cover_period[start: start + m] = start + m, q
    if not found:
        return np.zeros((0, 4), np.int64)
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1]))]
    smallest = np.ones(len(rows), bool)
    smallest[1:] = (rows[1:, 1] != rows[:-1, 1]) | (rows[1:, 2] != rows[:-1, 2])
    rows = rows[smallest]
    rows[:, 1] -= at[rows[:, 0]]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for every word, equal for equal words only."""
    length = ends - starts
    at = np.concatenate([[0], np.cumsum(length)])
    # the words' bytes without what is between them
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] = 1
    inside[ends] -= 1
    joined = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)] if len(data) else data
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(joined))])
    return column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> pa.Array:
    """Per text (words first[i] to first[i + 1]) its words with one space between."""
    length = ends - starts + 1
    cut = np.concatenate([[0], np.cumsum(length)])
    row = np.append(data, np.uint8(32))[np.repeat(starts - cut[:-1], length) + np.arange(cut[-1])]
    row[cut[1:] - 1] = 32
    # a text's last space goes
    offsets = cut[first] - np.concatenate([[0], np.cumsum(np.diff(first) > 0)])
    drop = np.ones(len(row), bool)
    drop[cut[first[1:]][np.diff(first) > 0] - 1] = False
    return pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(row[drop]))).cast(pa.string())


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, rewrite: Callable[[list, pa.Array], pa.Array] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of docs (doc_id, text):
    the runs of its words and its text without what runs repeat, words joined
    by one space.  `rewrite` may change a slice of texts first, in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["text"]):
                part = batch.slice(a, b - a)
                texts = part["text"] if rewrite is None else rewrite(part["doc_id"].to_pylist(), part["text"])
                data, offsets = string_bytes(texts)
                starts, ends, at = words(data, offsets)
                rows = found_runs(numbered(data, starts, ends), at, min_length)
                begin, stop = at[rows[:, 0]] + rows[:, 1] + rows[:, 3], at[rows[:, 0]] + rows[:, 1] + rows[:, 2]
                dropped = np.cumsum(np.bincount(begin, minlength=len(starts) + 1) - np.bincount(stop, minlength=len(starts) + 1))[: len(starts)] > 0
                kept = np.concatenate([[0], np.cumsum(~dropped)])[at]
                per_text = np.searchsorted(rows[:, 0], np.arange(len(at)))
                fields = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in (1, 2, 3)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"], pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(per_text.astype(np.int32)), fields),
                    joined_words(data, starts[~dropped], ends[~dropped], kept),
                ], names=["doc_id", "n_words", "runs", "collapsed"])
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RUNS)


_WORD = re.compile(WORD)


def planted(ids: list[int | None], texts: pa.Array) -> pa.Array:
    """The texts of the contract of op12: where the checksum of a doc_id ends in
    0, the words from one on are made periodic."""
    out = texts.to_pylist()
    for i, doc_id in enumerate(ids):
        h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h is None or h % 10 or not out[i]:
            continue
        own = _WORD.findall(out[i])
        n, g = len(own), h // 10
        if n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            out[i] = " ".join(own[:a] + (own[a: a + p] * -(-(n - a) // p))[: n - a])
    return pa.array(out, pa.string())


def op12_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents", "doc_id", "text"), rewrite=planted)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    found = found.withColumn("top", longest)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.back")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.less")).alias("period"), F.expr("1000 * top.length DIV -top.less").cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
