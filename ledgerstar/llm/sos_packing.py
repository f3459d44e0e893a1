"""Sum-of-squares online packing of token sequences.

Documents arrive one after another in every partition.  A document longer than
the window fills whole windows; what is left goes to the fill level that makes
the sum of squares of the counts of partially filled windows least (level 0
opens a window).  The counts per level are one array.  When the stream ends, or
`max_open` windows are open, the open windows are closed by cutting: their
pieces are laid end to end into full windows; at the end the tail is written as
sequences whose lengths are powers of two, which take no padding.

Defined results: a null text is empty and gives its end id alone; repeated rows
are packed each; a document's pieces cover its ids once, in order of start; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .shared import table
from .textscan import give_back, slices

WINDOW = 2048
END_ID = 1
MAX_OPEN = 1024
CACHED_WORDS, CACHED_BYTES = 400_000, 24 << 20
MARKS = 4  # numbers of words that are always known
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of texts for a tokenizer whose ids never span white space.

    Texts are split at ASCII white space, each distinct word is encoded once and
    kept, and the ids of a slice of texts are gathered in numpy.  When there are
    CACHED_WORDS words or CACHED_BYTES of them, those met in one slice only are
    forgotten (all, if too many are left).  A word is looked up without its
    capitals, which the tokenizer drops, and without a full stop or comma after
    a letter that stays one in lower case, which is always an id of its own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_string())  # word i has number MARKS + i
        self.seen = np.zeros(0, np.int32)  # slices that held the word, lately
        # numbers 0 to 3: the end id, nothing, a full stop, a comma
        marks = [e.ids for e in self.tokenizer.encode_batch_fast([".", ","], add_special_tokens=False)]
        self._lengths, self._ids = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self._keep([[END_ID], [], *marks])

    def _keep(self, ids: list[list[int]]) -> None:
        self._lengths = np.concatenate([self._lengths, np.fromiter(map(len, ids), np.int64, len(ids))])
        self._ids = np.concatenate([self._ids, np.fromiter(chain.from_iterable(ids), np.int32)])
        self._starts = np.cumsum(self._lengths) - self._lengths

    def _full(self, share: float = 1.0) -> bool:
        return len(self.known) > share * CACHED_WORDS or self.known.nbytes > share * CACHED_BYTES

    def _thin_out(self) -> None:
        kept = np.flatnonzero(self.seen > 1)
        self.known, self.seen = self.known.take(pa.array(kept)), self.seen[kept] // 2
        if self._full(0.5):
            self.forget()
            return
        numbers = np.concatenate([np.arange(MARKS), kept + MARKS])
        lengths = self._lengths[numbers]
        ends = np.cumsum(lengths)
        self._ids = self._ids[np.repeat(self._starts[numbers] - (ends - lengths), lengths) + np.arange(int(ends[-1]))]
        self._lengths, self._starts = lengths, ends - lengths

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """Numbers of different words."""
        found = pc.index_in(words, value_set=self.known)
        new, at = found.is_null().to_numpy(zero_copy_only=False), np.array(found.fill_null(0), np.int64)
        if new.any():
            more = words.filter(pa.array(new))
            at[new] = len(self.known) + np.arange(len(more))
            self.known, self.seen = pa.concat_arrays([self.known, more]), np.concatenate([self.seen, np.zeros(len(more), np.int32)])
            more = more.to_pylist()
            for i in range(0, len(more), 10_000):
                self._keep([e.ids for e in self.tokenizer.encode_batch_fast(more[i: i + 10_000], add_special_tokens=False)])
        self.seen[at] += 1
        return at + MARKS

    def _word_numbers(self, words: pa.Array) -> np.ndarray:
        """Two numbers a word: of its bare form and of the mark after it."""
        # the one letter whose lower case ends in a mark, which the tokenizer joins with what follows, is left whole
        marked = pc.match_substring_regex(words, r"[^\PL\x{130}][.,]$")
        comma = pc.ends_with(words, ",")
        bare = pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words)
        bare = pc.if_else(pc.match_substring(bare, "<|"), bare, pc.ascii_lower(bare)).dictionary_encode()
        numbers = self._numbers(bare.dictionary)[bare.indices.to_numpy()]
        marks = np.where(marked.to_numpy(zero_copy_only=False), 2 + comma.to_numpy(zero_copy_only=False), 1)
        return np.stack([numbers, marks], axis=1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts, each ended by END_ID."""
        if self._full():
            self._thin_out()
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        at = split.offsets.to_numpy() - split.offsets[0].as_py()
        words = split.flatten().dictionary_encode()
        numbers = np.zeros(0, np.int64)
        if len(words):
            numbers = self._word_numbers(words.dictionary)[words.indices.to_numpy()].ravel()
        numbers = np.insert(numbers, 2 * at[1:], 0)
        lengths = self._lengths[numbers]
        ends = np.cumsum(lengths)
        ids = self._ids[np.repeat(self._starts[numbers] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]
        return ids, np.concatenate([[0], ends[2 * at[1:] + np.arange(len(at) - 1)]])


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per worker process: loading the vocabulary takes a while."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


class Packer:
    """Open windows by fill level; closed pieces wait in `done` as (document,
    start, ids, sequence, offset)."""

    def __init__(self, window: int, first_sequence: int, max_open: int):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window)]
        self.n_open = 0
        self.sequence = first_sequence
        self.done: list[tuple] = []

    def add(self, doc: tuple, ids: np.ndarray) -> None:
        start, n = 0, len(ids)
        while n - start >= self.window:
            self._close([(doc, start, ids[start: start + self.window])])
            start += self.window
        if start == n:
            return
        size = n - start
        level = self._best_level(size)
        held = self.open[level].pop() if level else []
        if level:
            self.levels[level] -= 1
            self.n_open -= 1
        held.append((doc, start, ids[start:].copy()))
        if level + size == self.window:
            self._close(held)
            return
        self.open[level + size].append(held)
        self.levels[level + size] += 1
        self.n_open += 1
        if self.n_open > self.max_open:
            self.cut_open()

    def _best_level(self, size: int) -> int:
        """The level whose window makes the sum of squares least; the fullest
        of equals."""
        top = self.window - size
        counts = self.levels[: top + 1]
        change = -2 * counts + 1  # a window leaves its level
        change[0] = 0  # a new one leaves none
        change[:top] += 2 * self.levels[size: self.window] + 1  # it enters level + size, unless full
        can = counts > 0
        can[0] = True
        at = np.flatnonzero(can)
        return int(at[len(at) - 1 - np.argmin(change[at][::-1])])

    def _close(self, held: list[tuple]) -> None:
        offset = 0
        for doc, start, ids in held:
            self.done.append((doc, start, ids, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def cut_open(self, last: bool = False) -> None:
        """Lay all open windows end to end, close the full ones; keep the rest
        open or, at the last, close it in powers of two."""
        pieces = [p for level in reversed(self.open) for held in level for p in held]
        total = sum(len(p[2]) for p in pieces)
        self.open = [[] for _ in range(self.window)]
        self.levels[:] = 0
        self.n_open = 0
        sizes = [self.window] * (total // self.window)
        rest = total % self.window
        if last:
            sizes += [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        elif rest:
            sizes.append(rest)
        pieces.reverse()
        for size in sizes:
            held, room = [], size
            while room:
                doc, start, ids = pieces.pop()
                if len(ids) > room:
                    pieces.append((doc, start + room, ids[room:]))
                    ids = ids[:room]
                held.append((doc, start, ids))
                room -= len(ids)
            if size == rest and not last:
                self.open[rest].append(held)
                self.levels[rest], self.n_open = 1, 1
            else:
                self._close(held)


def packed(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, max_open: int = MAX_OPEN,
           with_ids: bool = True) -> DataFrame:
    """One row per piece of docs (doc_id, text): where it starts in its
    document, its length, digest and ids, and its place in a sequence.

    Every partition packs its own stream (the scan's order; no shuffle) with at
    most max_open windows in memory; its sequences are numbered from its own
    range, so a repeated task gives the same rows."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(path)
        packer = Packer(window, TaskContext.get().partitionId() << 33, max_open)

        def rows() -> pa.RecordBatch:
            done, packer.done = packer.done, []
            docs_, starts, ids, sequences, offsets = zip(*done, strict=True) if done else ([],) * 5
            lengths = [len(x) for x in ids]
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            kept = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))) if with_ids else pa.nulls(len(done), pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([
                pa.array([d[0] for d in docs_], pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()), pa.array([d[1] for d in docs_], pa.int64()),
                pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64()), kept,
            ], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in batches:
            texts = batch["text"].fill_null("")
            names = batch["doc_id"].to_pylist()
            for a, b in slices(texts, 4 << 20):
                ids, at = words.encode(texts.slice(a, b - a))
                for i in range(a, b):
                    own = ids[at[i - a]: at[i - a + 1]]
                    packer.add((names[i], len(own)), own)
                yield rows()
        packer.cut_open(last=True)
        yield rows()
        give_back()

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(run, PIECES)


def op6_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents", "doc_id", "text"), with_ids=False).drop("ids")
