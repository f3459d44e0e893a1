"""Cross-tokenizer alignment by byte spans.

A text with a space before it is encoded by a byte-level BPE tokenizer (A) and by
a sentencepiece model (B).  Neither has a token across a place where a character
that is no white space is followed by a space, so texts are cut there into chunks,
and the distinct chunks of a slice of texts are encoded once (a worker remembers
many of them for its next slices).  The tokenizers'
character offsets and sentencepiece's proto spans give coarse cuts; between two
cuts that hold several tokens (parts of a multibyte character, byte fallback) the
lengths of the tokens' decoded bytes refine them, and the decoded bytes must be the
chunk's.  Where A and B end together a group ends; every stretch between two
neighbouring ends, of either, is one link of an A token with a B token.

How many documents hold an id pair linked needs all documents.  A first pass
stores, per slice, its documents (packed) and its distinct pairs with the number
of its documents that hold them; the pairs are summed by Spark, joined back to the
slices' pairs, and meet each slice's documents again, ordered, one slice at a time.

Defined results: a text that is null, empty or that the tokens' bytes do not spell
(one with U+2581, which sentencepiece reads as a space) has no tokens: zeros and
an empty digest; special tokens' strings are plain text; a row that repeats is a
document each time; a null doc_id is kept; no documents give no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import partitions, stored, table
from .textscan import give_back, slices, string_bytes

SLICE = 8 << 20  # bytes of text whose distinct chunks are encoded together
ENCODED = 1 << 14  # bytes given to a tokenizer at once
REMEMBERED, REMEMBERED_BYTES = 600_000, 96 << 20
SPELLED = "▁"
PARTS = "kind int, slice long, payload binary, a int, b int, n int"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 characters for themselves, the others moved above 255."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    moved = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(moved)}


class Vocabulary:
    """The bytes of every id, laid end to end, and ids as text."""

    def __init__(self, entries: list[bytes]):
        self.bytes = np.frombuffer(b"".join(entries), np.uint8)
        self.length = np.array([len(x) for x in entries], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.names = pa.array([str(i) for i in range(len(entries))])

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        n = self.length[ids]
        return self.bytes[np.repeat(self.start[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


class ByteTokenizer:
    """A: ids and byte spans of texts from character offsets."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        alphabet, special = byte_alphabet(), {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        vocabulary = sorted((i, w) for w, i in self.tokenizer.get_vocab().items())
        entries = {i: w.encode() if w in special else bytes(alphabet[c] for c in w) for i, w in vocabulary}
        self.vocabulary = Vocabulary([entries.get(i, b"") for i in range(vocabulary[-1][0] + 1)])

    def encode(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = self.tokenizer.encode(text.decode(), add_special_tokens=False)
        spans = np.array(found.offsets, np.int64).reshape(-1, 2)
        raw = np.frombuffer(text, np.uint8)
        if len(raw) and raw.max() > 127:  # characters to bytes
            spans = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))[spans]
        return np.array(found.ids, np.int64), spans[:, 0], spans[:, 1]


class PieceTokenizer:
    """B: ids and byte spans of texts that begin with a space, from proto spans.
    A letter goes before the text, so that the model's own space goes before that."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        crossing = [p for p in pieces if SPELLED in p.lstrip(SPELLED)]
        if crossing:
            raise ValueError(f"pieces go on after a space: {crossing[:3]}")
        self.vocabulary = Vocabulary([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPELLED, " ").encode() for i, p in enumerate(pieces)])

    def encode(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = self.model.encode("x" + text.decode(), return_type="proto").pieces
        rows = np.array([(p.id, p.begin, p.end) for p in found], np.int64).reshape(-1, 3)[1:]
        return rows[:, 0], rows[:, 1] - 1, rows[:, 2] - 1


def refined_ends(begin: np.ndarray, end: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte ends of tokens, whether their spans and decoded lengths agree).

    Spans cut the text where one ends and the next begins, further on than the
    last cut; between two cuts tokens end where their decoded bytes do."""
    if not len(begin):
        return end, np.zeros(0, bool)
    reach = np.maximum.accumulate(end)
    after = np.append(begin[1:], reach[-1])
    last = np.flatnonzero(after >= reach)
    last = last[np.diff(reach[last], prepend=begin[0]) > 0]
    if not len(last) or last[-1] < len(begin) - 1:
        last = np.append(last, len(begin) - 1)
    group = np.searchsorted(last, np.arange(len(begin)))
    start = np.concatenate([[begin[0]], reach[last[:-1]]])
    total = np.cumsum(length)
    base = np.concatenate([[0], total[last[:-1]]])
    agree = (total[last] - base) == reach[last] - start
    return start[group] + total - base[group], agree[group]


def solid_before(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place certainly is no white space."""
    padded = np.concatenate([np.zeros(3, np.uint8), row])
    c, b, a = padded[at + 2], padded[at + 1], padded[at]
    # no break behind: U+0080..U+00BF, U+1680, U+180E, U+2000..U+207F, U+2581, U+3000, U+FEFF
    doubtful = (b == 0xC2) | ((a == 0xE2) & ((b == 0x80) | (b == 0x81))) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE1) & (b == 0xA0) & (c == 0x8E)) \
        | ((a == 0xE2) & (b == 0x96) & (c == 0x81)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | ((a == 0xEF) & (b == 0xBB) & (c == 0xBF))
    return ((c > 32) & (c < 127)) | ((c > 127) & ~doubtful)


def chunk_starts(row: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Where chunks start in texts that start at heads: there, and at spaces
    behind what is no white space."""
    at = np.flatnonzero(row == 32)
    return distinct(np.concatenate([at[solid_before(row, at)], heads]))


def distinct(values: np.ndarray, counted: bool = False):
    """The values in order, each once; counted, with how often it was there."""
    values = np.sort(values)
    at = np.flatnonzero(np.diff(values, prepend=values[:1] - 1))
    return (values[at], np.diff(np.append(at, len(values)))) if counted else values[at]


class Alignment:
    """Chunks (laid end to end in row, cut at `cut`) encoded by both tokenizers:
    token counts, links (A id in the upper, B id in the lower half) and groups of each."""

    def __init__(self, row: np.ndarray, cut: np.ndarray, first: ByteTokenizer, second: PieceTokenizer):
        n = len(cut) - 1
        sides = []
        self.good = np.ones(n, bool)
        for tokenizer in (first, second):
            ids, ends, bad = self._encoded(row, cut, tokenizer)
            self.good[bad] = False
            sides.append((ids, ends))
        (a_ids, a_ends), (b_ids, b_ends) = [self._of_good(cut, *s) for s in sides]
        self.n_a, self.n_b = (np.diff(np.searchsorted(e, cut, side="right")) for e in (a_ends, b_ends))
        ends, times = distinct(np.concatenate([a_ends, b_ends]), counted=True)
        self.n_links = np.diff(np.searchsorted(ends, cut, side="right"))
        self.links = a_ids[np.searchsorted(a_ends, ends)] << 32 | b_ids[np.searchsorted(b_ends, ends)]
        both = ends[times == 2]
        self.n_groups = np.diff(np.searchsorted(both, cut, side="right"))
        parts = []
        for (ids, own), tokenizer in (((a_ids, a_ends), first), ((b_ids, b_ends), second)):
            parts.append(_joined(tokenizer.vocabulary.names.take(pa.array(ids)), np.concatenate([[0], np.searchsorted(own, both, side="right")]), ","))
        self.groups = _joined(pc.binary_join_element_wise(*parts, pa.scalar("|", pa.large_string())), np.concatenate([[0], np.cumsum(self.n_groups)]), ";")

    @staticmethod
    def _encoded(row, cut, tokenizer):
        """(ids, ends in row, chunks that the decoded bytes do not spell)."""
        found, i = [], 0
        loose = np.flatnonzero(~solid_before(row, cut[1:])) + 1  # a text's white space at its end meets no other chunk
        while i < len(cut) - 1:
            j = max(i + 1, int(np.searchsorted(cut, cut[i] + ENCODED, side="right")) - 1)
            k = int(np.searchsorted(loose, i + 1))
            j = min(j, int(loose[k])) if k < len(loose) else j
            ids, begin, end = tokenizer.encode(row[cut[i]: cut[j]].tobytes())
            found.append((ids, begin + cut[i], end + cut[i]))
            i = j
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        ids, begin, end = (np.concatenate(x) for x in zip(*found, strict=True))
        ends, agree = refined_ends(begin, end, tokenizer.vocabulary.length[ids])
        chunk = np.clip(np.searchsorted(cut, np.maximum(begin, end - 1), side="right") - 1, 0, len(cut) - 2)
        bad = np.zeros(len(cut) - 1, bool)
        bad[chunk[~agree]] = True
        # of the rest, all bytes are compared
        kept = ~bad[chunk]
        width = np.diff(cut)
        bad |= np.bincount(chunk[kept], weights=tokenizer.vocabulary.length[ids[kept]], minlength=len(width)).astype(np.int64) != width
        kept = ~bad[chunk]
        spelled = tokenizer.vocabulary.spelled(ids[kept])
        where = np.repeat(~bad, width)
        wrong = np.flatnonzero(where)[spelled != row[where]]
        bad[np.searchsorted(cut, wrong, side="right") - 1] = True
        return ids, np.where(kept, ends, end), np.flatnonzero(bad)

    def _of_good(self, cut, ids, ends):
        kept = self.good[np.clip(np.searchsorted(cut, ends, side="left") - 1, 0, len(cut) - 2)]
        return ids[kept], ends[kept]


def _joined(values: pa.Array, at: np.ndarray, by: str) -> pa.Array:
    """Lists of strings (from at[i] to at[i + 1]) as one string each."""
    lists = pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), values.cast(pa.large_string()))
    return pc.binary_join(lists, pa.scalar(by, pa.large_string()))


def _spread(at: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, member) for the ranges at[x] to at[x + 1] of all x in of."""
    n = (at[1:] - at[:-1])[of]
    return np.repeat(np.arange(len(of)), n), np.repeat(at[of] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Book:
    """Chunks that a worker has encoded, with what Alignment knows of them.  When
    there are REMEMBERED chunks or REMEMBERED_BYTES of them, those of one slice
    only are forgotten (all, if too many are left)."""

    def __init__(self, first: ByteTokenizer, second: PieceTokenizer):
        self.tokenizers = first, second
        self.forget()

    def forget(self) -> None:
        self.chunks, self.groups = pa.array([], pa.large_binary()), pa.array([], pa.large_string())
        self.good = np.zeros(0, bool)
        self.counts = np.zeros((4, 0), np.int64)  # A tokens, B tokens, groups, links
        self.links = np.zeros(0, np.int64)
        self.seen = np.zeros(0, np.int32)  # slices that held the chunk, lately

    def full(self, share: float = 1.0) -> bool:
        return len(self.chunks) > share * REMEMBERED or self.chunks.nbytes + self.groups.nbytes > share * REMEMBERED_BYTES

    def thin_out(self) -> None:
        keep = np.flatnonzero(self.seen > 1)
        _, link = _spread(np.concatenate([[0], np.cumsum(self.counts[3])]), keep)
        at = pa.array(keep)
        self.chunks, self.groups = self.chunks.take(at), self.groups.take(at)
        self.good, self.links, self.counts, self.seen = self.good[keep], self.links[link], self.counts[:, keep], self.seen[keep] // 2
        if self.full(0.5):
            self.forget()

    def rows(self, chunks: pa.Array) -> np.ndarray:
        """The row in this book of every one of some different chunks."""
        if self.full():
            self.thin_out()
        at = pc.index_in(chunks, value_set=self.chunks)
        new, at = at.is_null().to_numpy(zero_copy_only=False), at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        at[new] = len(self.chunks) + np.arange(new.sum())
        if new.any():
            more = chunks.filter(pa.array(new))
            found = Alignment(*string_bytes(more.cast(pa.large_string())), *self.tokenizers)
            self.chunks, self.groups = pa.concat_arrays([self.chunks, more]), pa.concat_arrays([self.groups, found.groups])
            self.good, self.links = np.concatenate([self.good, found.good]), np.concatenate([self.links, found.links])
            self.counts = np.concatenate([self.counts, [found.n_a, found.n_b, found.n_groups, found.n_links]], axis=1)
            self.seen = np.concatenate([self.seen, np.zeros(len(more), np.int32)])
        self.seen[at] += 1
        return at


def aligned_slice(ids: pa.Array, texts: pa.Array, book: Book, with_groups: bool):
    """(payload, pairs, documents per pair) of a slice of texts: what is known
    without other documents, and what `finished` needs to complete it."""
    data, offsets = string_bytes(texts)
    n_texts = len(offsets) - 1
    filled = np.flatnonzero(np.diff(offsets))
    row = np.insert(data, offsets[filled], 32)
    heads = offsets[filled] + np.arange(len(filled))
    starts = chunk_starts(row, heads)
    buffers = [None, pa.py_buffer(np.append(starts, len(row))), pa.py_buffer(row)]
    chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    index = chunks.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    known = book.rows(chunks.dictionary)
    counts, n_chunks = book.counts[:, known], len(known)
    _, link = _spread(np.concatenate([[0], np.cumsum(book.counts[3])]), known)
    link = book.links[link]
    pairs = distinct(link)
    link, link_at = np.searchsorted(pairs, link), np.concatenate([[0], np.cumsum(counts[3])])
    # chunks of text t: index[at[t]: at[t + 1]]; a text with a bad chunk has none
    own = np.zeros(n_texts, np.int64)
    own[filled] = np.diff(np.append(np.searchsorted(starts, heads), len(starts)))
    text = np.repeat(np.arange(n_texts), own)
    spoilt = np.zeros(n_texts, bool)
    spoilt[text[~book.good[known][index]]] = True
    index, text = index[~spoilt[text]], text[~spoilt[text]]
    at = np.searchsorted(text, np.arange(n_texts + 1))
    spelled = _joined(book.groups.take(pa.array(known[index])), at, ";")
    digests = [hashlib.sha256(memoryview(g.as_buffer())).hexdigest() if b > a else "" for g, a, b in zip(spelled, at[:-1], at[1:], strict=True)]
    # a text's distinct chunks, then its distinct pairs
    held, times = distinct(text * (n_chunks + 1) + index, counted=True)
    held_text, held_chunk = held // (n_chunks + 1), held % (n_chunks + 1)
    which, at_link = _spread(link_at, held_chunk)
    pair = distinct(held_text[which] * max(1, len(pairs)) + link[at_link]) % max(1, len(pairs))
    documents = np.bincount(pair, minlength=len(pairs))
    used = np.flatnonzero(documents)  # pairs of spoilt texts alone are in no document
    renumbered = np.cumsum(documents > 0) - 1
    payload = {
        "ids": ids.to_pylist(), "counts": [np.bincount(text, weights=x[index], minlength=n_texts).astype(np.int64) for x in counts], "digests": digests,
        "groups": spelled.to_pylist() if with_groups else None, "text": held_text.astype(np.int32), "chunk": held_chunk.astype(np.int32), "times": times.astype(np.int32),
        "link_at": link_at, "link": np.where(documents[link] > 0, renumbered[link], 0).astype(np.int32),
    }
    return payload, pairs[used], documents[used]


def finished(payload: dict, count: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    """The documents of a slice, given the corpus' count of each of its pairs
    and whether that is the highest of the pair's A id."""
    n = len(payload["ids"])
    which, link = np.repeat(np.arange(len(payload["link_at"]) - 1), np.diff(payload["link_at"])), payload["link"]
    sums = []
    for value in (best, count):
        per_chunk = np.zeros(len(payload["link_at"]), np.int64)
        if len(value):
            np.add.at(per_chunk, which, value[link].astype(np.int64))
        own = np.zeros(n, np.int64)
        np.add.at(own, payload["text"], per_chunk[payload["chunk"]] * payload["times"])
        sums.append(own)
    return pa.RecordBatch.from_arrays([
        pa.array(payload["ids"], pa.int64()), *[pa.array(x, pa.int64()) for x in [*payload["counts"], *sums]], pa.array(payload["digests"], pa.string()),
        pa.array(payload["groups"], pa.string()) if payload["groups"] is not None else pa.nulls(n, pa.string()),
    ], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"])


_books: dict[tuple[str, str], Book] = {}


def _book(first: str, second: str) -> Book:
    """One book per worker process and pair of tokenizers."""
    if (first, second) not in _books:
        _books[first, second] = Book(ByteTokenizer(first), PieceTokenizer(second))
    return _books[first, second]


def sliced(docs: DataFrame, first: str, second: str, with_groups: bool = False) -> DataFrame:
    """Stored: kind 0, a row per slice of documents; kind 1, its distinct pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = _book(first, second)
        number = TaskContext.get().partitionId() << 33

        def made(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(parts).combine_chunks()
            ids, texts = (pa.concat_arrays(rows[c].chunks) for c in ("doc_id", "text"))
            payload, pairs, n = aligned_slice(ids, texts, book, with_groups)
            yield _rows(0, number, payload=zstandard.compress(pickle.dumps(payload), 1))
            for i in range(0, len(pairs), 100_000):
                yield _rows(1, number, pairs[i: i + 100_000], n[i: i + 100_000])

        held, size = [], 0
        for batch in batches:
            for i, j in slices(batch["text"], SLICE):
                part = batch.slice(i, j - i)
                more = pc.sum(pc.binary_length(part["text"])).as_py() or 0
                if held and size + more > SLICE:
                    yield from made(held)
                    held, size, number = [], 0, number + 1
                held.append(part)
                size += more
        if held:
            yield from made(held)
        held = []
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(run, PARTS), "alignment")


def _rows(kind: int, number: int, pairs: np.ndarray | None = None, n: np.ndarray | None = None, payload: bytes | None = None) -> pa.RecordBatch:
    m = 1 if pairs is None else len(pairs)
    none = pa.nulls(m, pa.int32())
    ints = [none] * 3 if pairs is None else [pa.array(x.astype(np.int32)) for x in (pairs >> 32, pairs & 0xFFFFFFFF, n)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(m, kind, np.int32)), pa.array(np.full(m, number, np.int64)), pa.array([payload], pa.binary()) if kind == 0 else pa.nulls(m, pa.binary()), *ints],
                                      names=["kind", "slice", "payload", "a", "b", "n"])


def pair_counts(parts: DataFrame) -> DataFrame:
    """Stored (a, b, count, best): documents that hold a pair linked, and
    whether no other pair of its A id is held by more."""
    counts = stored(parts.where("kind = 1").groupBy("a", "b").agg(F.sum("n").alias("count")), "alignment-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return stored(counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")), "alignment-best")


def aligned(docs: DataFrame, first: str | None = None, second: str | None = None, with_groups: bool = True) -> DataFrame:
    """One row per row of docs (doc_id, text): numbers of tokens, groups and
    links, what the corpus says about its links, and its groups as text."""
    spark = docs.sparkSession
    default = default_tokenizers()
    parts = sliced(docs, first or default[0], second or default[1], with_groups)
    counts = pair_counts(parts)
    told = parts.where("kind = 1").select("slice", "a", "b").join(counts, ["a", "b"]).select(F.lit(1).alias("kind"), "slice", F.lit(None).cast("binary").alias("payload"), "a", "b", "count", "best")
    slices_ = parts.where("kind = 0").select("kind", "slice", "payload", "a", "b", F.lit(None).cast("long").alias("count"), F.lit(None).cast("boolean").alias("best"))
    met = slices_.unionByName(told).repartition(partitions(spark), "slice").sortWithinPartitions("slice", "kind", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payload, counts_, best = None, [], []
        for batch in batches:
            kinds = batch["kind"].to_numpy()
            edges = [*np.flatnonzero(kinds == 0).tolist(), len(kinds)]
            for i, j in zip([0, *edges[:-1]] if edges[0] else edges[:-1], edges if edges[0] else edges[1:], strict=True):
                if kinds[i] == 0:
                    if payload is not None:
                        yield _unpacked(payload, counts_, best)
                    payload, counts_, best = batch["payload"][i].as_py(), [], []
                    i += 1
                counts_.append(batch["count"].slice(i, j - i).to_numpy(zero_copy_only=False))
                best.append(batch["best"].slice(i, j - i).to_numpy(zero_copy_only=False))
        if payload is not None:
            yield _unpacked(payload, counts_, best)
        give_back()

    return met.mapInArrow(run, ALIGNED)


def _unpacked(raw: bytes, counts: list[np.ndarray], best: list[np.ndarray]) -> pa.RecordBatch:
    payload = pickle.loads(zstandard.decompress(raw))
    none = [np.zeros(0, np.int64)]
    return finished(payload, np.concatenate(counts or none).astype(np.int64), np.concatenate(best or none).astype(bool))


def op13_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents", "doc_id", "text"), with_groups=False).drop("groups")
