"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are folded to words (A-Z lower-cased, bytes that are no letter, digit or
part of a multibyte character as one space), so that a window of an item is the
bytes of its words with a space before, between and after them.  Windows of
similar length are one pattern class with its shortest length m.  Over the first m
bytes of its patterns a class has a table that says, for the hash of a block of
bytes, how far a search may skip when that block is last in view; where it may
not skip, patterns whose m bytes end with that very block are taken from a
bucket sorted by block, their heads and then all their bytes are compared.
Many stretches of a slice of texts are searched side by side in numpy.

Items are searched for in blocks of at most about BLOCK_BYTES of item text, a
block per pass over the documents; only one block is sent to the workers at once.

Defined results: a null or word-less text has no words and no hits; an item
without words occurs nowhere; items that share an id are one item; an item
without an id marks words but is not listed; a row of documents that repeats has
a row each time; without items nothing is hit; no documents give no rows;
windows never reach from one text into the next; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import stored, table
from .textscan import give_back, slices, string_bytes, word_hashes

WINDOW = 10  # words
BLOCK_BYTES = 8 << 20  # item text of one pass
STRETCH = 1024  # bytes that one cursor searches
COMPARED = 4 << 20  # bytes compared in one numpy step
FOUND = "doc_id long, key string, n_words long, spans array<struct<start: long, length: long>>, items array<string>"
SPACE = 32

# What a byte is searched as: letters and digits in lower case, bytes of
# multibyte characters as they are, the rest as a space.
FOLD = np.full(256, SPACE, np.uint8)
FOLD[128:] = np.arange(128, 256)
for _low, _high, _add in (("0", "9", 0), ("a", "z", 0), ("A", "Z", 32)):
    FOLD[ord(_low): ord(_high) + 1] = np.arange(ord(_low), ord(_high) + 1) + _add


def folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, places of their spaces, number of the first word of each text
    and, last, of words in all): all words of all texts in one row, one space
    before, between and after them.  Word i stands between spaces i and i + 1."""
    laid = FOLD[np.insert(data, offsets, SPACE)]
    gap = laid == SPACE
    after_gap = np.concatenate([[False], gap[:-1]])
    starts = np.flatnonzero(after_gap & ~gap)
    first = np.searchsorted(starts, offsets + np.arange(len(offsets)))
    row = laid[~(gap & after_gap)]
    return row, np.flatnonzero(row == SPACE), first


def _eights(row: np.ndarray) -> np.ndarray:
    """Eight bytes from every place of row on, as one number (zeros behind its end)."""
    padded = np.concatenate([row, np.zeros(8, np.uint8)])
    return np.ndarray((len(row),), "<u8", padded, 0, (1,))


def _low_bytes(n: int) -> np.uint64:
    return np.uint64((1 << 8 * n) - 1)


def same_bytes(x: np.ndarray, at_x: np.ndarray, y: np.ndarray, at_y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether n bytes of x and y from the given places on are equal."""
    out = np.zeros(len(n), bool)
    ends = np.cumsum(n)
    a = 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + COMPARED, side="right")))
        own = np.cumsum(n[a:b]) - n[a:b]
        step = np.arange(int(n[a:b].sum()))
        equal = x[np.repeat(at_x[a:b] - own, n[a:b]) + step] == y[np.repeat(at_y[a:b] - own, n[a:b]) + step]
        out[a:b] = np.logical_and.reduceat(equal, own)
        a = b
    return out


class PatternClass:
    """Patterns of similar length (places and lengths in one row of bytes)."""

    def __init__(self, row: np.ndarray, start: np.ndarray, length: np.ndarray, number: np.ndarray):
        self.row, self.eights = row, _eights(row)
        self.m = m = int(min(length.min(), 255))
        self.block = min(8, (m + 1) // 2)
        self.mask = _low_bytes(self.block)
        self.bits = min(24, max(12, (16 * len(start) * (m - self.block + 1)).bit_length()))
        self.shift = np.full(1 << self.bits, m - self.block + 1, np.uint8)
        for j in range(m - self.block + 1):  # later blocks allow smaller shifts and overwrite
            self.shift[self._slot(self.eights[start + j] & self.mask)] = m - self.block - j
        suffix = self.eights[start + m - self.block] & self.mask
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.start, self.length, self.number = suffix[order], start[order], length[order], number[order]

    def _slot(self, block: np.ndarray) -> np.ndarray:
        return ((block * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _stops(self, eights: np.ndarray) -> np.ndarray:
        """Places where m bytes begin that no table entry lets the search skip."""
        back = self.block - 1
        last = np.arange(self.m - 1, len(eights), STRETCH)
        limit = np.minimum(last + STRETCH, len(eights))
        found = []
        while len(last):
            skip = self.shift[self._slot(eights[last - back] & self.mask)]
            stop = skip == 0
            if stop.any():
                found.append(last[stop])
            last = last + np.maximum(skip, 1)
            live = last < limit
            if not live.all():
                last, limit = last[live], limit[live]
        return np.concatenate(found) - (self.m - 1) if found else np.zeros(0, np.int64)

    def find(self, row: np.ndarray, eights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, pattern numbers) of all occurrences in row."""
        at = self._stops(eights)
        block = eights[at + self.m - self.block] & self.mask
        low = np.searchsorted(self.suffix, block, side="left")
        count = np.searchsorted(self.suffix, block, side="right") - low
        places, numbers = [], []
        ends = np.cumsum(count)
        a = 0
        while a < len(at):  # buckets of bounded size together
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + COMPARED // 8, side="right")))
            n = count[a:b]
            where = np.repeat(at[a:b], n)
            which = np.repeat(low[a:b] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            head = _low_bytes(min(8, self.m))
            fits = (where + self.length[which] <= len(row)) & ((eights[where] & head) == (self.eights[self.start[which]] & head))
            where, which = where[fits], which[fits]
            equal = same_bytes(row, where, self.row, self.start[which], self.length[which])
            places.append(where[equal])
            numbers.append(self.number[which[equal]])
            a = b
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(places), np.concatenate(numbers)


class Windows:
    """The distinct windows of items (ids, texts), ready for search."""

    def __init__(self, ids: list[str | None], texts: pa.Array, window: int = WINDOW):
        row, spaces, first = folded(*string_bytes(texts))
        n = np.diff(first)
        made = np.where(n >= window, n - window + 1, (n > 0).astype(n.dtype))
        item = np.repeat(np.arange(len(n)), made)
        word = np.repeat(first[:-1] - (np.cumsum(made) - made), made) + np.arange(int(made.sum()))
        words = np.minimum(n[item], window)
        start, length = spaces[word], spaces[word + words] + 1 - spaces[word]
        # equal windows are one pattern
        order = np.lexsort((word_hashes(row, start, start + length), length))
        start, length, words, item = start[order], length[order], words[order], item[order]
        fresh = np.ones(len(start), bool)
        alike = np.flatnonzero(length[1:] == length[:-1])
        fresh[alike + 1] = ~same_bytes(row, start[alike], row, start[alike + 1], length[alike])
        number = np.cumsum(fresh) - 1
        start, length, self.words = start[fresh], length[fresh], words[fresh]
        self.names = sorted({i for i in ids if i is not None})
        rank = {name: k for k, name in enumerate(self.names)}
        named = np.array([-1 if i is None else rank[i] for i in ids], np.int64)[item] if len(item) else np.zeros(0, np.int64)
        listed = np.unique(np.stack([number[named >= 0], named[named >= 0]]), axis=1)
        self.item = listed[1]  # items of pattern p: item[at[p]: at[p + 1]]
        self.at = np.searchsorted(listed[0], np.arange(len(start) + 1))
        kind = np.minimum(np.frexp(length.astype(np.float64))[1], 9)
        self.classes = [PatternClass(row, start[kind == k], length[kind == k], np.flatnonzero(kind == k)) for k in np.unique(kind)]

    def search(self, texts: pa.Array) -> tuple[np.ndarray, list, list]:
        """(words, hit spans as (start, length), names of occurring items) per text."""
        row, spaces, first = folded(*string_bytes(texts))
        n_texts, total = len(first) - 1, int(first[-1])
        eights = _eights(row)
        found = [c.find(row, eights) for c in self.classes]
        place = np.concatenate([np.zeros(0, np.int64), *[f[0] for f in found]])
        pattern = np.concatenate([np.zeros(0, np.int64), *[f[1] for f in found]])
        word = np.searchsorted(spaces, place)
        text = np.searchsorted(first, word, side="right") - 1
        inside = word + self.words[pattern] <= first[text + 1]
        word, text, pattern = word[inside], text[inside], pattern[inside]
        # words under at least one occurrence, as spans cut at the texts' ends
        edge = np.bincount(word, minlength=total + 1) - np.bincount(word + self.words[pattern], minlength=total + 1)
        hit = np.cumsum(edge)[:total] > 0
        opens = np.concatenate([[False], hit, [False]])
        head = np.zeros(total + 1, bool)
        head[first] = True
        begin = np.flatnonzero(hit & (~opens[:-2] | head[:-1]))
        end = np.flatnonzero(hit & (~opens[2:] | head[1:])) + 1
        cut = np.searchsorted(begin, first)
        # items by text
        pairs = np.unique(np.stack([text, pattern]), axis=1)
        count = np.diff(self.at)[pairs[1]]
        item = self.item[np.repeat(self.at[pairs[1]] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
        listed = np.unique(np.stack([np.repeat(pairs[0], count), item]), axis=1)
        part = np.searchsorted(listed[0], np.arange(n_texts + 1))
        spans, items = [[]] * n_texts, [[]] * n_texts
        for i in np.flatnonzero(np.diff(cut)):
            spans[i] = [{"start": int(x - first[i]), "length": int(y - x)} for x, y in zip(begin[cut[i]: cut[i + 1]], end[cut[i]: cut[i + 1]], strict=True)]
        for i in np.flatnonzero(np.diff(part)):
            items[i] = [self.names[k] for k in listed[1][part[i]: part[i + 1]]]
        return np.diff(first), spans, items


_built: dict[str, Windows] = {}


def _windows(block, window: int) -> Windows:
    """The block's windows, built once per worker process; one block is kept."""
    if block.id not in _built:
        _built.clear()
        _built[block.id] = Windows(*block.value, window)
    return _built[block.id]


class _Block:
    """A broadcast block of items with a name for the workers' cache."""

    def __init__(self, spark: SparkSession, items: DataFrame):
        rows = items.toArrow()
        texts = rows["text"].combine_chunks() if rows.num_rows else pa.array([], pa.string())
        self.sent = spark.sparkContext.broadcast((rows["id"].to_pylist(), texts))  # bounded by the block's size
        self.id = uuid.uuid4().hex

    def __getstate__(self):
        return {"id": self.id, "sent": self.sent}

    @property
    def value(self):
        return self.sent.value


def _searched(docs: DataFrame, block: _Block, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(block, window)
        for batch in batches:
            for a, b in slices(batch["text"], 2 << 20):
                part = batch.slice(a, b - a)
                n, spans, items = windows.search(part["text"])
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"], part["key"], pa.array(n, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), pa.array(items, pa.list_(pa.string())),
                ], names=["doc_id", "key", "n_words", "spans", "items"])
        give_back()

    return docs.mapInArrow(run, FOUND)


def _blocks(items: DataFrame, block_bytes: int) -> list[DataFrame]:
    """items cut by hash into tables of about block_bytes of text at most."""
    items = items.select(F.col("item_id").cast("string").alias("id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    number = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    return [items.where(number == i) if n > 1 else items for i in range(n)]


def _united(spans) -> F.Column:
    """Overlapping or touching spans as one."""
    def put(done, x):
        last = F.element_at(done, -1)
        touches = (F.size(done) > 0) & F.coalesce(F.get(done, F.size(done) - 1)["start"] + F.get(done, F.size(done) - 1)["length"] >= x["start"], F.lit(False))
        longer = F.struct(last["start"].alias("start"), (F.greatest(last["start"] + last["length"], x["start"] + x["length"]) - last["start"]).alias("length"))
        return F.when(touches, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<start: bigint, length: bigint>>"), put)


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items) per row of docs (doc_id, text): the
    stretches of words inside windows of items (item_id, text), and the sorted
    ids of the items that they belong to.  `clean_parts` cuts the texts there."""
    spark = docs.sparkSession
    blocks = _blocks(items, block_bytes)
    key = F.sha2(F.col("text"), 256) if len(blocks) > 1 else F.lit(None).cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", key.alias("key"))
    first = _searched(docs, _Block(spark, blocks[0]), window)
    if len(blocks) == 1:
        return first.drop("key")
    # further blocks: what they find is added to the row by id and text
    found = [stored(_searched(docs, _Block(spark, b), window).where(F.size("spans") > 0), "decontamination") for b in blocks[1:]]
    rows = reduce(DataFrame.unionByName, [f.dropDuplicates(["doc_id", "key"]) for f in found])
    more = rows.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items"))
    more = more.select(F.col("doc_id").alias("i"), F.col("key").alias("k"), "more_spans", "more_items")
    met = first.join(more, F.col("doc_id").eqNullSafe(F.col("i")) & F.col("key").eqNullSafe(F.col("k")), "left")
    both = lambda a, b: F.concat(a, F.coalesce(b, F.expr(f"cast(array() AS {dict(first.dtypes)[a]})")))
    return met.select("doc_id", "n_words", _united(both("spans", F.col("more_spans"))).alias("spans"), F.array_sort(F.array_distinct(both("items", F.col("more_items")))).alias("items"))


def op11_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminated(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["length"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
starts AS (
  SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS words FROM starts),
grams AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS words
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
met AS (SELECT r, i, k, item_id FROM grams JOIN windows USING (k, words)),
hits AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + k)) AS j FROM met) GROUP BY r),
names AS (
  SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hits.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(names.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN names USING (r)
"""
