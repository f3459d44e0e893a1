"""N-gram Jaccard join by parity sketches.

A document is the set of its five-word shingles (64-bit hashes).  Sets of a
size band share a bit sketch of `chunks` chunks of 2**32 bits: every shingle
flips one bit, so the Hamming distance of two sketches, and even more so the
number of chunks in which they differ, is at most the symmetric difference of
the sets.  A chunk's content is kept as the XOR of its shingles' hashes.

Sets with 100 |A and B| >= 75 |A or B| differ in at most a third of either's
size.  So of the chunks that are not empty at most d = |A| / 3 differ, and when
chunks stand in one order for all documents the first d + 1 of A and of B share
one: pigeonhole.  Those chunks are the join keys; nothing is capped, so no link
can be missed.  The order puts contents that more than HEAVY documents hold last
(all chunks of all documents are counted for that, each in its own part of the
keys), so a passage that many documents share is no key of a document that has
enough chunks beside it.  A counter serves up to COUNTED chunks, so a content is
also heavy where its counter is; heavy contents travel as a bit filter of bounded
size; what is taken for heavy by mistake stands last for all documents alike.  The
number of chunks is such that a set leaves more than d + 1 of them non-empty
(one chunk per shingle in small bands; in larger ones the odds of a shortfall
are below 1e-20).  Candidates must pass the size bound and the Hamming bound,
first of a 512-bit parity sketch, then for larger sets of one of at least a bit
a shingle (folded to the smaller one's bits); then the sets are compared.

For components not all pairs are needed: in each bucket every document is first
compared with the smallest one only; then documents of one bucket that are not
yet connected are compared with each other.

Defined results: a null or word-less text has an empty set and is linked with
nothing; fewer than five words are one shingle; documents with equal sets are
one class (linked by definition) and only its smallest id is joined; rows that
share a doc_id are one node; a null doc_id is linked with nothing and has a
null component; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .components import connected_components
from .shared import partitions, stored, table
from .textscan import give_back, mixed, shingle_sets, slices

HEAVY = 64  # contents of more documents stand last; doubled while MOST_HEAVY are exceeded
MOST_HEAVY = 1 << 22
COUNTED = 32  # chunks a counter serves on average, at most; fewer than HEAVY
PART_KEYS = 2_000_000  # join keys that one reduce step holds
HOT_KEYS = 1_000_000  # a key held by more documents is dealt over several parts
SEEN = 100_000  # classes a task remembers, to join copies it meets once
FIRST_CHUNKED_BAND = 3  # bands hold sizes 4**b up to 4**(b + 1)
INFO = "doc_id long, n long, d1 long, d2 long, sketch binary, wide binary"
SKETCH_WORDS = 8
WIDE_FROM = 64 * SKETCH_WORDS  # sets of more shingles have a wide sketch too
BLOOM_BITS = 1 << 26  # at most so many bits say which documents' sets are wanted


def bands(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(band of a size, whether a partner can be in the band below)."""
    band = np.zeros(len(n), np.int64)
    for b in range(1, 32):
        band += n >= 1 << (2 * b)
    return band, (band > 0) & (3 * n < 4 << (2 * band))


def band_keys(values: np.ndarray, offsets: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, offsets) of the non-empty chunks of sorted sets in a band."""
    chunks = 1 << (2 * (band + 1)) if band >= FIRST_CHUNKED_BAND else (1 << 32) - 1
    chunk = ((values >> np.uint64(32)) * np.uint64(chunks)) >> np.uint64(32)
    new = np.ones(len(values), bool)
    new[1:] = chunk[1:] != chunk[:-1]
    new[offsets[:-1][np.diff(offsets) > 0]] = True
    at = np.flatnonzero(new)
    content = np.bitwise_xor.reduceat(mixed(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at) if len(at) else values[:0]
    keys = mixed(content ^ ((chunk[at] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((band + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1))
    return keys, np.concatenate([[0], np.cumsum(new)])[offsets]


def document_keys(values: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, keys, offsets) per band for the documents in keep."""
    n = np.diff(offsets)
    band, below = bands(n)
    for b in np.unique(np.concatenate([band[keep], band[keep & below] - 1])):
        docs = np.flatnonzero(keep & (n > 0) & ((band == b) | (below & (band - 1 == b))))
        if len(docs):
            sizes = n[docs]
            own = np.concatenate([[0], np.cumsum(sizes)])
            at = np.repeat(offsets[docs] - own[:-1], sizes) + np.arange(own[-1])
            yield docs, *band_keys(values[at], own, int(b))


def folded(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The 512-bit parity sketch of every set, as rows of eight 64-bit words."""
    bits = 64 * SKETCH_WORDS
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    flips = np.bincount(doc * bits + (values & np.uint64(bits - 1)).astype(np.int64), minlength=(len(offsets) - 1) * bits)
    return np.packbits((flips & 1).astype(np.uint8).reshape(-1, bits), axis=1, bitorder="little").view("<i8")


def wide_sketch(values: np.ndarray) -> bytes | None:
    """A parity sketch of at least a bit a shingle, a power of two: sets of one
    size that share under three fifths are told apart by it."""
    if len(values) <= WIDE_FROM:
        return None
    bits = 1 << (len(values) - 1).bit_length()
    flips = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").tobytes()


def wide_distance(x, y) -> int:
    """Hamming distance, the longer sketch folded to the shorter's bits."""
    a, b = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum())


def _sets(batch: pa.RecordBatch):
    """(row range, ids, id is null, sets) of a batch in slices."""
    for a, b in slices(batch["text"], rows=1000):
        part = batch.slice(a, b - a)
        ids = part["doc_id"]
        values, offsets = shingle_sets(part["text"])
        yield ids, ids.is_null().to_numpy(zero_copy_only=False), values, offsets


def _digests(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    raw = b"".join(xxhash.xxh3_128_digest(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True))
    return np.frombuffer(raw, "<i8").reshape(-1, 2)


class _Seen:
    """Digests of sets met by a task, forgotten when there are SEEN."""

    def __init__(self):
        self.met: set[bytes] = set()

    def fresh(self, digests: np.ndarray, usable: np.ndarray) -> np.ndarray:
        out = np.zeros(len(digests), bool)
        if len(self.met) > SEEN:
            self.met = set()
        for i in np.flatnonzero(usable):
            d = digests[i].tobytes()
            if d not in self.met:
                self.met.add(d)
                out[i] = True
        return out


def scanned(docs: DataFrame) -> DataFrame:
    """Stored: size, digest and sketches of every document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, values, offsets in _sets(batch):
                digests, sketch = _digests(values, offsets), folded(values, offsets)
                yield pa.RecordBatch.from_arrays([
                    ids.cast(pa.int64()), pa.array(np.diff(offsets)), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                    pa.array([x.tobytes() for x in sketch], pa.binary()), pa.array([wide_sketch(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary()),
                ], names=["doc_id", "n", "d1", "d2", "sketch", "wide"])
        give_back()

    return stored(docs.mapInArrow(run, INFO), "jaccard-scan")


def content_ids(keys: np.ndarray, n_parts: int) -> np.ndarray:
    """A content's part and its counter among 2**16 in it, as one number."""
    return ((keys % np.uint64(n_parts)) << np.uint64(16) | keys >> np.uint64(48)).astype(np.int64)


def planes(ids: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as differences, equal bytes of all in a row, so
    that the shuffle's compression finds them."""
    return np.diff(ids, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(raw) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<i8").ravel())


def heavy_contents(docs: DataFrame, total: int, part_keys: int, over: int) -> tuple[DataFrame, int]:
    """(stored (id, place, count), parts): the counters that more than `over`
    documents' chunks meet, out of all chunks of all documents; copies that a
    task meets count once.  Two bytes a chunk travel, in blocks per task and part."""
    spark = docs.sparkSession
    n_parts = max(1, -(-total // min(part_keys, COUNTED << 16)))

    def blocks(ids: np.ndarray) -> pa.RecordBatch:
        ids = np.sort(ids)
        part = ids >> 16
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        raw = (ids & 0xFFFF).astype("<u2")
        return pa.RecordBatch.from_arrays([pa.array(part[cuts]), pa.array([raw[a:b].tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(ids)), strict=True)], pa.binary())], names=["part", "places"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = _Seen(), [], 0
        for batch in batches:
            for _, null, values, offsets in _sets(batch):
                for _, keys, _ in document_keys(values, offsets, seen.fresh(_digests(values, offsets), ~null & (np.diff(offsets) > 0))):
                    held.append(content_ids(keys, n_parts))
                    size += len(keys)
                if size > 1_000_000:
                    yield blocks(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield blocks(np.concatenate(held))
        held = []
        give_back()

    def counted(part: int, count: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(count > over)
        ids = part << 16 | at
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(mixed(ids.astype(np.uint64)).astype(np.int64)), pa.array(count[at])], names=["id", "place", "count"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, sums = None, np.zeros(1 << 16, np.int64)
        for batch in batches:
            for part, places in zip(batch["part"].to_pylist(), batch["places"], strict=True):
                if part != here:
                    if here is not None:
                        yield counted(here, sums)
                    here, sums = part, np.zeros(1 << 16, np.int64)
                sums += np.bincount(np.frombuffer(places.as_buffer(), "<u2"), minlength=1 << 16)
        if here is not None:
            yield counted(here, sums)
        give_back()

    keyed = docs.mapInArrow(emit, "part long, places binary")
    dealt = keyed.repartition(max(partitions(spark), min(n_parts, 10 * partitions(spark))), "part").sortWithinPartitions("part")
    return stored(dealt.mapInArrow(count, "id long, place long, count long"), "jaccard-heavy"), n_parts


def heavy_filter(heavy: DataFrame, over: int) -> tuple[int, np.ndarray]:
    """(bits, words) of the contents that are held by most documents: by more
    than `over`, or the least double of it that MOST_HEAVY contents exceed."""
    classes = {r["c"]: r["n"] for r in heavy.groupBy(F.floor(F.log2(F.col("count") / over)).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()}
    level = 0
    while sum(n for c, n in classes.items() if c >= level) > MOST_HEAVY:
        level += 1
    return _bits(heavy.where(F.col("count") > over << level), F.col("place"))


def buckets(docs: DataFrame, heavy: DataFrame, heavy_parts: int, total_keys: int, part_keys: int = PART_KEYS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Stored (bucket, hot, members): the distinct groups of documents that
    share a join key.  Keys travel in blocks, one per task and part, and are
    grouped by sorting a part of at most about `part_keys` keys."""
    spark = docs.sparkSession
    n_parts = max(1, -(-total_keys // part_keys))
    bits, words = heavy_filter(heavy, min(HEAVY, hot_keys))
    last = spark.sparkContext.broadcast(words)  # at most BLOOM_BITS bits
    # a hot key is held by more than hot_keys documents, so there are few
    spread = spark.sparkContext.broadcast({r["id"]: -(-r["count"] // hot_keys) for r in heavy.where(F.col("count") > hot_keys).collect()})

    def blocks(keys, owners, hot):
        part = keys % np.uint64(n_parts)
        if hot.any():
            salt = mixed(owners[hot].astype(np.uint64))
            width = np.array([spread.value[int(x)] for x in content_ids(keys[hot], heavy_parts)], np.uint64)
            part[hot] = (part[hot] + salt % width) % np.uint64(n_parts)
        order = np.lexsort((owners, part))
        part, keys, owners, hot = part[order], keys[order], owners[order], hot[order]
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = np.append(cuts[1:], len(part))
        # 32 bits of a key are enough inside a part: what meets by chance is compared and dropped
        short = (keys >> np.uint64(32)).astype("<u4")
        whole = [np.where(hot[a:b], keys[a:b], 0).astype("<u8").tobytes() if hot[a:b].any() else None for a, b in zip(cuts, ends, strict=True)]
        return pa.RecordBatch.from_arrays([
            pa.array(part[cuts].astype(np.int64)), pa.array([short[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
            pa.array([planes(owners[a:b]) for a, b in zip(cuts, ends, strict=True)], pa.binary()), pa.array(whole, pa.binary())],
            names=["part", "keys", "docs", "hot"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_ids, seen = np.array(sorted(spread.value), np.int64), _Seen()
        held, size = [], 0
        for batch in batches:
            for ids, null, values, offsets in _sets(batch):
                usable = ~null & (np.diff(offsets) > 0)
                names = ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
                n = np.diff(offsets)
                for docs_, keys, at in document_keys(values, offsets, seen.fresh(_digests(values, offsets), usable)):
                    content = content_ids(keys, heavy_parts)
                    heavy_ = _bit_set(last.value, bits, mixed(content.astype(np.uint64)))
                    place = heavy_.astype(np.uint64) << np.uint64(63) | keys >> np.uint64(1)
                    first = [a + (np.argpartition(place[a:b], d)[: d + 1] if b - a > d + 1 else np.arange(b - a))
                             for a, b, d in zip(at[:-1], at[1:], n[docs_] // 3, strict=True)]
                    taken = np.concatenate(first)
                    held.append((keys[taken], np.repeat(names[docs_], [len(x) for x in first]), np.isin(content[taken], hot_ids)))
                    size += len(taken)
                if size > 500_000:
                    yield blocks(*[np.concatenate(x) for x in zip(*held, strict=True)])
                    held, size = [], 0
        if held:
            yield blocks(*[np.concatenate(x) for x in zip(*held, strict=True)])
        held = []
        give_back()

    def grouped(part, raw) -> pa.RecordBatch:
        keys = np.concatenate([np.frombuffer(x[0].as_buffer(), "<u4") for x in raw])
        owners = np.concatenate([from_planes(x[1].as_buffer()) for x in raw])
        whole = np.concatenate([np.frombuffer(x[2].as_buffer(), "<u8") if x[2].is_valid else np.zeros(x[0].as_buffer().size // 4, np.uint64) for x in raw])
        order = np.lexsort((owners, keys))
        keys, owners, whole = keys[order], owners[order], whole[order]
        fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])])
        keys, owners, whole = keys[fresh], owners[fresh], whole[fresh]
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(start, len(keys)))
        hot = np.maximum.reduceat(whole, start)
        content = np.add.reduceat(mixed(owners.astype(np.uint64)), start)
        many = np.flatnonzero((size > 1) | (hot > 0))
        _, one = np.unique(np.stack([content[many], hot[many]]), axis=1, return_index=True) if len(many) else (None, many)
        kept = many[one]
        sizes = size[kept]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        members = owners[np.repeat(start[kept] - ends[:-1], sizes) + np.arange(ends[-1])]
        names = np.where(hot[kept] > 0, hot[kept], mixed(content[kept] ^ np.uint64(part + 1))).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(hot[kept] > 0), pa.LargeListArray.from_arrays(ends, pa.array(members)).cast(pa.list_(pa.int64()))], names=["bucket", "hot", "members"])

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, raw = None, []
        for batch in batches:
            for row in zip(batch["part"].to_pylist(), *[batch[c] for c in ("keys", "docs", "hot")], strict=True):
                if row[0] != here and raw:
                    yield grouped(here, raw)
                    raw = []
                here = row[0]
                raw.append(row[1:])
        if raw:
            yield grouped(here, raw)
        raw = []
        give_back()

    keyed = docs.mapInArrow(emit, "part long, keys binary, docs binary, hot binary")
    dealt = keyed.repartition(max(partitions(spark), min(n_parts, 10 * partitions(spark))), "part").sortWithinPartitions("part")
    found = dealt.mapInArrow(group, "bucket long, hot boolean, members array<long>")
    # equal groups of different parts are one; the parts of a hot key all stay
    found = found.groupBy("hot", "members", F.when(F.col("hot"), F.col("bucket")).alias("own")).agg(F.min("bucket").alias("bucket"))
    return stored(found.select("bucket", "hot", "members"), "jaccard-buckets")


def document_info(scan: DataFrame) -> DataFrame:
    """Stored (doc_id, n, rep, s0..s7): rep is the smallest id of the
    documents with the same set, the document itself where the set is empty."""
    rows = scan.select("doc_id", "n", "d1", "d2", "sketch")
    reps = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"))
    words = [F.conv(F.hex(F.substring("sketch", 8 * i + 1, 8)), 16, -10).cast("long").alias(f"s{i}") for i in range(SKETCH_WORDS)]
    out = rows.join(reps.hint("merge"), ["d1", "d2", "n"], "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("rep", "doc_id"))
    return stored(out.select("doc_id", "n", own.alias("rep"), *words), "jaccard-info")


def _fits(a: str, b: str):
    """What every linked pair satisfies: sizes, and Hamming distance of the
    folded sketches against the largest symmetric difference."""
    col = lambda x, c: F.col(f"{x}.{c}")
    hamming = reduce(lambda x, y: x + y, [F.bit_count(col(a, f"s{i}").bitwiseXOR(col(b, f"s{i}"))) for i in range(SKETCH_WORDS)])
    na, nb = col(a, "n"), col(b, "n")
    return (4 * F.least(na, nb) >= 3 * F.greatest(na, nb)) & (7 * hamming <= na + nb)


def _joined(pairs: DataFrame, ends: DataFrame, name: str) -> DataFrame:
    """pairs with the ends' (id, value) as x and y; the side of the pairs, on
    which an id can be hot, can be split."""
    met = pairs.join(ends.select(F.col("id").alias("b"), F.col(name).alias("y")).hint("merge"), "b")
    return met.join(ends.select(F.col("id").alias("a"), F.col(name).alias("x")).hint("merge"), "a").select("a", "b", "x", "y")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()


def plausible(scan: DataFrame, pairs: DataFrame) -> DataFrame:
    """Stored (a, b): the pairs whose wide sketches, if both have one, differ
    in few enough bits."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [not x.is_valid or not y.is_valid or 7 * wide_distance(x.as_buffer(), y.as_buffer()) <= m + n
                    for x, y, m, n in zip(*[pc.struct_field(batch[c], f) for c, f in (("x", "s"), ("y", "s"))],
                                          *[pc.struct_field(batch[c], "n").to_pylist() for c in ("x", "y")], strict=True)]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # a fixed-size filter keeps the sketches of documents in no pair where they are
    bits, words = _wanted(stored(_ends(pairs), "jaccard-met"))
    sent = scan.sparkSession.sparkContext.broadcast(words)  # at most BLOOM_BITS bits

    @F.arrow_udf("boolean")
    def in_a_pair(place: pa.Array) -> pa.Array:
        return pa.array(_may_hold(sent.value, bits, place))

    rows = scan.where(in_a_pair(F.xxhash64("doc_id"))).select(F.col("doc_id").alias("id"), F.struct(F.col("n"), F.col("wide").alias("s")).alias("v"))
    return stored(_joined(pairs, rows, "v").mapInArrow(compare, "a long, b long").distinct(), "jaccard-plausible")


def _bits(rows: DataFrame, place: F.Column) -> tuple[int, np.ndarray]:
    """(bits, words): a filter of hashes, sized to their number up to BLOOM_BITS."""
    bits = min(BLOOM_BITS, 1 << max(10, (16 * rows.count()).bit_length()))
    rows = rows.select(place.bitwiseAND(F.lit(bits - 1)).alias("p"))
    rows = rows.selectExpr("shiftright(p, 6) AS w", "shiftleft(1L, cast(p & 63L AS int)) AS b").groupBy("w").agg(F.bit_or("b").alias("b"))
    words = np.zeros(bits // 64, np.int64)
    for r in rows.toArrow().to_batches():
        words[r["w"].to_numpy()] = r["b"].to_numpy()
    return bits, words.view(np.uint64)


def _bit_set(words: np.ndarray, bits: int, place: np.ndarray) -> np.ndarray:
    at = place & np.uint64(bits - 1)
    return ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def _wanted(ids: DataFrame) -> tuple[int, np.ndarray]:
    return _bits(ids, F.xxhash64("id"))


def _may_hold(words: np.ndarray, bits: int, place: pa.Array) -> np.ndarray:
    return _bit_set(words, bits, place.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def without_ids(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs but the rows whose doc_id is in `gone` (a stored table of ids).  A
    fixed-size filter tells most rows apart where they are; only rows that it
    may hold meet the ids in a join, so the other texts are not shuffled."""
    bits, words = _wanted(gone.select(F.col("doc_id").alias("id")))
    sent = docs.sparkSession.sparkContext.broadcast(words)  # at most BLOOM_BITS bits

    @F.arrow_udf("boolean")
    def may_go(place: pa.Array) -> pa.Array:
        return pa.array(_may_hold(sent.value, bits, place))

    rows = docs.select(F.struct("*").alias("_row"), "doc_id", may_go(F.xxhash64("doc_id")).alias("_may_go"))
    doubtful = rows.where("_may_go").join(gone.select("doc_id"), "doc_id", "left_anti")
    return rows.where("NOT _may_go").select("_row.*").unionByName(doubtful.select("_row.*"))


def verified(docs: DataFrame, scan: DataFrame, pairs: DataFrame) -> DataFrame:
    """Stored (a, b, inter, total): the pairs whose sets are similar enough,
    with the sizes of intersection and union.  Sets are made for the ends of
    plausible pairs (a fixed-size filter says which documents can be one)."""
    pairs = plausible(scan, pairs)
    bits, words = _wanted(stored(_ends(pairs), "jaccard-ends"))
    wanted = docs.sparkSession.sparkContext.broadcast(words)  # at most BLOOM_BITS bits

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, values, offsets in _sets(batch.filter(pa.array(_may_hold(wanted.value, bits, batch["place"])))):
                yield pa.RecordBatch.from_arrays([ids, pa.array([values[a:b].astype("<u8").tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())], names=["id", "set"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, x, y in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["x"], batch["y"], strict=True):
                both = np.concatenate([np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")])
                both.sort()
                inter = int((both[1:] == both[:-1]).sum())
                total = len(both) - inter
                if 100 * inter >= 75 * total and total:
                    out.append((a, b, inter, total))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(4)], names=["a", "b", "inter", "total"])

    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("doc_id").alias("place"))
    own = stored(rows.mapInArrow(sets, "id long, set binary"), "jaccard-sets")
    return stored(_joined(pairs, own, "set").mapInArrow(compare, "a long, b long, inter long, total long").distinct(), "jaccard-links")


def _candidates(members: DataFrame, apart) -> DataFrame:
    """Distinct pairs of different representatives in a bucket that pass the
    bounds; the pairs of a bucket are tested inside the join."""
    a, b = members.alias("a"), members.alias("b")
    on = (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.rep") < F.col("b.rep")) & _fits("a", "b")
    on = on & apart if apart is not None else on
    return a.join(b.hint("merge"), on).select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct()


class JaccardJoin:
    """The join over documents (doc_id, text): `pairs()` gives every linked
    pair of different texts' representatives, `components()` a row per document."""

    def __init__(self, docs: DataFrame, part_keys: int = PART_KEYS, hot_keys: int = HOT_KEYS):
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        self.scan = scan = scanned(self.docs)
        self.info = document_info(scan)
        chunks, keys = self.info.agg(F.sum("n"), F.sum(F.floor(F.col("n") / 3) + 1)).first()
        heavy, parts = heavy_contents(self.docs, 2 * int(chunks or 0), part_keys, min(HEAVY, hot_keys))
        self.buckets = buckets(self.docs, heavy, parts, int(keys or 0), part_keys, hot_keys)

    def _members(self) -> DataFrame:
        """(bucket, hot, rep, n, s0..s7), each representative of a bucket once."""
        rows = self.buckets.select("bucket", "hot", F.explode("members").alias("doc_id"))
        info = self.info.where("doc_id IS NOT NULL AND n > 0")
        return rows.join(info.hint("merge"), "doc_id").drop("doc_id").distinct()

    def pairs(self) -> DataFrame:
        """(a, b, inter, total), a < b."""
        return verified(self.docs, self.scan, _candidates(self._members(), None))

    def components(self) -> DataFrame:
        """(doc_id, n_shingles, component_id) for every document."""
        info = self.info.where("doc_id IS NOT NULL AND n > 0")
        reps = info.where("doc_id = rep").dropDuplicates(["doc_id"]).drop("doc_id")
        # every member against the smallest of its bucket (of all parts of a hot one)
        to_rep = info.select("doc_id", "rep")
        hubs = self.buckets.select(F.when(F.col("hot"), F.col("bucket")).alias("bucket"), F.array_min("members").alias("hub"), "members")
        inside = hubs.select("hub", F.explode("members").alias("other")).where("hub <> other")
        wide = hubs.where("bucket IS NOT NULL")
        least = wide.groupBy("bucket").agg(F.min("hub").alias("least"))
        across = wide.join(least, "bucket").where("hub <> least").select(F.col("least").alias("hub"), F.col("hub").alias("other"))
        stars = inside.unionByName(across).distinct()
        stars = stars.join(to_rep.select(F.col("doc_id").alias("hub"), F.col("rep").alias("x")).hint("merge"), "hub")
        stars = stars.join(to_rep.select(F.col("doc_id").alias("other"), F.col("rep").alias("y")).hint("merge"), "other")
        stars = stars.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        ends = stars.alias("p").join(reps.alias("l").hint("merge"), F.col("p.a") == F.col("l.rep")).join(reps.alias("r").hint("merge"), F.col("p.b") == F.col("r.rep"))
        stars = stored(ends.where(_fits("l", "r")).select("p.a", "p.b"), "jaccard-stars")
        links = verified(self.docs, self.scan, stars)
        known = stored(connected_components(links), "jaccard-known")
        # members of a bucket that the stars left apart, against each other
        slim = self.buckets.select("bucket", F.explode("members").alias("doc_id")).join(to_rep.hint("merge"), "doc_id").select("bucket", "rep").distinct()
        slim = slim.join(known.hint("merge"), F.col("rep") == F.col("node"), "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
        slim = stored(slim, "jaccard-slim")
        split = slim.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("bucket")
        apart = slim.join(split, "bucket").join(reps.hint("merge"), "rep")
        rest = _candidates(stored(apart, "jaccard-apart"), F.col("a.component") != F.col("b.component"))
        rest = rest.join(stars, ["a", "b"], "left_anti")
        more = verified(self.docs, self.scan, stored(rest, "jaccard-rest"))
        final = connected_components(links.select("a", "b").unionByName(more.select("a", "b")))
        out = self.info.join(final.hint("merge"), F.col("rep") == F.col("node"), "left")
        return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))


def op1_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return JaccardJoin(table(spark, sf_dir, "documents", "doc_id", "text")).components()
