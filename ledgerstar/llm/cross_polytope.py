"""Approximate nearest neighbours by cross-polytope hashing.

A vector is turned by fast pseudo-rotations (three rounds of random signs and
a Hadamard transform) and hashed to the nearest signed axis; `depth` such
hashes make the code of a table.  A query probes in every table the codes whose
axes are nearest to it, and candidates are reranked by their exact inner
product in double precision.  Vectors of unequal norms are first given one more
component that brings all to the largest norm, so that the largest inner
product is the smallest angle (the query gets 0 there).

The number of probes is fitted: for `TUNED` queries (a bounded sample, by hash
of their ids) the exact neighbours are found by brute force over all rows, and
the fewest probes that catch `goal` of them, by four standard errors more, are
taken; where no number of probes does, tables are added.  Every row is indexed.
A query that finds fewer than k rows that way is searched exactly.

Defined results: vectors null, zero, with a null or non-finite component, or of
another length than most, take no part; rows that repeat a vec_id are each a
candidate, once per different vector, but for rows of the query's own id; fewer than k candidates give
fewer rows; ties go to the smaller vec_id; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .shared import partitions, stored, table

TABLES = 8
TUNED = 128
GOAL = 0.97
MOST_TABLES = 64
QUERY_BLOCK, DATA_BLOCK = 4096, 32768
CODES = "table int, code long, id long, vec binary"
BEST = "query_id long, ids binary, marks binary, scores binary"
NEAREST = "query_id long, rank int, vec_id long, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        pairs = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


class CrossPolytope:
    """`tables` hashes of `depth` signed axes each over vectors of `dims`
    components padded to a power of two; `norm` > 0 evens the norms out."""

    def __init__(self, dims: int, tables: int, depth: int, norm: float = 0.0, seed: int = 7):
        self.dims, self.tables, self.depth, self.norm = dims, tables, depth, norm
        self.width = 1 << max(1, (dims + (norm > 0) - 1).bit_length())
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, depth, 3, self.width))
        self.codes = (2 * self.width) ** depth

    def _turned(self, x: np.ndarray, query: bool, t: int, k: int) -> np.ndarray:
        out = np.zeros((len(x), self.width))
        out[:, : self.dims] = x
        if self.norm and not query:
            out[:, self.dims] = np.sqrt(np.maximum(self.norm**2 - (x**2).sum(axis=1), 0))
        for signs in self.signs[t, k]:
            out = hadamard(out * signs)
        return np.concatenate([out, -out], axis=1)

    def hashed(self, x: np.ndarray, t: int) -> np.ndarray:
        """The code of every row in table t."""
        code = np.zeros(len(x), np.int64)
        for k in range(self.depth):
            code = code * 2 * self.width + self._turned(x, False, t, k).argmax(axis=1)
        return code

    def probes(self, x: np.ndarray, t: int, n: int) -> np.ndarray:
        """The n codes nearest to every query in table t, nearest first: the
        sums of the axes' shortfalls against the best axis, squared, are least."""
        n = min(n, self.codes)
        scale = np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        codes, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for k in range(self.depth):
            axes = self._turned(x, True, t, k) / scale
            short = (axes.max(axis=1, keepdims=True) - axes) ** 2
            keep = np.argsort(short, axis=1, kind="stable")[:, :n]
            short = np.take_along_axis(short, keep, axis=1)
            cost = (cost[:, :, None] + short[:, None, :]).reshape(len(x), -1)
            codes = (codes[:, :, None] * 2 * self.width + keep[:, None, :]).reshape(len(x), -1)
            best = np.argsort(cost, axis=1, kind="stable")[:, :n]
            cost, codes = np.take_along_axis(cost, best, axis=1), np.take_along_axis(codes, best, axis=1)
        return codes


def inner(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed component by component in double
    precision, so that equal vectors score equally wherever they stand."""
    out = np.zeros(len(rows))
    for j in range(rows.shape[1]):
        out += queries[:, j].astype(np.float64) * rows[:, j].astype(np.float64)
    return out


def nearest(query_ids, queries, ids, rows, k: int) -> Iterator[tuple]:
    """(query number, places, scores) of each query's k nearest rows but its own
    id.  A matrix product finds what can be among them (with a margin for its
    rounding); those are scored again by inner()."""
    rough = queries.astype(np.float64) @ rows.astype(np.float64).T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    slack = 1e-12 * np.maximum(1.0, np.abs(queries).sum(axis=1) * (np.abs(rows).max() if rows.size else 0.0))
    for i in range(len(queries)):
        line = rough[i]
        if len(line) > k:
            line_k = np.partition(line, len(line) - k)[len(line) - k]
            at = np.flatnonzero((line >= line_k - slack[i]) & (line > -np.inf))
        else:
            at = np.flatnonzero(line > -np.inf)
        if len(at):
            score = inner(np.broadcast_to(queries[i], (len(at), queries.shape[1])), rows[at])
            order = np.lexsort((ids[at], -score))[:k]
            yield i, at[order], score[order]


def _vectors(column: pa.Array, kind: str, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dims)


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary column with one row's bytes per value."""
    rows = np.ascontiguousarray(rows)
    step = rows.shape[1] * rows.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * step).astype(np.int32)), pa.py_buffer(rows)])


def _coded(valid: DataFrame, index: CrossPolytope, kind: str, n_probes: int = 0) -> DataFrame:
    """(table, code, id, vec): one row per table, for queries per probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                x, ids = _vectors(part["vec"], kind, index.dims), part["id"].to_numpy()
                for t in range(index.tables):
                    codes = index.probes(x, t, n_probes) if n_probes else index.hashed(x, t)[:, None]
                    m = codes.shape[1]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(codes.size, t, np.int32)), pa.array(codes.ravel()), pa.array(np.repeat(ids, m)), _binary(np.repeat(x, m, axis=0))], names=["table", "code", "id", "vec"])

    return valid.mapInArrow(run, CODES)


def _searched(data: DataFrame, queries: DataFrame, dims: int, kind: str, k: int) -> DataFrame:
    """The k best rows of every (query, code): (query_id, ids, scores).

    Buckets are dealt out in blocks of rows and of queries: a bucket of many
    rows becomes several blocks that each get its queries, one of many queries
    several that each get its rows, so no task holds more than a block of
    queries and a batch of rows, however hot a code is."""
    count = lambda df, name: df.groupBy("table", "code").agg(F.count(F.lit(1)).alias(name))
    sizes = count(data, "_nd").join(count(queries, "_nq"), ["table", "code"]).select(
        "table", "code", F.ceil(F.col("_nd") / DATA_BLOCK).alias("_ds"), F.ceil(F.col("_nq") / QUERY_BLOCK).alias("_qs"))
    sizes = stored(sizes, "buckets")
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
    d = data.join(sizes, ["table", "code"]).withColumn("_d", own("_ds")).withColumn("_q", each("_qs"))
    q = queries.join(sizes, ["table", "code"]).withColumn("_q", own("_qs")).withColumn("_d", each("_ds"))
    keys = ["table", "code", "_d", "_q"]
    both = q.select(*keys, F.lit(0).alias("kind"), "id", "vec").unionByName(d.select(*keys, F.lit(1).alias("kind"), "id", "vec"))
    both = both.repartition(partitions(data.sparkSession), *keys).sortWithinPartitions(*keys, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = np.stack([batch[c].to_numpy() for c in keys] + [batch["kind"].to_numpy()], axis=1)
            cuts = np.flatnonzero((cols[1:] != cols[:-1]).any(axis=1)) + 1
            out = []
            for a, b in zip([0, *cuts], [*cuts, len(cols)], strict=True):
                part = batch.slice(int(a), int(b - a))
                x = np.frombuffer(b"".join(part["vec"].to_pylist()), kind).reshape(-1, dims)
                ids, key = part["id"].to_numpy(), tuple(cols[a][:-1])
                if key != here:
                    here, held = key, []
                if cols[a][-1] == 0:
                    held.append((ids, x))
                    continue
                x, ids, marks = _each_once(x, ids)
                if len(held) > 1:
                    held = [tuple(np.concatenate(y) for y in zip(*held, strict=True))]
                for s in range(0, len(held[0][0]) if held else 0, 512):
                    for i, at, score in nearest(held[0][0][s:s + 512], held[0][1][s:s + 512], ids, x, k):
                        out.append({"query_id": int(held[0][0][s + i]), "ids": ids[at].astype("<i8").tobytes(), "marks": marks[at].tobytes(), "scores": score.astype("<f8").tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=BEST_SCHEMA)

    return both.mapInArrow(run, BEST)


BEST_SCHEMA = pa.schema([("query_id", pa.int64()), ("ids", pa.binary()), ("marks", pa.binary()), ("scores", pa.binary())])
NEAREST_SCHEMA = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _each_once(x: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, ids, marks): rows equal in id and vector once; a mark tells rows
    of one id apart by their vectors."""
    marks = np.array([xxhash.xxh3_64_intdigest(row.tobytes()) for row in x], "<u8")
    _, first = np.unique(np.stack([ids.view(np.uint64), marks]), axis=1, return_index=True)
    first.sort()
    return x[first], ids[first], marks[first]


def _merged(best: DataFrame, k: int) -> DataFrame:
    """The k best of all a query's lists, without the same row found twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def top(ids, marks, scores):
            ids, marks, scores = (np.concatenate(x) for x in (ids, marks, scores))
            _, first = np.unique(np.stack([ids.view(np.uint64), marks]), axis=1, return_index=True)
            order = first[np.lexsort((ids[first], -scores[first]))[:k]]
            return ids[order], marks[order], scores[order]

        def rows(q, held):
            found, _, score = top(*held)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), q)), pa.array(np.arange(1, len(found) + 1, dtype=np.int32)), pa.array(found), pa.array(score)], schema=NEAREST_SCHEMA)

        here, held = None, ([], [], [])
        for batch in batches:
            done = []
            for q, *lists in zip(*[batch[c].to_pylist() for c in ("query_id", "ids", "marks", "scores")], strict=True):
                if q != here:
                    if here is not None:
                        done.append(rows(here, held))
                    here, held = q, ([], [], [])
                for own, raw, kind in zip(held, lists, ("<i8", "<u8", "<f8"), strict=True):
                    own.append(np.frombuffer(raw, kind))
                if len(held[0]) > 1000:
                    held = tuple([x] for x in top(*held))
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        if here is not None:
            yield rows(here, held)

    return best.repartition(partitions(best.sparkSession), "query_id").sortWithinPartitions("query_id").mapInArrow(run, NEAREST)


def _one_bucket(valid: DataFrame) -> DataFrame:
    return valid.select(F.lit(-1).alias("table"), F.lit(0).cast("long").alias("code"), "id", "vec")


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           tables: int = TABLES, goal: float = GOAL, tuned: int = TUNED) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row for
    which is_query holds (a condition on the id), against all rows."""
    spark = vectors.sparkSession
    vec = F.col(vec_col)
    kind = "<f8" if "double" in vectors.schema[vec_col].dataType.simpleString() else "<f4"
    ok = vec.isNotNull() & F.col(id_col).isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(vec, lambda x: x != 0)
    rows = vectors.where(ok).select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), is_query.alias("_query"))
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).first()
    if lengths is None:
        return spark.createDataFrame([], NEAREST)
    dims, n = lengths["n"], lengths["count"]
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = rows.where(F.size("vec") == dims)
    norms = rows.agg(F.min(norm).alias("least"), F.max(norm).alias("most")).first()
    valid = rows.select("id", "vec")
    asked = rows.where("_query").select("id", "vec")
    uneven = norms.most if norms.least < norms.most * (1 - 1e-6) else 0.0

    packed = lambda df: _packed(df, kind, dims)
    # deeper codes as rows grow: about a thousand rows a code
    width = CrossPolytope(dims, 1, 1, uneven).width
    depth = max(1, int(np.floor(np.log(max(n, 2) / 1000) / np.log(2 * width))))
    index, probes = _fitted(valid, asked, lambda t: CrossPolytope(dims, t, depth, uneven), tables, kind, k, goal, tuned)
    best = _searched(_coded(valid, index, kind), _coded(asked, index, kind, probes), dims, kind, k)
    found = stored(_merged(best, k), "nearest")
    enough = found.groupBy("query_id").agg(F.max("rank").alias("n")).where(F.col("n") >= min(k, n - 1))
    short = asked.join(enough, asked["id"] == enough["query_id"], "left_anti")
    if short.isEmpty():
        return found
    short = stored(short, "short")
    exact = _merged(_searched(_one_bucket(packed(valid)), _one_bucket(packed(short)), dims, kind, k), k)
    return found.join(enough, "query_id", "left_semi").unionByName(exact)


def _packed(df: DataFrame, kind: str, dims: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["id"], _binary(_vectors(batch["vec"], kind, dims))], names=["id", "vec"])

    return df.mapInArrow(run, "id long, vec binary")


def _fitted(valid: DataFrame, asked: DataFrame, index_of, tables: int, kind: str, k: int, goal: float, tuned: int) -> tuple[CrossPolytope, int]:
    """(index, probes): the fewest probes that catch `goal` of the exact
    neighbours of `tuned` queries, by four standard errors more; with more
    tables where that takes too many.  Those queries and neighbours are all that
    reaches the driver.  A goal that MOST_TABLES cannot reach is an error."""
    index = index_of(tables)
    sample = asked.orderBy(F.xxhash64("id"), "id").limit(tuned).collect()
    if not sample:
        return index, 1
    q = np.array([r["vec"] for r in sample], kind)
    q_ids = np.array([r["id"] for r in sample])
    dims = index.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                x, ids = _vectors(part["vec"], kind, dims), part["id"].to_numpy()
                out = [(i, int(ids[v]), float(s)) for i, at, score in nearest(q_ids, q, ids, x, k) for v, s in zip(at, score, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate((pa.int32(), pa.int64(), pa.float64()))], names=["q", "id", "score"])

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    true = valid.mapInArrow(run, "q int, id long, score double").withColumn("_r", rank).where(F.col("_r") <= k)
    true = true.join(valid.hint("merge"), "id").select("q", "vec").collect()  # at most tuned * k rows but for repeated ids
    x, of = np.array([r["vec"] for r in true], kind), np.array([r["q"] for r in true], np.int64)
    missed = (1 - goal) * len(x)
    allowed = max(0, int(missed - 4 * np.sqrt(missed)))
    while True:
        most = min(index.codes, 4096)
        first = np.full(len(x), most)
        for t in range(index.tables):
            hit = index.probes(q, t, most)[of] == index.hashed(x, t)[:, None]
            first = np.minimum(first, np.where(hit.any(axis=1), hit.argmax(axis=1), most))
        needed = int(np.sort(first)[len(first) - 1 - allowed]) if len(first) else 0
        if needed < most:
            return index, needed + 1
        if 2 * index.tables > MOST_TABLES:
            raise RuntimeError(f"{index.tables} tables of {index.codes} codes do not catch {goal:.0%} of the tuned queries' neighbours")
        index = index_of(2 * index.tables)


def op5_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


