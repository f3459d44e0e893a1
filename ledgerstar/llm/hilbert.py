"""Sharding along a Hilbert curve for multidimensional file pruning.

Several metadata dimensions are quantised to a few bits each, a row's place
on the Hilbert curve over that grid is its sort key, and the sorted order is
cut into runs.  Rows near each other in all dimensions land in the same file,
so min/max statistics of any of the dimensions prune files.

Defined results: a null in a dimension has a cell of its own (code 0); a null
or empty text has size 8; ties on the curve are broken by the tie columns, and
rows equal in all of them are interchangeable; an empty table gives an empty
result; columns named like the ones added here are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .shared import partitions, stored, without

BITS = 5


def hilbert_index(codes: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points given as (n, dims) grid codes.

    The curve is entered from the coarsest bit downwards: where a bit is set
    the lower bits of the first axis are reflected, elsewhere they are swapped
    with the axis at hand; a Gray code over the result orders the cells.
    """
    x = [codes[:, i].astype(np.int64).copy() for i in range(codes.shape[1])]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for axis in range(len(x)):
            here = (x[axis] & bit) != 0
            swap = np.where(here, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(here, low, swap)
            x[axis] ^= swap
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1, (1 << level) - 1, 0)
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            out = (out << 1) | (((x[axis] ^ flip) >> level) & 1)
    return out


def _text_cuts(df: DataFrame, dim: Column, n_cuts: int) -> list[str]:
    """At most n_cuts whole texts that part the rows into near equal runs: all
    texts, if there are no more.  Rows are counted per distinct text; running
    counts are a task's own plus those of the tasks before it."""
    counts = df.select(dim.alias("v")).where("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.repartitionByRange(partitions(df.sparkSession), "v").withColumn("part", F.spark_partition_id())
    counts = stored(counts, "texts")
    parts = {r["part"]: (r["n"], r["k"]) for r in counts.groupBy("part").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect()}
    total, texts = (sum(x[i] for x in parts.values()) for i in (0, 1))
    if texts <= n_cuts:
        return sorted((r["v"] for r in counts.select("v").collect()), key=str.encode)
    before, ahead = {}, 0
    for part in sorted(parts):
        before[part], ahead = ahead, ahead + parts[part][0]
    starts = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])  # one number a task
    upto = starts[F.col("part")] + F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    share = lambda c: F.floor(c * F.lit(n_cuts) / F.lit(total))
    crossing = counts.withColumn("_upto", upto).where(share(F.col("_upto")) > share(F.col("_upto") - F.col("n")))
    return sorted((r["v"] for r in crossing.select("v").collect()), key=str.encode)


def quantised(df: DataFrame, dims: list[Column], bits: int = BITS) -> list[Column]:
    """One code column per dimension: 0 for null, else 1 + the number of
    cuts at or below the whole value.  Cuts are quantiles over all rows, at most
    2**bits - 2 values a dimension."""
    n_cuts = (1 << bits) - 2
    at = [(i + 1) / (n_cuts + 1) for i in range(n_cuts)]
    kinds = [f.dataType for f in df.select(*[d.alias(f"d{i}") for i, d in enumerate(dims)]).schema.fields]
    numbers = [i for i, kind in enumerate(kinds) if not isinstance(kind, T.StringType)]
    found = df.select(*[F.percentile_approx(dims[i], at, 2000).alias(f"c{i}") for i in numbers]).first() if numbers else None
    codes = []
    for i, (d, kind) in enumerate(zip(dims, kinds, strict=True)):
        edges = sorted(set(found[f"c{i}"] or [])) if i in numbers else _text_cuts(df, d, n_cuts)
        above = F.lit(1)
        for e in edges:
            above = above + (d >= F.lit(e).cast(kind)).cast("int")
        none = d.isNull() | F.isnan(d) if isinstance(kind, (T.DoubleType, T.FloatType)) else d.isNull()
        codes.append(F.when(none, 0).otherwise(above).cast("int"))
    return codes


def _curve(bits: int):
    @F.pandas_udf(T.LongType())
    def curve(codes: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(codes.to_numpy(), bits))

    return curve


def hilbert_shards(df: DataFrame, dims: list[Column], ties: list[str], n_shards: int,
                   law: str = "rows", size: str | None = None, bits: int = BITS) -> DataFrame:
    """df plus curve (long), shard (int) and slot (long, gapless from 0).

    law `rows` cuts runs whose row counts are at most one apart; law `bytes`
    cuts where the running sum of the size column passes a shard's share.
    Rows are range-partitioned on (curve, ties), so a hot cell is spread over
    as many tasks as it needs; ranks are a task's own row numbers plus the
    counts of the tasks before it, one small row per task.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"unknown law {law}")
    spark = df.sparkSession
    keys = ["_hs_curve", *ties]
    codes = F.struct(*[c.alias(f"d{i}") for i, c in enumerate(quantised(df, dims, bits))])
    ordered = (
        df.withColumn("_hs_curve", _curve(bits)(codes))
        .repartitionByRange(partitions(spark), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_hs_part", F.spark_partition_id())
        .withColumn("_hs_seq", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    ordered = stored(ordered, "hilbert")
    weight = F.sum(F.col(size)) if law == "bytes" else F.count(F.lit(1))
    per_part = ordered.groupBy("_hs_part").agg(F.count(F.lit(1)).alias("_hs_n"), weight.alias("_hs_w"))
    before = Window.orderBy("_hs_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    # one row per shuffle partition: bounded by the number of partitions
    starts = per_part.select(
        "_hs_part",
        F.coalesce(F.sum("_hs_n").over(before), F.lit(0)).alias("_hs_rank0"),
        F.coalesce(F.sum("_hs_w").over(before), F.lit(0)).alias("_hs_w0"),
        F.sum("_hs_n").over(every).alias("_hs_rows"),
        F.sum("_hs_w").over(every).alias("_hs_total"),
    )
    ranked = ordered.join(F.broadcast(starts), "_hs_part").withColumn("_hs_rank", F.col("_hs_rank0") + F.col("_hs_seq"))
    k = F.lit(n_shards).cast("long")
    if law == "rows":
        shard = F.expr(f"(_hs_rank * {n_shards}L) div _hs_rows")
        first = F.expr(f"(shard * _hs_rows + {n_shards - 1}L) div {n_shards}L")
        out = ranked.withColumn("shard", shard).withColumn("slot", F.col("_hs_rank") - first)
    else:
        run = Window.partitionBy("_hs_part").orderBy("_hs_seq").rowsBetween(Window.unboundedPreceding, -1)
        reached = F.col("_hs_w0") + F.coalesce(F.sum(F.col(size)).over(run), F.lit(0))
        ranked = ranked.withColumn("shard", F.least(F.floor(reached * k / F.greatest(F.col("_hs_total"), F.lit(1))), k - 1))
        firsts = ranked.groupBy("shard").agg(F.min("_hs_rank").alias("_hs_first"))  # n_shards rows
        out = ranked.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("_hs_rank") - F.col("_hs_first"))
    own = [F.col(f"`{c}`") for c in without(df, "curve", "shard", "slot").columns]
    return out.select(*own, F.col("_hs_curve").alias("curve"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the sharded rows as one folder per shard, each sorted by slot, so
    that row-group statistics follow the curve."""
    n = partitions(sharded.sparkSession)
    sharded.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def document_dims() -> list[Column]:
    """The metadata dimensions documents are pruned by."""
    return [F.col("lang"), F.col("source"), F.col("size"), F.col("doc_id")]


def op2_query(spark, sf_dir: str, n_shards: int = 24) -> DataFrame:
    from .shared import table

    text = F.coalesce(F.col("text"), F.lit(""))
    slim = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source").select(
        "doc_id", "lang", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    out = hilbert_shards(slim, document_dims(), ["doc_id", "text_crc32", "size"], n_shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("curve"))
