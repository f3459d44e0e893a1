"""Document fingerprints: bottom-k sketches of shingle hashes, in SQL functions.

A document's shingles are its runs of five words (A-Z lower-cased; with fewer
words, the whole sequence); the sketch holds the k smallest of their 48-bit
hashes in ascending order.  Sketches of parts merge into the sketch of the
whole, and two sketches estimate resemblance, containment and the number of
distinct shingles.

Defined results: a null text is empty; a text without words has an empty
sketch, alike (1.0) to another empty one and unlike (0.0) all others; rows with
equal ids follow each other by text; a null id comes after all others; an empty
table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import SPACE, partitions, table

K = 128
HASH_BITS = 48


def with_sketch(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """df plus `name`, the bottom-k sketch (array<long>) of a text column.
    Words, word hashes and shingle hashes are columns of their own, so each is
    computed once a row and not once per use."""
    words, hashes = f"_{name}_w", f"_{name}_h"
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    out = df.withColumn(words, F.split(F.regexp_replace(lower, f"^{SPACE}+|{SPACE}+$", ""), f"{SPACE}+"))
    out = out.withColumn(hashes, F.expr(f"CASE WHEN {words}[0] = '' THEN cast(array() AS array<bigint>) ELSE transform({words}, w -> xxhash64(w)) END"))
    shift = 64 - HASH_BITS
    out = out.withColumn(hashes, F.expr(
        f"CASE WHEN size({hashes}) >= 5 THEN transform(slice({hashes}, 1, size({hashes}) - 4), (h, i) -> shiftrightunsigned("
        f"xxhash64(h, {hashes}[i + 1], {hashes}[i + 2], {hashes}[i + 3], {hashes}[i + 4]), {shift})) "
        f"WHEN size({hashes}) > 0 THEN array(shiftrightunsigned(xxhash64({hashes}), {shift})) ELSE {hashes} END"))
    out = out.withColumn(name, F.slice(F.sort_array(F.array_distinct(F.col(hashes))), 1, k))
    return out.drop(words, hashes)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two documents (or parts)."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merged_by(df: DataFrame, key: str, sketch: str, k: int = K) -> DataFrame:
    """One sketch per key.  Hashes are made distinct and cut to the k smallest
    map-side (a rank limit), so a hot key ships at most k hashes a task."""
    hashes = df.select(F.col(key), F.explode(sketch).alias("_h")).distinct()
    rank = F.row_number().over(Window.partitionBy(key).orderBy("_h"))
    least = hashes.withColumn("_r", rank).where(F.col("_r") <= k)
    return least.groupBy(key).agg(F.sort_array(F.collect_list("_h")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of the union's bottom k that both sketches hold: 0 to 1, exact
    where the union has at most k shingles."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b))).cast("double")
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k."""
    kth = F.element_at(a, k).cast("double") / float(1 << HASH_BITS)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / kth)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds (1.0 for an empty a)."""
    share = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k) / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0)))


def printable(a: Column) -> Column:
    """The sketch as text: base64 (without line ends) of its hashes at six
    bytes each."""
    return F.translate(F.base64(F.unhex(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), HASH_BITS // 4, "0")), ""))), "\r\n", "")


def _range_bucket(df: DataFrame, key: str, edges: list[int]) -> DataFrame:
    """df plus `_b`, the number of edges at or below the key (0 for null), by
    binary search: one projection per bit of the number of edges."""
    out = df.withColumn("_b", F.lit(0))
    if not edges:
        return out
    array = F.lit([int(e) for e in edges]).cast("array<bigint>")
    step = 1 << (len(edges).bit_length() - 1)
    while step:
        at = F.col("_b") + step
        hit = (at <= len(edges)) & (F.col(key) >= F.try_element_at(array, F.least(at, F.lit(len(edges))).cast("int")))
        out = out.withColumn("_b", F.when(hit, at).otherwise(F.col("_b")))
        step >>= 1
    return out


def with_next(df: DataFrame, ids: DataFrame, key: str, carried: list[str], heads_of) -> DataFrame:
    """df plus next_<c> for the carried columns: those of the row that follows
    in descending order of key (after the last row: of the first).

    Rows are dealt to ranges of the key (cut at quantiles of all keys) and meet
    their successor in a window inside the range; each range also gets, as its
    last row, a copy of the row that heads the next lower range.  So the texts
    are shuffled once and no task sees more than its range.  `ids` has the keys
    alone; heads_of(small) gives the full rows of a few keys.
    """
    n = partitions(df.sparkSession)
    at = [(i + 1) / n for i in range(n - 1)]
    edges = sorted(set(ids.select(F.percentile_approx(key, at, 10000).alias("e")).first().e or [])) if at else []
    tops = _range_bucket(ids, key, edges).groupBy("_b").agg(F.max(key).alias("_top"))
    # one row per range: at most as many as there are shuffle partitions
    following = F.coalesce(F.lag("_top").over(Window.orderBy("_b")), F.max("_top").over(Window.partitionBy()))
    first_range = F.lag("_b").over(Window.orderBy("_b")).isNull()
    tops = tops.select("_b", F.when(first_range, F.max("_top").over(Window.partitionBy())).otherwise(following).alias("_head"))
    heads = heads_of(tops.select("_head").distinct()).groupBy(key).agg(F.max(F.struct(*carried)).alias("_c"))
    heads = tops.join(heads, F.col("_head").eqNullSafe(F.col(key))).select("_b", key, F.lit(1).alias("_end"), *[F.col(f"_c.{c}").alias(c) for c in carried])
    rows = _range_bucket(df, key, edges).withColumn("_end", F.lit(0))
    order = Window.partitionBy("_b").orderBy("_end", F.col(key).desc_nulls_last(), *[F.col(c).desc() for c in carried])
    both = rows.unionByName(heads)
    for c in carried:
        both = both.withColumn(f"next_{c}", F.lead(c).over(order))
    return both.where("_end = 0").drop("_b", "_end")


def op7_query(spark, sf_dir: str, k: int = K) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("text", F.coalesce(F.col("text"), F.lit("")))

    def heads_of(small: DataFrame) -> DataFrame:  # at most one key per shuffle partition
        return with_sketch(docs.join(F.broadcast(small), docs.doc_id.eqNullSafe(small["_head"]), "left_semi"), "text", "s", k)

    rows = with_next(with_sketch(docs, "text", "s", k), table(spark, sf_dir, "documents", "doc_id"), "doc_id", ["text", "s"], heads_of)
    n = F.length("text").cast("long")
    rows = rows.withColumn("n_chars", n)
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - cut).cast("int")), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2(F.col("edited"), 256))
    rows = with_sketch(rows, "edited", "es", k)
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", printable(F.col("s")).alias("fingerprint"), printable(F.col("es")).alias("edited_fingerprint"),
        resemblance(F.col("s"), F.col("es"), k).alias("near_edited"), resemblance(F.col("s"), F.col("next_s"), k).alias("near_next"),
        distinct_shingles(F.col("s"), k).alias("shingles"), containment(F.col("s"), F.col("es"), k).alias("contained_edited"),
    )
