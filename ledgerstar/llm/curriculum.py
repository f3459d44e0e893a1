"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and so a target number of words; over training time
t in [0, 1] its share follows a ramp 1 + a(2t - 1) whose integral is one, so
its cumulative demand is target * (t + a(t*t - t)).  Documents of a source
stand in a fixed pseudo-random order, pass after pass; inverting the demand at
the words that stand before a document gives its training position, and the
mix is range-sorted by position.

Defined results: a null text has size 0 and is never taken; a null source is a
source of its own, last in order; targets are capped at `max_passes` times a
source's size and the excess goes to the others by weight; the last document
of a partial pass is cut, so that a source takes its rounded target exactly;
rows equal in id and size are interchangeable; an empty table gives an empty
result; columns named like the ones added here are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .shared import SPACE, partitions, table, without, word_count

WEIGHTS = (1, 2, 3)
RAMPS = (-0.5, 0.0, 0.5)
MAX_PASSES = 3
ADDED = ("source_size", "target", "taken", "before", "quota", "ramp")


def source_targets(sizes: DataFrame, weights=WEIGHTS, ramps=RAMPS, max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per source from (source, source_size): target (double), quota
    (target in whole words) and ramp.

    Sources in order of cap / weight are capped until the share of the rest
    fits under every cap; windows run over one row per source only.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("_n") % len(xs) + 1).cast("int"))
    s = sizes.withColumn("_n", rank).withColumn("_w", pick(weights).cast("long")).withColumn("ramp", pick(ramps).cast("double"))
    s = s.withColumn("_cap", F.col("source_size") * max_passes)
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), "_n")
    prior, every = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s = s.withColumn("_left", F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(prior), F.lit(0)))
    s = s.withColumn("_rest", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(prior), F.lit(0)))
    s = s.withColumn("_k", F.row_number().over(by_cap))
    s = s.withColumn("_free", F.min(F.when(F.col("_left") * F.col("_w") <= F.col("_cap") * F.col("_rest"), F.col("_k"))).over(every))
    level = [F.max(F.when(F.col("_k") == F.col("_free"), F.col(c))).over(every) for c in ("_left", "_rest")]
    share = level[0].cast("double") * F.col("_w") / level[1]
    s = s.withColumn("target", F.when(F.col("_k") < F.col("_free"), F.col("_cap").cast("double")).otherwise(share))
    return s.select("source", "source_size", "target", F.floor(F.col("target") + F.lit(0.5)).cast("long").alias("quota"), "ramp")


def mixed(df: DataFrame, id_col: str = "doc_id", source: str = "source", size: str = "_size",
          weights=WEIGHTS, ramps=RAMPS, max_passes: int = MAX_PASSES, digits: int = 3) -> DataFrame:
    """df plus source_size, target, quota, ramp, `before` (words of the source
    that stand before the row) and `taken`.

    A source's order is that of the md5 of the id; rows are grouped by source
    and the first hex digits of it, so a hot source is spread over 16**digits
    groups; the groups' sums (one row each) give every group its start.
    """
    df = without(df, *ADDED)
    # the source without nulls (and whether it is one), so that the window and
    # the join below need one and the same shuffle of the rows
    key = ["_s", "_z", "_b"]
    rows = df.select("*", F.coalesce(F.col(source), F.lit("")).alias("_s"), F.col(source).isNull().alias("_z"),
                     F.coalesce(F.md5(F.col(id_col).cast("string")), F.lit("")).alias("_h"))
    rows = rows.withColumn("_b", F.substring("_h", 1, digits))
    groups = rows.groupBy(*key).agg(F.sum(size).alias("_g"))
    starts = groups.withColumn("_g0", F.coalesce(F.sum("_g").over(Window.partitionBy("_s", "_z").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    name = F.when(~F.col("_z"), F.col("_s"))
    targets = source_targets(groups.groupBy(name.alias("source")).agg(F.sum("_g").alias("source_size")), weights, ramps, max_passes)
    starts = starts.join(targets, name.eqNullSafe(F.col("source"))).select(*key, "_g0", "source_size", "target", "quota", "ramp")
    run = Window.partitionBy(*key).orderBy("_h", F.col(id_col), F.col(size)).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_run", F.coalesce(F.sum(size).over(run), F.lit(0)))
    out = rows.join(starts, key)
    out = out.withColumn("before", F.col("_g0") + F.col("_run"))
    whole = F.expr("CASE WHEN source_size > 0 THEN quota div source_size ELSE 0L END")
    part = F.expr("CASE WHEN source_size > 0 THEN quota % source_size ELSE 0L END")
    last = F.least(F.greatest(part - F.col("before"), F.lit(0)), F.col(size))
    out = out.withColumn("taken", whole * F.col(size) + last)
    return out.drop(*key, "_h", "_g0", "_run")


def position(demand, ramp):
    """Time at which a source's cumulative demand reaches the share `demand`
    of its target: the root in [0, 1] of ramp t^2 + (1 - ramp) t = demand."""
    flat = F.lit(1.0) - ramp
    root = F.sqrt(flat * flat + F.lit(4.0) * ramp * demand)
    return F.when(demand > 0, F.lit(2.0) * demand / (flat + root)).otherwise(F.lit(0.0))


def occurrences(mix: DataFrame, size: str = "_size") -> DataFrame:
    """One row per pass of a taken row: epoch, take_words (less than the size
    only where a partial pass cuts it) and position in [0, 1)."""
    taken = mix.where(F.col("taken") > 0).withColumn(
        "epoch", F.explode(F.expr(f"sequence(0L, (taken + `{size}` - 1) div `{size}` - 1)")))
    demand = (F.col("epoch") * F.col("source_size") + F.col("before")).cast("double") / F.col("quota")
    return taken.withColumn("take_words", F.least(F.col(size), F.col("taken") - F.col("epoch") * F.col(size))).withColumn(
        "position", position(demand, F.col("ramp")))


def range_sorted(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartitionByRange(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)


def first_words(text, words):
    """The text up to the end of its word number `words` (its whole, when it
    has no more words than that)."""
    lead = F.when(F.regexp_like(text, F.lit(f"^{SPACE}")), 1).otherwise(0)
    rest = F.split(text, f"{SPACE}+", (words + lead + 1).cast("int"))
    tail = F.when(F.size(rest) > words + lead, F.length(F.element_at(rest, -1))).otherwise(0)
    return F.regexp_replace(F.substring(text, F.lit(1), F.length(text) - tail), f"{SPACE}+$", "")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: documents, one row per pass, in training order, the cut
    ones with their first words only; the columns of the input."""
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", "source", word_count(F.col("text")).alias("_size"))
    mix = range_sorted(occurrences(mixed(rows)), "position", "doc_id", "epoch")
    text = F.col("_row.text")
    cut = F.when(F.col("take_words") < F.col("_size"), first_words(text, F.col("take_words"))).otherwise(text)
    return mix.select(*[cut.alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def op9_query(spark, sf_dir: str) -> DataFrame:
    slim = table(spark, sf_dir, "documents", "doc_id", "source", "text").select("doc_id", "source", word_count(F.col("text")).alias("_size"))
    mix = mixed(slim)
    first = position(F.col("before").cast("double") / F.col("quota"), F.col("ramp"))
    out = mix.withColumn("position_ppm", F.when(F.col("taken") > 0, F.floor(first * 1000000.0)).cast("long"))
    out = range_sorted(out, "position_ppm", "doc_id")
    return out.select("doc_id", F.col("_size").alias("size"), "source_size", "target", "taken", "position_ppm")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS n FROM d GROUP BY source
), w AS (
  SELECT *, (n % 3 + 1)::BIGINT AS weight, 3 * source_size AS cap, (n % 3 - 1) * 0.5::DOUBLE AS ramp FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / weight, n) AS k,
    sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap::DOUBLE / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
  FROM w
), f AS (
  SELECT min(k) AS free FROM o WHERE remaining * weight <= cap * rest
), t AS (
  SELECT o.source, o.source_size, o.ramp,
    CASE WHEN o.k < f.free THEN o.cap::DOUBLE ELSE l.remaining::DOUBLE * o.weight / l.rest::DOUBLE END AS target
  FROM o, f, o AS l WHERE l.k = f.free
), q AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.ramp, floor(t.target + 0.5)::BIGINT AS quota,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY coalesce(md5(d.doc_id::VARCHAR), ''), d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN (quota // source_size) * size + least(greatest(quota % source_size - before, 0), size) ELSE 0 END AS taken,
    before::DOUBLE / quota AS demand
  FROM q
)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
  CASE WHEN taken > 0 THEN floor((CASE WHEN demand > 0 THEN 2.0::DOUBLE * demand / ((1.0::DOUBLE - ramp) + sqrt((1.0::DOUBLE - ramp) * (1.0::DOUBLE - ramp) + 4.0::DOUBLE * ramp * demand)) ELSE 0.0::DOUBLE END) * 1000000.0::DOUBLE)::BIGINT END AS position_ppm
FROM r
"""
