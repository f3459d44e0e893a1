"""Connected components of a table of links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for the ends of links (a, b): the smallest node that
    can be reached.

    Two kinds of rounds alternate until nothing changes: every node ties its
    larger neighbours to the smallest node it knows, then its smaller ones.
    The minimum is aggregated map-side; a node with very many neighbours meets
    its own minimum in a join whose larger side can be split.  Every round is
    a stored table, so an executor's loss repeats one round at most."""
    edges = stored(_tidy(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    before = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _tidy(_tied(both, F.col("v") > F.col("u")))
        down = large.select(F.col("v").alias("u"), F.col("u").alias("v"))  # u > v
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").where("v > m").select(F.col("m").alias("u"), "v")
        edges = stored(_tidy(small.unionByName(least.select(F.col("m").alias("u"), F.col("u").alias("v")))), "edges")
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())


def _tied(both: DataFrame, wanted) -> DataFrame:
    """(u, v): v the wanted neighbours of a node, u the smallest node that it
    or a neighbour is."""
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(wanted).select(F.col("m").alias("u"), "v")


def _tidy(edges: DataFrame) -> DataFrame:
    """Distinct edges with the smaller end first, without loops."""
    return edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
