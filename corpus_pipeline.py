"""A corpus pipeline over the table `documents`.

Five stages, in this order: language ID (documents without a recognised
language go), quality classifier (documents below the threshold go), n-gram
Jaccard join (the document with the smallest id of each group of near copies
stays), mixing sources to target weights (rows in training order, one per
pass), packing into token sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs; all but
the last return the columns of docs.  Nulls, empty tables and repeated rows
have the results that the operators' modules state; rows without a doc_id are
never near copies of others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerstar.llm import curriculum, ecoc_langid, mil_quality, sos_packing
from ledgerstar.llm.jaccard_join import JaccardJoin, without_ids
from ledgerstar.llm.shared import shipped, stored, table


def _whole(docs: DataFrame) -> DataFrame:
    """Rows as one struct beside the columns in use, so that no operator's
    column meets one of theirs."""
    return docs.select(F.struct("*").alias("_row"), "doc_id", "text")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learn = docs.select("doc_id", "text", "lang").where(~ecoc_langid.in_fold("doc_id", 4, ecoc_langid.HELD_OUT))
    out = ecoc_langid.scored(_whole(docs), ecoc_langid.trained(learn))
    return out.where("lang_fits").select("_row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").where(~mil_quality.in_fold("doc_id", 5, mil_quality.HELD_OUT))
    out = mil_quality.scored(_whole(docs), mil_quality.trained(docs.select("doc_id", "text"), labels))
    return out.where(F.col("quality_score") >= mil_quality.THRESHOLD).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = stored(JaccardJoin(docs.select("doc_id", "text")).components(), "near-duplicates")
    gone = stored(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    left = without_ids(docs, gone)
    repeated = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return left
    # rows that share an id: the one with the smallest text stays
    rows = left.select(F.struct("*").alias("_row"), "doc_id", "text").join(repeated, "doc_id", "left_semi")
    one = rows.groupBy("doc_id").agg(F.min_by("_row", F.coalesce("text", F.lit(""))).alias("_row")).select("_row.*")
    return left.join(repeated, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(one)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return curriculum.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sos_packing.packed(docs)


STAGES = [(name, shipped(stage)) for name, stage in [
    ("language_id", language_id),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]]

# Classifiers and tokens have no SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is stored for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
