import hashlib

import brute
import pytest
from pyspark.sql import functions as F

from ledgerstar.llm.bottomk import K, containment, distinct_shingles, merged, merged_by, op7_query, printable, resemblance, with_next, with_sketch


def edited(text, following):
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def jaccard(a, b):
    a, b = brute.shingle_set(a), brute.shingle_set(b)
    return len(a & b) / len(a | b) if a or b else 1.0


def check(docs, got):
    want = sorted((i, len(t), hashlib.sha256(edited(t, n).encode()).hexdigest()) for i, t, n in brute.next_texts(docs) if i is not None)
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got if r.doc_id is not None) == want
    assert len(got) == len(docs)
    by_id = {i: (t, n) for i, t, n in brute.next_texts(docs)}
    for r in got:
        t, n = by_id[r.doc_id]
        e = edited(t, n)
        if sum(i == r.doc_id for i, _ in docs) > 1:
            continue
        for near, other in ((r.near_edited, e), (r.near_next, n)):
            exact = len(brute.shingle_set(t) | brute.shingle_set(other)) <= K
            assert near == pytest.approx(jaccard(t, other), abs=1e-12 if exact else 0.2)


def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = op7_query(spark, sf).collect()
    check(docs, got)
    prints = {}
    for r in got:
        prints.setdefault(dict(docs)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in prints.values())


def test_edges(spark, documents, saved):
    rows = [(1, None), (2, ""), (3, "é😀 b c d e f g"), (4, "a"), (5, "A"), (7, "w " * 50_000), (9, "same text"), (9, "same text"), (9, "other text of nine"), (-5, "minus"), (None, "no id"), (None, None)]
    rows += [(100 + i, f"t{i} " * 9) for i in range(40)]
    check(rows, op7_query(spark, saved(documents=documents(rows))).collect())


@pytest.mark.parametrize("rows", [[], [(1, "alone in the table")], [(None, "x")]])
def test_small_tables(spark, documents, saved, rows):
    check(rows, op7_query(spark, saved(documents=documents(rows))).collect())


def test_estimates_and_merging(spark):
    a = " ".join(f"a{i}" for i in range(3000))
    b = " ".join([f"a{i}" for i in range(1500)] + [f"b{i}" for i in range(1500)])
    df = with_sketch(with_sketch(spark.createDataFrame([(a, b)], "a string, b string"), "a", "sa"), "b", "sb")
    r = df.select(resemblance(F.col("sa"), F.col("sb")).alias("j"), containment(F.col("sa"), F.col("sb")).alias("c"), distinct_shingles(F.col("sa")).alias("n"),
                  distinct_shingles(merged(F.col("sa"), F.col("sb"))).alias("u"), F.size("sa").alias("k"), printable(F.col("sa")).alias("p")).first()
    assert r.k == K and r.j == pytest.approx(1 / 3, abs=0.15) and r.c == pytest.approx(0.5, abs=0.2)
    assert r.n == pytest.approx(2996, rel=0.3) and r.u == pytest.approx(4490, rel=0.3) and len(r.p) == K * 8
    parts = spark.createDataFrame([("x", " ".join(f"a{i}" for i in range(s, min(s + 504, 3000)))) for s in range(0, 3000, 500)], "k string, t string")
    whole = merged_by(with_sketch(parts, "t", "s"), "k", "s").first().s
    assert whole == df.first().sa


def test_next_across_ranges(spark):
    rows = [(i * i, f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, t string")
    got = with_next(df, df.select("id"), "id", ["t"], lambda small: df.join(F.broadcast(small), df.id.eqNullSafe(small["_head"]), "left_semi")).collect()
    assert {r.id: r.next_t for r in got} == {i: n for i, _, n in brute.next_texts(rows)}


def test_main_path_is_native(spark, sf):
    plan = op7_query(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
