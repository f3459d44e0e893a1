import hashlib

import brute
import pytest
from pyspark.sql import functions as F

from ledgerstar.llm.curriculum import first_words, mixed, mixed_documents, occurrences, op9_query


def targets(sizes):
    """Round by round: whoever is above three times its size is capped."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, left = {}, set(order), sum(sizes.values())
    while True:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 3 * sizes[s]} if free else set()
        if not over:
            return {**target, **{s: left * weight[s] / total for s in free}}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
        free -= over


def check(rows, got):
    """rows: (doc_id, size, source); got: rows with source_size, target, taken."""
    sizes = {}
    for _, size, source in rows:
        sizes[source] = sizes.get(source, 0) + size
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    by_id = {i: s for i, _, s in rows}
    assert len(got) == len(rows)
    for r in got:
        s = by_id[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = [(r.doc_id, len(brute.words(r.text)), r.source) for r in docs]
    got = op9_query(spark, sf).collect()
    check(rows, got)
    again = op9_query(spark, sf).collect()
    assert sorted(got) == sorted(again)


def test_edges_and_hot_source(spark, documents):
    rows = [(1, None, None, None), (2, "", None, "b"), (3, "a b c", None, "tiny"), (4, "one", None, None)] + [(10 + i, "w " * (i % 40), None, "hot") for i in range(400)] + [(900, "x " * 9000, None, "z")]
    docs = documents(rows)
    sized = docs.select("*", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("_size"))
    mix = mixed(sized)
    got = mix.select("doc_id", F.col("_size").alias("size"), "source_size", "target", "taken").collect()
    check([(i, len(brute.words(t)), s) for i, t, _, s in rows], got)
    spans = occurrences(mix).groupBy("doc_id").agg(F.sum("take_words").alias("n"), F.max("position").alias("p")).collect()
    assert {r.doc_id: r.n for r in spans} == {r.doc_id: r.taken for r in got if r.taken}
    assert all(0 <= r.p < 1 for r in spans)
    assert mixed(sized.limit(0)).collect() == []


def test_mixed_documents_take_effect(spark, documents):
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(5 + i % 7)), "en", f"s{i % 4}") for i in range(60)] + [(100, "only three words", "en", "a")]
    docs = documents(rows)
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    words_out = {}
    for r in out.collect():
        full = dict((i, t) for i, t, *_ in rows)[r.doc_id]
        assert full.startswith(r.text)
        words_out[r.source] = words_out.get(r.source, 0) + len(r.text.split())
    sizes = {}
    for i, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    for s, t in targets(sizes).items():
        assert abs(words_out.get(s, 0) - t) <= 0.5
    # later weights: a source with a rising ramp comes later on average than one with a falling ramp
    place = {}
    for k, r in enumerate(out.collect()):
        place.setdefault(r.source, []).append(k)
    mean = {s: sum(v) / len(v) for s, v in place.items()}
    order = sorted(sizes)
    assert mean[order[0]] < mean[order[2]]
    assert mixed_documents(documents([])).collect() == []


def test_first_words(spark):
    texts = ["a b c d", "  a\tb  c", "a", "", " x "]
    df = spark.createDataFrame([(t, k) for t in texts for k in range(1, 5)], "t string, k long")
    for r in df.withColumn("got", first_words(F.col("t"), F.col("k"))).collect():
        assert brute.words(r.got) == brute.words(r.t)[: r.k] and r.t.startswith(r.got)


def test_order_is_by_md5(spark):
    df = spark.createDataFrame([(i, "s", 10) for i in range(50)], "doc_id long, source string, _size long")
    got = {r.doc_id: r.before for r in mixed(df).collect()}
    order = sorted(range(50), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    assert [got[i] for i in order] == list(range(0, 500, 10))
