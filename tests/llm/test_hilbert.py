import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstar.llm.hilbert import document_dims, hilbert_index, hilbert_shards, op2_query, quantised, write_shards


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_and_moves_one_step(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    index = hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_query_rows_law(spark, sf):
    got = op2_query(spark, sf).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(docs)
    per = Counter(r.shard for r in got)
    assert set(per) == set(range(24)) and max(per.values()) - min(per.values()) <= 1
    for s in per:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(per[s]))
    for r in got:
        assert r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) and r.size == len(docs[r.doc_id].encode()) + 8
        assert r.law == "rows" and r.grown_shard is None
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in got)


def sized(docs):
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("size", (F.octet_length(text) + 8).cast("long"))


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_edges(spark, documents, law):
    rows = [(None, None, None, None), (1, "", "en", None), (1, "", "en", None), (2, "x" * 300_000, None, "s"), (3, "a", "en", "s")] + [(10 + i, "t" * (i % 50), "en", "hot") for i in range(300)]
    out = hilbert_shards(sized(documents(rows)), document_dims(), ["doc_id", "size"], 7, law=law, size="size")
    assert "lang_score" in out.columns and out.columns.count("shard") == 1
    got = out.collect()
    assert len(got) == len(rows)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    if law == "rows":
        n = Counter(r.shard for r in got)
        assert max(n.values()) - min(n.values()) <= 1
    assert hilbert_shards(sized(documents([])), document_dims(), ["doc_id"], 7, law=law, size="size").collect() == []


def test_bytes_law_is_near_equal_and_files_prune(spark, scratch):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), (F.xxhash64("id") % 97).alias("a"), (F.xxhash64("id", F.lit(1)) % 89).alias("b"), (F.col("id") % 13 + 1).alias("size"))
    out = hilbert_shards(df, [F.col("a"), F.col("b")], ["doc_id"], 16, law="bytes", size="size")
    sums = [r["s"] for r in out.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert max(sums) - min(sums) <= 2 * 13
    write_shards(out, f"{scratch}/shards")
    spans = spark.read.parquet(f"{scratch}/shards").groupBy("shard").agg(F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("b").alias("b0"), F.max("b").alias("b1")).collect()
    hit = sum(r.a0 <= 5 and r.a1 >= 0 and r.b0 <= 5 and r.b1 >= 0 for r in spans)
    assert len(spans) == 16 and hit <= 6  # a corner of both dimensions is in few files


def test_whole_texts_and_large_numbers_are_told_apart(spark):
    big = 1 << 40
    df = spark.createDataFrame([(f"common_crawl_{i % 20}", big + i % 4, None if i % 7 == 0 else float("nan") if i % 7 == 1 else 1.0) for i in range(400)], "source string, n long, x double")
    rows = df.select("source", "n", "x", *[c.alias(f"c{i}") for i, c in enumerate(quantised(df, [F.col("source"), F.col("n"), F.col("x")]))]).collect()
    names = sorted({r.source for r in rows})
    assert all(r.c0 == 2 + names.index(r.source) for r in rows)
    assert {r.n: r.c1 for r in rows} == {big + k: {r.c1 for r in rows if r.n == big + k}.pop() for k in range(4)} and len({r.c1 for r in rows}) == 4
    assert all((r.c2 == 0) == (r.x is None or r.x != r.x) for r in rows)
    many = spark.range(5000).select(F.concat(F.lit("https://example.org/"), F.lpad((F.col("id") % 1000).cast("string"), 4, "0")).alias("s"))
    codes = Counter(r.c for r in many.select(quantised(many, [F.col("s")])[0].alias("c")).collect())
    assert 29 <= len(codes) <= 31 and max(codes.values()) < 2 * 5000 / 30


def test_shards_equal_a_plain_walk_along_the_curve(spark, documents):
    """Codes, curve place, rank, shard and slot by plain Python over all rows."""
    langs, sources = ["de", "en", None], ["s1", "s2", "s3", "s4"]
    rows = [(i, "w" * (i * 37 % 11), langs[i % 3], sources[i * 7 % 4]) for i in range(150)]
    got = {r.doc_id: (r.shard, r.slot) for r in hilbert_shards(sized(documents(rows)), [F.col("lang"), F.col("source")], ["doc_id"], 7, bits=3).collect()}
    code = lambda v, values: 0 if v is None else 2 + values.index(v)

    def place(x, y, bits=3):  # the textbook walk: quadrant by quadrant, turning and mirroring
        d, s = 0, 1 << bits - 1
        while s:
            rx, ry = int(x & s > 0), int(y & s > 0)
            d += s * s * (3 * rx ^ ry)
            if not ry:
                if rx:
                    x, y = 2 * s - 1 - x & 2 * s - 1, 2 * s - 1 - y & 2 * s - 1
                x, y = y, x
            s >>= 1
        return d

    cells = {(x, y): place(x, y) for x in range(8) for y in range(8)}
    own = {(x, y): int(hilbert_index(np.array([[x, y]]), 3)[0]) for x in range(8) for y in range(8)}
    turned = [{(x, y): d for (y, x), d in cells.items()}, cells]
    assert own in turned  # the same curve, up to the order of the axes
    order = sorted(rows, key=lambda r: (own[code(r[2], ["de", "en"]), code(r[3], sources)], r[0]))
    for rank, r in enumerate(order):
        shard = rank * 7 // 150
        assert got[r[0]] == (shard, rank - -(-shard * 150 // 7))
