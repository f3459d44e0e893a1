import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerstar.llm import curriculum, ecoc_langid, mil_quality, sos_packing

STAGES = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def test_language_stage_drops_what_has_no_language(spark, docs, sf):
    more = docs.unionByName(docs.limit(2).select((F.col("doc_id") + 10**6).alias("doc_id"), F.lit("12 34 !").alias("text"), "lang", "source", "n_chars"))
    out = STAGES["language_id"](spark, more, sf)
    assert out.columns == docs.columns and rows_of(out) == rows_of(docs)


def test_quality_stage_keeps_what_scores(spark, docs, sf):
    out = STAGES["quality"](spark, docs, sf)
    kept = {r.doc_id for r in out.collect()}
    score = {r.doc_id: r.predicted for r in mil_quality.op3_query(spark, sf).collect()}
    assert kept == {i for i, p in score.items() if p} and out.columns == docs.columns


def test_near_duplicate_stage_keeps_one_of_each_group(spark, docs, sf):
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    want = {c for _, _, c in brute.jaccard_components(pairs)}
    out = STAGES["near_duplicates"](spark, docs, sf)
    assert sorted(r.doc_id for r in out.collect()) == sorted(want) and out.columns == docs.columns


def test_edges_of_every_stage(spark, documents, sf):
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "near " * 3 + "copy of a text", "en", "s"), (4, "near " * 3 + "copy of a text", "en", None), (4, "near " * 3 + "copy of a text", "en", None),
            (5, "long " * 50_000, "en", "s"), (5, "other text with this id", "en", "s"), (None, "no id but text", "en", "s"), (None, None, None, None)]
    docs = documents(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        got = out.collect()
        if name == "near_duplicates":
            assert sorted((r.doc_id for r in got), key=repr) == sorted([1, 2, 3, 5, None, None], key=repr)
        if name == "language_id":
            assert all(r.text for r in got)
        assert stage(spark, docs.limit(0), sf).collect() == [], name
    assert len(STAGES["pack"](spark, docs, sf).collect()) >= len(rows)
    assert STAGES["pack"](spark, docs.limit(0), sf).collect() == []


def test_mix_and_pack_stages(spark, docs, sf):
    mixed = STAGES["mix"](spark, docs, sf)
    size = {}
    for r in docs.collect():
        size[r.source] = size.get(r.source, 0) + len(brute.words(r.text))
    taken = {r.source: r.n for r in curriculum.op9_query(spark, sf).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    got = {}
    for r in mixed.collect():
        got[r.source] = got.get(r.source, 0) + len(brute.words(r.text))
    assert got == {s: n for s, n in taken.items() if n} and mixed.columns == docs.columns
    tokens = sos_packing.WordTokenizer(sos_packing.default_tokenizer()).tokenizer
    pieces = STAGES["pack"](spark, docs, sf)
    want = sum(len(tokens.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert pieces.agg(F.sum("length")).first()[0] == want


def test_run_equals_the_stages_one_by_one(spark, docs, sf):
    df = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, sf)
        df = spark.createDataFrame(df.collect(), df.schema)
    whole = corpus_pipeline.run(spark, sf).select("doc_id", "start", "length")
    tokens = lambda x: sorted((r.doc_id, r.n) for r in x.groupBy("doc_id").agg(F.sum("length").alias("n")).collect())
    assert tokens(whole) == tokens(STAGES["pack"](spark, df, sf))
    assert ecoc_langid.UNKNOWN not in {r.lang for r in df.collect()}


def test_language_stage_drops_what_fits_no_language(spark, docs, sf):
    rng = np.random.default_rng(4)
    draw = lambda letters: "".join(rng.choice(list(letters), 600))
    kinds = ["abcdefghijklmnopqrstuvwxyz ", "ÃÂ©¤¶¼Ÿâ€™œ ", "абвгдежзиклмнопрстуфхцчшщыья ", "{}();=<>ifxn0_ "]
    noise = [(10**7 + 4 * i + k, draw(kind), "en", "s", 600) for i in range(25) for k, kind in enumerate(kinds)]
    got = {r.doc_id for r in STAGES["language_id"](spark, docs.unionByName(spark.createDataFrame(noise, docs.schema)).withColumn("lang", F.when(F.col("doc_id") < 10**7, F.col("lang"))), sf).select("doc_id").collect()}
    assert got >= {r.doc_id for r in docs.select("doc_id").collect()}
    assert sum(r[0] in got for r in noise) <= len(noise) // 5
