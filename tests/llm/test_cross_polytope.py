import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstar.llm import cross_polytope as cp


def exact(rows, asked, k):
    """{query: [(id, score)]} over rows (id, vector); all inner products."""
    out = {}
    for q, v in rows:
        if asked(q):
            s = [(-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in rows if i != q]
            out[q] = [i for _, i in sorted((round(a, 12), i) for a, i in s)[:k]]
    return out


def by_query(got):
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r)
    return out


def test_hash_is_a_rotation_and_probes_start_at_the_hash():
    index = cp.CrossPolytope(24, 3, 2)
    x = np.random.default_rng(0).standard_normal((50, 24))
    turned = index._turned(x, False, 1, 0)
    assert np.allclose(np.linalg.norm(turned[:, : index.width], axis=1), np.linalg.norm(x, axis=1))
    for t in range(3):
        probes = index.probes(x, t, 40)
        assert (probes[:, 0] == index.hashed(x, t)).all()
        assert all(len(set(p)) == 40 for p in probes)
    assert sorted(cp.CrossPolytope(3, 1, 1).probes(x[:1, :3], 0, 10**6)[0]) == list(range(8))


def test_given_table_is_exact_when_small(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = by_query(cp.op5_query(spark, sf).collect())
    want = exact(rows, lambda i: i % 20 == 0, 20)
    assert {q: [r.vec_id for r in v] for q, v in got.items()} == want
    vec = dict(rows)
    for q, v in got.items():
        assert [r.rank for r in v] == list(range(1, 21))
        for r in v:
            assert r.score == pytest.approx(float(np.dot(np.float64(vec[q]), np.float64(vec[r.vec_id]))), abs=1e-12)


@pytest.mark.parametrize("uneven", [False, True])
def test_recall_on_many_vectors(spark, uneven):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((6000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if uneven:
        x *= rng.uniform(0.3, 2.0, (len(x), 1)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    got = by_query(cp.search(df, F.col("vec_id") % 60 == 0, k=10).collect())
    scores = x[::60].astype(float) @ x.T.astype(float)
    hit = 0
    for row, q in enumerate(range(0, 6000, 60)):
        scores[row, q] = -np.inf
        best = set(np.argsort(-scores[row])[:10])
        hit += len(best & {r.vec_id for r in got[q]})
        assert len(got[q]) == 10
    assert hit / 1000 >= 0.9


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [-1.0, 0.0]), (4, None), (5, [0.0, 0.0]), (40, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, [1.0]), (9, []), (None, [1.0, 1.0]), (2, [0.5, 0.5]), (60, None)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, id int, code int")
    got = {q: [(r.vec_id, r.score) for r in v] for q, v in by_query(cp.search(df, F.col("vec_id") % 20 == 0, k=20).collect()).items()}
    assert got == {0: [(1, 1.0), (20, 1.0), (2, 0.5), (3, -1.0)], 20: [(0, 1.0), (1, 1.0), (2, 0.5), (3, -1.0)]}
    assert cp.search(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert cp.search(df, F.lit(False)).collect() == []


def test_hot_code_is_split_and_ties_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(cp, "DATA_BLOCK", 50)
    monkeypatch.setattr(cp, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(400)] + [(400 + i, rng.standard_normal(3).tolist()) for i in range(300)]
    got = by_query(cp.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=5).collect())
    assert len(got) == 35
    for q in range(0, 400, 20):
        want = exact(rows, lambda i: i == q, 5)[q]
        assert [r.vec_id for r in got[q]] == want


def test_rows_of_one_id_with_different_vectors_are_each_a_candidate(spark):
    rows = [(0, [1.0, 0.0]), (2, [0.1, 0.0]), (2, [0.9, 0.0]), (2, [0.9, 0.0]), (3, [0.5, 0.0])] + [(7, [0.7, 0.1])] * 30
    got = cp.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=4).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(1, 2, 0.9), (2, 7, 0.7), (3, 3, 0.5), (4, 2, 0.1)]


@pytest.mark.parametrize("n", [500, 5000])
def test_recall_has_one_path_at_every_size(spark, n):
    rng = np.random.default_rng(n)
    x = rng.standard_normal((n, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = by_query(cp.search(df, F.col("vec_id") % 20 == 0).collect())
    scores = x[::20] @ x.T
    scores[np.arange(len(scores)), np.arange(0, n, 20)] = -np.inf
    hit = sum(len(set(np.argsort(-scores[i])[:20]) & {r.vec_id for r in got[20 * i]}) for i in range(len(scores)))
    assert hit / (20 * len(scores)) >= 0.95


def test_goal_out_of_reach_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(cp, "MOST_TABLES", 1)
    monkeypatch.setattr(cp.CrossPolytope, "hashed", lambda self, x, t: np.full(len(x), -1))
    df = spark.createDataFrame([(i, [float(i % 7), 1.0, 2.0]) for i in range(50)], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="do not catch"):
        cp.search(df, F.col("vec_id") % 20 == 0, tables=1).collect()
