import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from ledgerstar.llm.components import connected_components
from ledgerstar.llm.jaccard_join import JaccardJoin, _candidates, band_keys, document_keys, folded, op1_query
from ledgerstar.llm.textscan import shingle_sets

EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one  two three"), (7, "one two\tthree"), (8, "a b c d e"), (8, "a b c d e"),
         (None, "a b c d e"), (9, "x " * 40_000), (10, "x " * 39_000), (11, "é É"), (12, "  \u0085")]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def random_docs(seed, groups, copies):
    """Near copies around the threshold, of many sizes, and shared passages."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    out = []
    for _ in range(groups):
        base = [f"v{rng.randrange(5000)}" for _ in range(rng.choice([3, 6, 9, 14, 30, 70, 130, 300, 700]))]
        if rng.random() < 0.5:
            base = base + passage
        out += [(len(out) + k, " ".join(edited(rng, base, rng.randrange(0, 1 + len(base) // 25)))) for k in range(rng.randrange(1, copies))]
    return out


@pytest.mark.parametrize("part_keys,hot_keys", [(2_000_000, 1_000_000), (400, 2)])
def test_components_and_pairs_equal_brute_force(spark, part_keys, hot_keys):
    docs = random_docs(part_keys, 40, 9)
    join = JaccardJoin(spark.createDataFrame(docs, "doc_id long, text string"), part_keys, hot_keys)
    assert sorted(map(tuple, join.components().collect()), key=repr) == brute.jaccard_components(docs)
    sets, first = [(i, brute.shingle_set(t)) for i, t in docs], {}
    for i, s in sets:
        first.setdefault(s, i)
    reps = sorted((i, s) for s, i in first.items())
    want = {(i, j) for k, (j, t) in enumerate(reps) for i, s in reps[:k] if brute.linked(s, t)}
    assert {(r.a, r.b) for r in join.pairs().collect()} == want
    assert len(want) > 20


def test_edge_rows(spark, documents):
    got = JaccardJoin(documents(EDGES)).components().collect()
    assert sorted(map(tuple, got), key=repr) == brute.jaccard_components(EDGES)


def test_empty_table(spark, documents):
    assert JaccardJoin(documents([])).components().collect() == []


def test_query_on_given_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = op1_query(spark, sf).collect()
    assert sorted(map(tuple, got), key=repr) == brute.jaccard_components(docs)


def test_keys_bounds_hold():
    """Every document has more than d + 1 keys; chunks and sketch bits that
    differ are at most the symmetric difference; linked sets share a key."""
    rng = random.Random(3)
    texts = [" ".join(f"t{rng.randrange(10**9)}" for _ in range(n)) for n in [1, 4, 5, 6, 7, 20, 84, 85, 260, 350, 1100, 1500, 5000] for _ in range(4)]
    values, at = shingle_sets(pa.array(texts))
    for docs, keys, offsets in document_keys(values, at, np.ones(len(texts), bool)):
        assert (np.diff(offsets) >= np.diff(at)[docs] // 3 + 1).all()
    words = [f"w{i}" for i in range(400)]
    pair = [" ".join(words), " ".join(edited(rng, words, 12))]
    values, at = shingle_sets(pa.array(pair))
    a, b = (set(values[i:j].tolist()) for i, j in zip(at[:-1], at[1:]))
    bits = folded(values, at).view(np.uint8)
    assert int(np.unpackbits(bits[0] ^ bits[1]).sum()) <= len(a ^ b)
    keys, offsets = band_keys(values, at, 4)
    ka, kb = (set(keys[i:j].tolist()) for i, j in zip(offsets[:-1], offsets[1:]))
    assert max(len(ka - kb), len(kb - ka)) <= len(a ^ b)


def test_connected_components(spark):
    rng = random.Random(9)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, 1000 + i) for i in range(200)]
    links = chain + star + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(80)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_shared_passage_keeps_candidates_in_proportion(spark):
    """A passage that every document holds is no join key: rows of buckets and
    candidate pairs grow with the documents, not with their square."""
    rng = random.Random(8)
    passage = " ".join(f"licence{i}" for i in range(70))

    def made(n):
        out = []
        for i in range(n):
            own = [f"u{rng.randrange(10**9)}" for _ in range(400)]
            out.append((2 * i, f"{' '.join(own[:200])} {passage} {' '.join(own[200:])}"))
            if i % 10 == 0:
                out.append((2 * i + 1, f"{' '.join(own[:200])} {passage} {' '.join(edited(rng, own[200:], 2))}"))
        return out

    pairs = {}
    for n in (200, 800):
        docs = made(n)
        join = JaccardJoin(spark.createDataFrame(docs, "doc_id long, text string"))
        pairs[n] = _candidates(join._members(), None).count()
        got = {r.doc_id: r.component_id for r in join.components().collect()}
        assert got == {i: i - i % 2 for i, _ in docs}
    assert pairs[200] <= 40 and pairs[800] <= 160, pairs
