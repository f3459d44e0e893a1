import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ledgerstar.llm.recompression import Grammar, found_runs, op12_query, periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, least=12):
    """Every maximal stretch with its smallest period, by trying all periods."""
    n, out = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                out.setdefault((i, j + p - i), p)
            i = j + 1
    return sorted((s, m, p) for (s, m), p in out.items())


def collapsed(w, runs):
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_query(docs):
    out = []
    for i, text in docs:
        w = WORD.findall(text or "")
        if i is not None and w:
            h = zlib.crc32(str(i).encode())
            g, n = h // 10, len(w)
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(w)
        s, m, p = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        out.append((i, len(runs), s, m, p, 1000 * m // p if runs else None, sha("".join(f"{x},{y},{z}\n" for x, y, z in runs)), sha(collapsed(w, runs))))
    return sorted(out, key=repr)


def laid(texts):
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.array([x for t in texts for x in t], np.int64), at


@settings(max_examples=250, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 9)), max_size=6), min_size=1, max_size=5))
def test_runs_equal_brute_force(parts):
    texts = [[x for piece, times in t for x in piece * times] for t in parts]
    got = [tuple(r) for r in found_runs(*laid(texts)).tolist()]
    assert got == [(k, *r) for k, t in enumerate(texts) for r in brute_runs(t)]


@pytest.mark.parametrize("alphabet,n", [(1, 700), (2, 400), (2, 1500), (3, 900), (50, 2000)])
def test_longer_texts(alphabet, n):
    rng = random.Random(n)
    texts = [[rng.randrange(alphabet) for _ in range(n)], [7, 8, 9] * 150 + [rng.randrange(alphabet) for _ in range(50)] + ([5] * 20 + [6] * 3) * 12, list(range(n))]
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    texts.append(b)
    got = [tuple(r) for r in found_runs(*laid(texts)).tolist()]
    assert got == [(k, *r) for k, t in enumerate(texts) for r in brute_runs(t)]


def test_grammar_queries():
    rng = random.Random(2)
    text = [x for _ in range(60) for x in [rng.randrange(3)] * rng.randrange(1, 9) + [1, 2, 1] * rng.randrange(4)]
    grammar = Grammar(np.array(text), len(text))
    x = np.array([i for i in range(len(text)) for _ in range(12)])
    y = np.array([rng.randrange(i + 1, len(text) + 1) if i + 1 < len(text) else len(text) for i in x])
    x, y = x[y < len(text)], y[y < len(text)]
    for back in (False, True):
        want = []
        for i, j in zip(x.tolist(), y.tolist()):
            k = 0
            while (i - k >= 0 if back else j + k < len(text)) and text[i - k if back else i + k] == text[j - k if back else j + k]:
                k += 1
            want.append(k)
        cap = x + 1 if back else len(text) - y
        assert grammar.agreeing(x, y, cap, back).tolist() == want


DOCS = [(1, None), (2, ""), (3, " \n"), (4, "a " * 12), (4, "a " * 12), (5, "a " * 11), (None, "a b " * 9), (6, "x y z " * 4 + "x"), (7, "  A a\tA  a " * 3),
        (8, "é\u0085 " * 13), (9, "w " * 30_000 + "end"), (10, " ".join(f"u{i}" for i in range(300)))] + [(100 + i, " ".join(f"v{k}" for k in range(i * 3))) for i in range(60)]


def test_edges(spark, documents):
    got = {}
    for r in periodic_runs(documents(DOCS)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, text in DOCS:
        w = WORD.findall(text or "")
        for r in got[i]:
            runs = [(0, 30_000, 1)] if i == 9 else brute_runs(w)
            assert [tuple(x) for x in r.runs] == runs and r.n_words == len(w) and r.collapsed == collapsed(w, runs)
    assert len(got[4]) == 2
    assert periodic_runs(documents([])).collect() == []


def test_query_equals_brute_force(spark, saved, documents):
    docs = [d for d in DOCS if d[0] != 9]
    got = op12_query(spark, saved(documents=documents(docs))).collect()
    assert sorted(map(tuple, got), key=repr) == brute_query(docs)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs) > 3


def test_query_on_given_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs = [d for d in docs if len(d[1] or "") < 6000]
    got = {tuple(r) for r in op12_query(spark, sf).collect()}
    assert set(brute_query(docs)) <= got
