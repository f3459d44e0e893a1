import hashlib
import random
import re

import duckdb
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from ledgerstar.llm.wu_manber import OP11_SQL, Windows, decontaminated, op11_query

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [(1, "One two THREE four five six seven eight nine ten eleven"), (2, "two three four five six seven eight nine ten eleven"), (10, "short one"),
         (10, "another part"), (3, None), (4, "?!"), (None, "nameless words"), (5, "é à"), (6, "x"), (7, "short one"), (8, "long " * 30)]
DOCS = [(1, "one, two three-four five six seven eight nine ten ELEVEN twelve"), (2, None), (3, ""), (4, " .. "), (5, "a short one and a SHORT\none"), (5, "a short one and a SHORT\none"),
        (None, "nameless words, É à é à"), (6, "short"), (7, "one"), (8, "long " * 9 + "x"), (9, "long " * 10_000 + "short one"), (10, "another"), (11, "part"), (12, "xx x\x00x"), (13, "another\xa0part another part")]


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    for i, text in docs:
        w, hit, names = words(text), set(), set()
        for name, item in items:
            x = words(item)
            k = min(len(x), window)
            for s in range(len(x) - k + 1 if x else 0):
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == x[s:s + k]:
                        hit |= set(range(p, p + k))
                        names |= set() if name is None else {str(name)}
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def digest(rows):
    out = [(r.doc_id, r.n_words, sum(s.length for s in r.spans), len(r.items), hashlib.sha256(",".join(r.items).encode()).hexdigest(), bool(r.spans)) for r in rows]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [8 << 20, 60])
def test_edges(spark, documents, block_bytes):
    items = spark.createDataFrame([(*r, 1, "x") for r in ITEMS], "item_id long, text string, doc_id int, spans string")
    got = decontaminated(documents(DOCS), items, block_bytes=block_bytes).collect()
    assert digest(got) == brute(DOCS, ITEMS)
    for r in got:  # spans apart and in order
        assert all(a.start + a.length < b.start for a, b in zip(r.spans, r.spans[1:]))
    assert decontaminated(documents([]), items).collect() == []
    assert digest(decontaminated(documents(DOCS), items.limit(0)).collect()) == brute(DOCS, [])


LETTERS = st.sampled_from(["a", "b", "ab", "ba", "aba", "é", "A", "0", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", " ", " ", ".", "\n"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(LETTERS, max_size=30).map("".join), max_size=6), st.lists(st.lists(LETTERS, max_size=14).map("".join), max_size=6), st.integers(1, 5))
def test_search_equals_brute_force(texts, items, window):
    ids = [str(i % 4) for i in range(len(items))]
    n, spans, names = Windows(ids, pa.array(items, pa.string()), window).search(pa.array(texts, pa.string()))
    got = [(k, int(n[k]), sum(s["length"] for s in spans[k]), len(names[k]), hashlib.sha256(",".join(names[k]).encode()).hexdigest(), bool(spans[k])) for k in range(len(texts))]
    assert sorted(got, key=repr) == brute(list(enumerate(texts)), list(zip(ids, items)), window)


def test_many_patterns_and_long_texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(50)]
    items = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 40))) for _ in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=400) + items[i].split()[:25] + rng.choices(vocabulary, k=30)) for i in range(0, 300, 10)]
    ids = [str(i) for i in range(300)]
    n, spans, names = Windows(ids, pa.array(items)).search(pa.array(texts))
    got = [(k, int(n[k]), sum(s["length"] for s in spans[k]), len(names[k]), hashlib.sha256(",".join(names[k]).encode()).hexdigest(), bool(spans[k])) for k in range(len(texts))]
    assert sorted(got, key=repr) == brute(list(enumerate(texts)), list(zip(ids, items)))


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    want = con.execute(OP11_SQL).fetchall()
    got = [tuple(r) for r in op11_query(spark, sf).collect()]
    assert sorted(got) == sorted(want)
    assert 0 < sum(r[5] for r in got) < len(got)
