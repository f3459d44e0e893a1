import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from ledgerstar.llm import token_align
from ledgerstar.llm.token_align import Book, ByteTokenizer, PieceTokenizer, aligned, aligned_slice, default_tokenizers, op13_query, refined_ends

A, B = ByteTokenizer(default_tokenizers()[0]), PieceTokenizer(default_tokenizers()[1])
TEXTS = [None, "", " ", "a", "hello  world\nfoo  ", " lead", "日本語 é x y", "🎉ok 𓀀x é", "a ▁b", "▁", "x<s> <0x41> <|endoftext|> </s>", "don't  stop\r\n\tnow", "\x00a\x01 b",
         "a\xa0 b　 c  d﻿ e\x1c f\x85 g", "​ x", "é ñ", "👩‍👩‍👧 family", " " * 40 + "deep", "word " * 3000, "z" * 9000, "İstanbul. ﬁn", "߿ ퟿ \U0010ffff \u0080 q"]


def whole(text):
    """Tokens of the whole text and their bytes, without chunks or spans."""
    if not text:
        return [], []
    a = [(i, bytes(A.vocabulary.bytes[A.vocabulary.start[i]: A.vocabulary.start[i] + A.vocabulary.length[i]])) for i in A.tokenizer.encode(" " + text, add_special_tokens=False).ids]
    alphabet = token_align.byte_alphabet()
    assert [b for _, b in a] == [bytes(alphabet[c] for c in A.tokenizer.id_to_token(i)) for i, _ in a]
    b = [(i, bytes([int(B.model.id_to_piece(i)[3:5], 16)]) if B.model.is_byte(i) else B.model.id_to_piece(i).replace("▁", " ").encode()) for i in B.model.encode(text)]
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])


def brute(docs):
    rows, pairs = [], Counter()
    for i, text in docs:
        a, b = whole(text)
        ea, eb = (np.cumsum([0] + [len(x) for _, x in t]).tolist() for t in (a, b))
        both = sorted(set(ea) & set(eb) - {0})
        links = [(x, y) for k, (x, _) in enumerate(a) for j, (y, _) in enumerate(b) if max(ea[k], eb[j]) < min(ea[k + 1], eb[j + 1])] if len(a) < 500 else links_of(a, b, ea, eb)
        groups, low = [], 0
        for end in both:
            groups.append("|".join(",".join(str(x) for k, (x, _) in enumerate(t) if low < e[k + 1] <= end) for t, e in ((a, ea), (b, eb)))) if len(a) < 500 else None
            low = end
        pairs.update(set(links))
        rows.append((i, len(a), len(b), len(both), links, groups))
    top = {}
    for (x, _), n in pairs.items():
        top[x] = max(top.get(x, 0), n)
    return [(i, n, m, g, len(links), sum(pairs[l] == top[l[0]] for l in links), sum(pairs[l] for l in links), groups if n < 500 else None) for i, n, m, g, links, groups in rows]


def links_of(a, b, ea, eb):
    out, k, j = [], 0, 0
    while k < len(a) and j < len(b):
        out.append((a[k][0], b[j][0]))
        x, y = ea[k + 1], eb[j + 1]
        k, j = k + (x <= y), j + (y <= x)
    return out


def check(docs, got):
    want = brute(docs)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == len(want)
    for i, n, m, g, links, best, total, groups in want:
        r = by[i].pop()
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == (n, m, g, links, best, total), (i, r)
        if groups is not None:
            spelled = ";".join(groups)
            assert r.groups_sha256 == (hashlib.sha256(spelled.encode()).hexdigest() if n else ""), i
            assert "groups" not in r or r.groups == spelled


def test_edges(spark, documents, monkeypatch):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4]), (None, "no id")]
    got = aligned(documents(docs)).collect()
    check([d for d in docs if d[0] != 4] + [(4, TEXTS[4])] * 2, got)
    assert sum(r.n_a == 0 for r in got) == 4 and aligned(documents([])).collect() == []
    assert {r.doc_id for r in got if r.n_a == 0} == {0, 1, TEXTS.index("a ▁b"), TEXTS.index("▁")}


def test_query_in_small_slices(spark, saved, documents, sf, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = [r for r in rows if len(r[1] or "") < 3000]
    folder = saved(documents=spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    check(rows, op13_query(spark, folder).collect())


BOOK = Book(A, B)
PART = st.one_of(st.sampled_from(TEXTS[2:18]), st.text(max_size=6), st.sampled_from([" ", "  ", "\n", "\xa0", "ab", "the", "'s", "▁", "é", "日"]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PART, max_size=7).map("".join), max_size=4))
def test_slices_equal_whole_texts(texts):
    payload, pairs, n = aligned_slice(pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string()), BOOK, True)
    got = token_align.finished(payload, n, np.zeros(len(n), bool)).to_pylist()
    for r, (_, a, b, g, links, _, total, groups) in zip(got, brute(list(enumerate(texts))), strict=True):
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["count_sum"]) == (a, b, g, links, total)
        assert groups is None or r["groups"] == ";".join(groups)


def test_spans_are_refined_by_decoded_bytes():
    """A character over three tokens whose spans overlap, and byte fallback whose
    spans are empty but the last."""
    ends, agree = refined_ends(np.array([0, 1, 1, 4]), np.array([4, 4, 4, 6]), np.array([2, 1, 1, 2]))
    assert ends.tolist() == [2, 3, 4, 6] and agree.all()
    ends, agree = refined_ends(np.array([0, 1, 1, 1, 1, 5]), np.array([1, 1, 1, 1, 5, 6]), np.array([1, 1, 1, 1, 1, 1]))
    assert ends.tolist() == [1, 2, 3, 4, 5, 6] and agree.all()
    ends, agree = refined_ends(np.array([0, 4, 5]), np.array([4, 5, 7]), np.array([2, 1, 2]))
    assert agree.tolist() == [False, True, True] and ends.tolist()[1:] == [5, 7]


def test_book_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(token_align, "REMEMBERED", 12)
    book = Book(A, B)
    for k in range(12):
        texts = [f"the cat {' '.join(f'w{k}x{i}' for i in range(k))} sat", "the mat"]
        payload, pairs, n = aligned_slice(pa.array([0, 1], pa.int64()), pa.array(texts, pa.string()), book, True)
        for r, (_, a, b, g, links, _, total, groups) in zip(token_align.finished(payload, n, np.zeros(len(n), bool)).to_pylist(), brute(list(enumerate(texts))), strict=True):
            assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["count_sum"], r["groups"]) == (a, b, g, links, total, ";".join(groups))
    assert len(book.chunks) < 40
