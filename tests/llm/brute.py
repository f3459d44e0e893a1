"""Plain-Python versions that the operators are held against."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, n=5):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def jaccard_components(docs):
    """{(doc_id, n_shingles): component} over (doc_id, text) rows; all pairs."""
    rows = [(i, shingle_set(t)) for i, t in docs]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(rows):
        for j, t in rows[:k]:
            if i is not None and j is not None and linked(s, t):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in rows), key=repr)


def next_texts(docs):
    """[(doc_id, text, next text)] by descending id, ties by descending text, null ids last."""
    order = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    return [(i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order)]
