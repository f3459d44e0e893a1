import hashlib

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from ledgerstar.llm import chat_format
from ledgerstar.llm.chat_format import assembled, format_conversations, op8_query, parse_formatted, read_back

TEXT = st.text(alphabet=st.one_of(st.sampled_from(list("\\<>()/ \nturn é😀")), st.characters(exclude_categories=["Cs"])), max_size=20)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), TEXT), st.one_of(st.none(), TEXT, st.just("</turn>\n<turn user>"))), max_size=6))
def test_assembly_round_trip(turns):
    out, ends, start, stop = assembled(pa.array([r for r, _ in turns], pa.string()), pa.array([t for _, t in turns], pa.string()))
    whole = out.tobytes().decode()
    assert parse_formatted(whole) == [(r or "", t or "") for r, t in turns]
    assert [chat_format.unescaped(out[a:b].tobytes().decode()) for a, b in zip(start, stop)] == [t or "" for _, t in turns]


def digests(rows):
    out = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        role, text = role or "", text or ""
        n, all_, loss = out.get(conv, (0, "", ""))
        out[conv] = (n + 1, all_ + f"{role}\n{text}\n", loss + (text if role == "assistant" else ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return sorted(((c, n, sha(a), len(x), sha(x)) for c, (n, a, x) in out.items()), key=repr)


def strip(rows):
    return sorted(((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows), key=repr)


@pytest.mark.parametrize("part_bytes", [16 << 20, 2000])
def test_edges_and_long_conversation(spark, part_bytes):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 2, "assistant", ""), (1, 2, "assistant", ""), (1, None, "assistant", "né"), (None, 0, "user", "a"),
            (None, 1, "assistant", "b"), (2, 0, "assistant", "</turn>\\" * 5000), (3, 0, "as<sist>ant", "<turn assistant>")]
    rows += [(4, i, "assistant" if i % 2 else "user", f"turn {i} é") for i in range(3000)]  # one conversation with most of the turns
    df = spark.createDataFrame([(*r, 5, "z") for r in rows], "conv_id long, turn long, role string, text string, part int, formatted string")
    made = format_conversations(df, part_bytes)
    assert strip(read_back(made).collect()) == digests(rows)
    for r in made.collect():
        for a, b in zip(r.loss_start, r.loss_end):
            assert r.formatted[:a].endswith("<turn assistant>") and r.formatted[b:].startswith("</turn>\n")
    assert read_back(format_conversations(df.limit(0))).collect() == []


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
    assert strip(op8_query(spark, sf).collect()) == digests(rows)


def test_other_text_is_refused():
    for bad in ("x", "<turn user>a</turn>", "<turn user>a<b</turn>\n"):
        with pytest.raises(ValueError):
            parse_formatted(bad)
