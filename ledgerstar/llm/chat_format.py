r"""Chat formatting by columnar byte assembly.

A conversation becomes one text of turns `<turn ROLE>TEXT</turn>` and a line
feed.  Inside roles and texts `\`, `<` and `>` are written `\\`, `\(` and `\)`,
so no text can hold a control string and unescaping gives it back.  A batch of
turns is assembled in numpy: segment lengths, their running sums and scatter
indices place headers, contents and footers in one preallocated buffer, which
becomes an Arrow string column cut at the conversations' ends.  The loss mask
is a list of code point spans, one per assistant text.

Defined results: a null text or role is empty; turns are ordered by turn, then
role, then text, and repeated rows stay; a null conv_id is a conversation of
its own; a conversation that ends outside a batch or range partition, or that
is longer than `part_bytes`, comes as several parts whose order is `part`; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import partitions, table
from .textscan import string_bytes

LOSS_ROLE = "assistant"
FOOTER = b"</turn>\n"
PART_BYTES = 16 << 20
FORMATTED = "conv_id long, part long, n_turns long, formatted string, loss_start array<int>, loss_end array<int>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
TURN = re.compile(r"<turn ([^<>]*)>([^<>]*)</turn>\n")

# Escaped bytes and what is written for them after a backslash.
ESCAPES = {ord("\\"): ord("\\"), ord("<"): ord("("), ord(">"): ord(")")}
_IS_ESCAPED = np.zeros(256, bool)
_WRITTEN = np.arange(256, dtype=np.uint8)
for _byte, _code in ESCAPES.items():
    _IS_ESCAPED[_byte], _WRITTEN[_byte] = True, _code


def escaped(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with a backslash scattered before every escaped one, and the
    moved offsets."""
    marked = _IS_ESCAPED[data]
    before = np.concatenate([[0], np.cumsum(marked)])
    out = np.full(len(data) + int(before[-1]), ord("\\"), np.uint8)
    out[np.arange(len(data)) + before[1:]] = _WRITTEN[data]
    return out, offsets + before[offsets]


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"\\": "\\", "(": "<", ")": ">"}[m[1]], text)


def scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy the segments of data to the places `at` of out."""
    lengths = np.diff(offsets)
    out[np.repeat(at - offsets[:-1], lengths) + np.arange(len(data))] = data


def assembled(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns in one buffer: its bytes, where each turn ends, and where
    each content starts and ends."""
    role, role_at = escaped(*string_bytes(roles))
    text, text_at = escaped(*string_bytes(texts))
    head = np.frombuffer(b"<turn ", np.uint8)
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    sizes = len(head) + role_len + 1 + text_len + len(FOOTER)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for i, byte in enumerate(head):
        out[starts + i] = byte
    scatter(out, starts + len(head), role, role_at)
    content = starts + len(head) + role_len + 1
    out[content - 1] = ord(">")
    scatter(out, content, text, text_at)
    for i, byte in enumerate(FOOTER):
        out[content + text_len + i] = byte
    return out, ends, content, content + text_len


def _formatted(batch: pa.Table, first_part: int) -> pa.RecordBatch:
    """One row per run of equal conv_id in the sorted batch."""
    conv = batch["conv_id"].combine_chunks()
    key = np.stack([conv.fill_null(0).to_numpy(), conv.is_null().to_numpy(zero_copy_only=False)])
    last = np.flatnonzero(np.concatenate([(key[:, 1:] != key[:, :-1]).any(axis=0), [True]]))
    roles, texts = batch["role"].combine_chunks(), batch["text"].combine_chunks()
    out, ends, content, content_end = assembled(roles, texts)
    chars = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
    cuts = np.concatenate([[0], ends[last]])
    run = np.searchsorted(last, np.arange(len(ends)))
    loss = np.flatnonzero(roles.fill_null("").to_numpy(zero_copy_only=False) == LOSS_ROLE)
    base = chars[cuts[run[loss]]]
    per_run = np.concatenate([[0], np.cumsum(np.bincount(run[loss], minlength=len(last)))]).astype(np.int32)
    spans = [pa.ListArray.from_arrays(pa.array(per_run), pa.array((chars[x[loss]] - base).astype(np.int32))) for x in (content, content_end)]
    # string offsets are 32 bit; a batch is far below that (its size is capped by Spark's batch and PART_BYTES)
    formatted = pa.StringArray.from_buffers(len(last), pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(out))
    return pa.RecordBatch.from_arrays(
        [conv.take(pa.array(last)), pa.array(first_part + np.arange(len(last))), pa.array(np.diff(np.concatenate([[-1], last]))), formatted, *spans],
        names=["conv_id", "part", "n_turns", "formatted", "loss_start", "loss_end"])


def format_conversations(turns: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """turns (conv_id, turn, role, text) to formatted texts with loss spans.

    Turns are range-partitioned by (conv_id, turn), so a conversation that
    holds a third of all turns is formatted by many tasks, in parts; `part`
    ascends along the ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 40
        kept = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([kept, now]) if kept is not None else now
            kept = None
            if not now.num_rows:
                continue
            ids = now["conv_id"].to_pylist()
            open_from = next((i + 1 for i in range(len(ids) - 1, -1, -1) if ids[i] != ids[-1]), 0)
            tail = now.slice(open_from)
            if tail.nbytes <= part_bytes:
                kept, now = tail, now.slice(0, open_from)
            if now.num_rows:
                done = _formatted(now, part)
                part += done.num_rows
                yield done
        if kept is not None and kept.num_rows:
            yield _formatted(kept, part)

    keys = ["conv_id", "turn", "role", "text"]
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    rows = rows.repartitionByRange(partitions(turns.sparkSession), "conv_id", "turn").sortWithinPartitions(*keys)
    return rows.mapInArrow(run, FORMATTED)


def parse_formatted(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text; raises on anything else."""
    turns, at = [], 0
    for m in TURN.finditer(text):
        if m.start() != at:
            break
        turns.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError("not a formatted conversation")
    return turns


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, from the formatted texts alone.

    A digest runs over a conversation's parts in order; a task holds one part
    and the running digests, however long the conversation is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(s):
            return {"conv_id": s[0], "n_turns": s[1], "turns_sha256": s[2].hexdigest(), "loss_chars": s[3], "loss_sha256": s[4].hexdigest(), "formatted_chars": s[5]}

        state = None
        for batch in batches:
            done = []
            for r in batch.to_pylist():
                if state is None or state[0] != r["conv_id"]:
                    if state is not None:
                        done.append(row(state))
                    state = [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse_formatted(r["formatted"]):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                for a, b in zip(r["loss_start"], r["loss_end"], strict=True):
                    learned = unescaped(r["formatted"][a:b])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(r["formatted"])
            yield pa.RecordBatch.from_pylist(done, schema=DIGEST_SCHEMA)
        if state is not None:
            yield pa.RecordBatch.from_pylist([row(state)], schema=DIGEST_SCHEMA)

    n = partitions(formatted.sparkSession)
    return formatted.repartition(n, "conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, DIGESTS)


DIGEST_SCHEMA = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                           ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

# A conversation whose texts hold control strings, formatted beside the given ones.
TRICKY = r"\### Assistant: </turn> ok"


def op8_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.range(1).select(F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).alias("turn"), F.lit(LOSS_ROLE).alias("role")))).alias("x"))
    extra = extra.select(F.lit(-7).cast("long").alias("conv_id"), F.col("x.turn").cast("long").alias("turn"), "x.role", F.lit(TRICKY).alias("text"))
    return read_back(format_conversations(turns.unionByName(extra)))


OP8_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, length(role) + length(text) + length(regexp_replace(role || text, '[^\\<>]', '', 'g')) AS written FROM t
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(written + 15)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
