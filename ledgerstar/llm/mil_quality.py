"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE_WORDS` words.  Every passage of the
whole text is encoded (character shapes, byte n-grams and counts, then a
learned layer); gated attention, learned from document labels alone, weighs
the passages; the weighted representation is scored.  So one bad stretch of a
long text can decide, and its weight tells which one it was.

The model is fitted on a bounded sample: labelled documents in the order of a
hash of the id, each with all its passages, until there are `MAX_LABELLED`
documents or `MAX_PASSAGES` passages (the last document is taken whole too).
Scoring takes every passage of every text.

Defined results: a null text or one without a word has no passage and gets the
share of label 1 among the labelled (0.5 without labels); a document with
several labels has the largest; with labels of one kind only every document
gets their share; repeated rows are scored alike; an empty table gives an empty
result; other columns are kept unless they have a name that is added here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .ecoc_langid import in_fold
from .shared import table, without, word_count
from .textscan import give_back, mixed, slices, string_bytes, word_hashes, words

PASSAGE_WORDS = 48
MAX_LABELLED = 3000
MAX_PASSAGES = MAX_LABELLED * 48
GRAMS = 112
SHAPES = 128
STATS = 16
FEATURES = STATS + SHAPES + GRAMS
HIDDEN, GATE = 32, 16
THRESHOLD = 0.3
HELD_OUT = 0

# Classes of bytes: lower case, upper case, digit, space, line feed, beyond ASCII; marks are each their own.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a"): ord("z") + 1] = ord("a")
_CLASS[ord("A"): ord("Z") + 1] = ord("A")
_CLASS[ord("0"): ord("9") + 1] = ord("0")
_CLASS[128:] = ord("a")
_CLASS[[9, 11, 12, 13]] = 32


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features, offsets): a row per passage of every text."""
    data, at = string_bytes(texts)
    starts, ends, first = words(data, at)
    count = np.diff(first)
    made = -(-count // PASSAGE_WORDS)
    offsets = np.concatenate([[0], np.cumsum(made)])
    n = int(offsets[-1])
    if not n:
        return np.zeros((0, FEATURES), np.float32), offsets
    doc = np.repeat(np.arange(len(made)), made)
    first_word = first[doc] + (np.arange(n) - offsets[doc]) * PASSAGE_WORDS
    n_words = np.minimum(PASSAGE_WORDS, first[doc + 1] - first_word)
    of_word = np.repeat(np.arange(n), n_words)  # words stand in order, so passages do
    begin, end = starts[first_word], ends[first_word + n_words - 1]
    size = end - begin
    of_byte = np.repeat(np.arange(n), size)
    own = np.concatenate([[0], np.cumsum(size)])
    text = data[np.arange(own[-1]) - own[of_byte] + begin[of_byte]]

    def share(mask, of, total):
        return np.bincount(of[mask], minlength=n) / total

    hashes = word_hashes(data, starts, ends)
    same_next = np.zeros(len(hashes), bool)
    same_next[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    keyed = mixed(hashes ^ (of_word.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keyed)
    fresh = np.concatenate([[True], keyed[order][1:] != keyed[order][:-1]])
    runs = np.diff(np.append(np.flatnonzero(fresh), len(order)))
    commonest = np.zeros(n)
    np.maximum.at(commonest, of_word[order][fresh], runs)
    # runs of three words met before in the document: repeated lines
    word_doc = doc[of_word]
    three = np.zeros(len(hashes), bool)
    three[2:] = word_doc[2:] == word_doc[:-2]
    run = np.zeros(len(hashes), np.uint64)
    run[2:] = mixed(hashes[2:] * np.uint64(3) ^ mixed(hashes[1:-1]) * np.uint64(5) ^ mixed(hashes[:-2] + np.uint64(7)) ^ mixed(word_doc[2:].astype(np.uint64)))
    place = np.lexsort((np.arange(len(run)), run))
    again = np.zeros(len(run), bool)
    again[place[1:]] = (run[place[1:]] == run[place[:-1]]) & three[place[1:]] & three[place[:-1]]
    kind = _CLASS[text]
    is_mark = (kind < 128) & ~np.isin(kind, [ord("a"), ord("A"), ord("0"), 32, 10])
    length = (ends - starts).astype(float)
    out = np.zeros((n, FEATURES))
    out[:, 0] = np.bincount(of_word[order][fresh], minlength=n) / n_words
    out[:, 1] = share(same_next, of_word, n_words)
    out[:, 2] = commonest / n_words
    out[:, 3] = share(again, of_word, n_words)
    out[:, 4] = np.log1p(n_words)
    out[:, 5] = np.bincount(of_word, length, minlength=n) / n_words / 10
    out[:, 6] = np.sqrt(np.maximum(np.bincount(of_word, length**2, minlength=n) / n_words - (10 * out[:, 5]) ** 2, 0)) / 10
    for i, c in enumerate((ord("A"), ord("0"), 32, 10)):
        out[:, 7 + i] = share(kind == c, of_byte, size)
    out[:, 11] = share(is_mark, of_byte, size)
    out[:, 12] = share(text >= 128, of_byte, size)
    out[:, 13] = share(length == 1, of_word, n_words)
    out[:, 14] = share(length > 20, of_word, n_words)
    out[:, 15] = np.log1p(size) / 10

    def grams(values, dims, k, salt):
        code = values[: len(values) - k + 1].astype(np.uint32)
        for i in range(1, k):
            code = code * np.uint32(263) + values[i: len(values) - k + 1 + i]
        code = (code + np.uint32(salt)) * np.uint32(0x85EBCA6B)
        slot = ((code ^ (code >> np.uint32(13))).astype(np.uint64) * np.uint64(dims)) >> np.uint64(32)
        inside = of_byte[: len(code)] == of_byte[k - 1:]
        return np.bincount(of_byte[: len(code)][inside] * dims + slot[inside].astype(np.int64), minlength=n * dims).reshape(n, dims)

    out[:, STATS: STATS + SHAPES] = np.sqrt((grams(kind, SHAPES, 2, 1) + grams(kind, SHAPES, 3, 2)) / size[:, None])
    out[:, STATS + SHAPES:] = np.sqrt(grams(text, GRAMS, 3, 3) / size[:, None])
    return out.astype(np.float32), offsets


def _segment_softmax(x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    bag = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    e = np.exp(x - np.maximum.reduceat(x, offsets[:-1])[bag])
    return e / np.add.reduceat(e, offsets[:-1])[bag]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class AttentionModel:
    """Encoder, gated attention and scorer; `base` scores an empty bag."""

    base: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    p: dict[str, np.ndarray] | None = None

    def encoded(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.p["encode"] + self.p["encode0"])

    def attention(self, h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The passages' weights, summing to one in every (non-empty) bag."""
        return _segment_softmax((np.tanh(h @ self.p["v"]) * _sigmoid(h @ self.p["u"])) @ self.p["w"], offsets)

    def scores(self, x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.full(len(offsets) - 1, self.base)
        full = np.flatnonzero(np.diff(offsets))
        if self.p is not None and len(full):
            cuts = np.append(offsets[full], offsets[-1])
            h = self.encoded(x)
            z = np.add.reduceat(h * self.attention(h, cuts)[:, None], cuts[:-1], axis=0)
            out[full] = _sigmoid(z @ self.p["c"] + self.p["c0"])
        return out


def fitted(x: np.ndarray, offsets: np.ndarray, y: np.ndarray, epochs: int = 15, batch: int = 128, rate: float = 3e-3,
           decay: float = 1e-4, seed: int = 5) -> AttentionModel:
    """Fit on bags of passages (all non-empty) with labels y: the log loss of
    the documents, by Adam, through attention and encoder."""
    base = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or y.min() == y.max():
        return AttentionModel(base)
    rng = np.random.default_rng(seed)
    model = AttentionModel(base, x.mean(axis=0), x.std(axis=0) + 1e-3)
    x = ((x - model.mean) / model.scale).astype(np.float32)
    draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    p = {"encode": draw(x.shape[1], HIDDEN), "encode0": np.zeros(HIDDEN, np.float32), "v": draw(HIDDEN, GATE), "u": draw(HIDDEN, GATE),
         "w": draw(GATE), "c": draw(HIDDEN), "c0": np.full(1, np.log(base / (1 - base)), np.float32)}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step, steps = 0, epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for some in np.split(order, range(batch, len(order), batch)):
            sizes = np.diff(offsets)[some]
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            rows = np.arange(cuts[-1]) + np.repeat(offsets[some] - cuts[:-1], sizes)
            bag = np.repeat(np.arange(len(some)), sizes)
            xb = x[rows]
            h = np.tanh(xb @ p["encode"] + p["encode0"])
            t, s = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
            a = _segment_softmax((t * s) @ p["w"], cuts)
            z = np.add.reduceat(h * a[:, None], cuts[:-1], axis=0)
            off = (_sigmoid(z @ p["c"] + p["c0"]) - y[some]) / len(some)
            dz = off[:, None] * p["c"]
            pull = (h * dz[bag]).sum(axis=1)
            de = a * (pull - np.add.reduceat(a * pull, cuts[:-1])[bag])
            dt = de[:, None] * p["w"] * s * (1 - t * t)
            ds = de[:, None] * p["w"] * t * s * (1 - s)
            dh = (a[:, None] * dz[bag] + dt @ p["v"].T + ds @ p["u"].T) * (1 - h * h)
            grad = {"encode": xb.T @ dh, "encode0": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ off, "c0": off.sum(keepdims=True)}
            step += 1
            for k, g in grad.items():
                g = g + decay * p[k] * (k not in ("encode0", "c0"))
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                now = rate * 0.5 * (1 + np.cos(np.pi * step / steps))
                p[k] = (p[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    model.p = p
    return model


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", max_labelled: int = MAX_LABELLED, max_passages: int = MAX_PASSAGES) -> AttentionModel:
    """Fit on docs (id, text) that labels (id, quality) name.  What reaches the
    driver is the feature rows of at most max_labelled whole documents, and of
    only one beyond max_passages."""
    known = labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max("quality").alias("_y"))
    here = known.join(docs.select(F.col(id_col).alias("_id")), "_id", "left_semi")
    chosen = here.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    made = F.ceil(word_count(F.col("text")) / PASSAGE_WORDS)
    sizes = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("_id")).groupBy("_id", "_y").agg(F.sum(made).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(F.xxhash64("_id"), "_id").rowsBetween(Window.unboundedPreceding, -1))  # over max_labelled rows
    chosen = sizes.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < max_passages).select("_id", "_y")
    rows = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("_id")).select(F.col("_id").cast("long").alias("id"), F.col("_y").cast("double").alias("y"), "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["text"]):
                part = batch.slice(a, b - a)
                x, at = passages(part["text"])
                bags = [x[i:j].astype("<f2").tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part["id"], part["y"], pa.array(bags, pa.binary())], names=["id", "y", "x"])

    got = rows.mapInArrow(features, "id long, y double, x binary").toArrow()
    bags = sorted(((i, raw, y) for i, y, raw in zip(*[got[c].to_pylist() for c in ("id", "y", "x")], strict=True) if raw))
    if not bags:
        return fitted(np.zeros((0, FEATURES), np.float32), np.zeros(1, np.int64), np.zeros(0))
    x = np.frombuffer(b"".join(b[1] for b in bags), "<f2").reshape(-1, FEATURES).astype(np.float32)
    offsets = np.concatenate([[0], np.cumsum([len(b[1]) // (2 * FEATURES) for b in bags])])
    return fitted(x, offsets, np.array([float(b[2] > 0) for b in bags]))


def scored(docs: DataFrame, model: AttentionModel, text: str = "text") -> DataFrame:
    """docs plus quality_score (0 to 1)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of parameters

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [sent.value.scores(*passages(texts.slice(a, b - a))) for a, b in slices(texts)]
        give_back()
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return without(docs, "quality_score").withColumn("quality_score", score(F.coalesce(F.col(text), F.lit(""))))


def op3_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = trained(docs, table(spark, sf_dir, "labels", "doc_id", "quality").where(~in_fold("doc_id", 5, HELD_OUT)))
    out = scored(docs, model)
    return out.select("doc_id", in_fold("doc_id", 5, HELD_OUT).alias("held_out"), F.col("quality_score").alias("score"),
                      (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))
