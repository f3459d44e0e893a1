"""Language identification by error-correcting output codes.

Every learned language has a codeword of bits; one logistic classifier per bit,
over hashed byte n-gram frequencies of the whole text, predicts it.  Decoding
takes the language whose codeword has the least weighted logistic loss; a bit's
weight for a language is how well its classifier does on that language.  A
document whose two best languages are close is flagged as ambiguous.  One that
fits no codeword (its least loss lies beyond a bound learned from the losses of
labelled rows under classifiers fitted without them) keeps its nearest language,
and `lang_fits` is false.  The bound is loose, and wider for texts of few n-grams.

The classifiers are fitted on a bounded sample of labelled rows, chosen by hash
of the id: `per_language` rows of every language, or with many languages an
equal part of `FIT_ROWS` each, `LEAST_ROWS` at least.  No language is left out;
everything else covers all rows.

Defined results: a null text or one without a letter is `und` with score 0 and
fits nothing; a null lang is no label; with no labelled row every document
is `und` and texts with letters fit; with labels too few for a bound all fit; with one
language every document with a letter gets it, score 1; ties go to the first
language; repeated rows are scored alike; an empty table gives an empty result;
other columns are kept in scored() unless they have a name that it adds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .shared import table, without
from .textscan import give_back, slices, string_bytes

FEATURES = 2048
PER_LANGUAGE = 1200
FIT_ROWS, LEAST_ROWS = 24_000, 20
UNKNOWN = "und"
SHORT = 20  # bytes of text for which the bound is twice as wide
USUAL, SLACK = 0.999, 1.1  # the bound: this quantile of the labelled rows' losses times the slack,
LEAST_BOUND = np.log(2) / 2  # and no less than half the loss of bits that say nothing
MARGIN = 0.2  # ambiguous: the best language's share is below that of the next plus this
HELD_OUT = 2

# Bytes of letters stay (capitals are lower-cased before); all other ASCII is one separator.
_LETTER = np.full(256, 32, np.uint8)
_LETTER[ord("a"): ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[128:] = np.arange(128, 256)


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def ngram_features(texts: pa.Array, dims: int = FEATURES) -> np.ndarray:
    """Square roots of the shares of hashed byte 2-, 3- and 4-grams of every
    text, unit length; a text without any has all zeros."""
    data, offsets = string_bytes(pc.utf8_lower(texts))
    n = len(offsets) - 1
    # a separator before and after every text, so that no gram spans two
    size = np.diff(offsets)
    out = np.full(int(offsets[-1]) + 2 * n, 32, np.uint8)
    owner = np.repeat(np.arange(n), size + 2)
    out[np.arange(offsets[-1]) + 2 * np.repeat(np.arange(n), size) + 1] = _LETTER[data]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 32) | (out[:-1] != 32) | (owner[1:] != owner[:-1])
    out, owner = out[keep].astype(np.uint32), owner[keep]
    counts = np.zeros(n * dims)
    code = out
    for k in (2, 3, 4):
        if len(out) < k:
            break
        code = code[:-1] * np.uint32(257) + out[k - 1:]
        spread = (code + np.uint32(k)) * np.uint32(0x9E3779B1)
        slot = (spread ^ (spread >> np.uint32(15))) & np.uint32(dims - 1)
        same = owner[: len(code)] == owner[k - 1:]
        counts += np.bincount(owner[: len(code)][same] * dims + slot[same], minlength=n * dims)
    counts = np.sqrt(counts.reshape(n, dims))
    return (counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """(languages, bits) of -1 and 1: all splits of up to seven languages,
    for more the best separated of 200 random codes of 10 log2(n) bits."""
    if n <= 7:
        splits = range(1, 1 << max(n - 1, 0))
        return np.array([[1 if s >> max(n - 1 - i, 0) & 1 and i else -1 for s in splits] for i in range(n)], np.int8).reshape(n, -1)
    rng, best, apart = np.random.default_rng(seed), None, -1
    bits = int(np.ceil(10 * np.log2(n)))
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        code[0, np.abs(code.sum(axis=0)) == n] *= -1  # no bit is the same for all
        gram = code.astype(np.float32) @ code.T.astype(np.float32)
        far = int((bits - np.where(np.eye(n, dtype=bool), -bits, gram)).min()) // 2
        if far > apart:
            best, apart = code, far
    return best


def fit_bits(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 300, decay: float = 1e-5, rate: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Weighted logistic regressions of all bits at once (Adam on the full
    sample): coefficients (features, bits) and intercepts."""
    w, b = np.zeros((x.shape[1], y.shape[1])), np.zeros(y.shape[1])
    moments = [np.zeros_like(p) for p in (w, w, b, b)]
    weight = (weight / weight.sum())[:, None]
    for step in range(1, steps + 1):
        margin = y * (x @ w.astype(x.dtype) + b)
        pull = -y * weight / (1 + np.exp(np.clip(margin, -60, 60)))
        for p, g, m, v in ((w, x.T @ pull.astype(x.dtype) + decay * w, moments[0], moments[1]), (b, pull.sum(axis=0), moments[2], moments[3])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w, b


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    w: np.ndarray
    b: np.ndarray
    trust: np.ndarray  # (languages, bits), rows sum to one
    bound: float = np.inf  # no language fits beyond this loss

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Weighted loss of every language's codeword for feature rows."""
        margin = (x @ self.w.astype(np.float32)).astype(np.float64) + self.b
        # log(1 + e^m) = log(1 + e^-m) + m, so two products cover both signs of a bit
        return np.logaddexp(0, -margin) @ self.trust.T + margin @ (self.trust * (self.code < 0)).T

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(best language, its share, the next one's share) of feature rows."""
        return self.decided(x)[:3]

    def decided(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """decode() and the best language's loss."""
        loss = self.losses(x)
        least = loss.min(axis=1, keepdims=True)
        share = np.exp(least - loss)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        rows = np.arange(len(share))
        top = share[rows, best]
        share[rows, best] = -1
        return best, top, np.maximum(share.max(axis=1), 0), least[:, 0]


def fitted(languages: list[str], x: np.ndarray, y: np.ndarray) -> LanguageModel:
    """A model from feature rows x and language numbers y."""
    code = codewords(len(languages))
    if code.shape[1] == 0:
        return LanguageModel(languages, np.ones((len(languages), 1), np.int8), np.zeros((x.shape[1], 1)), np.full(1, 30.0), np.ones((len(languages), 1)))
    weight = 1 / np.bincount(y, minlength=len(languages))[y]  # languages count alike
    w, b = fit_bits(x, code[y].astype(np.float32), weight)
    right = (code[y] * (x @ w + b) > 0).astype(float)
    trust = np.array([right[y == i].mean(axis=0) for i in range(len(languages))])
    return LanguageModel(languages, code, w, b, trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-12))


def loss_bound(x: np.ndarray, y: np.ndarray) -> float:
    """The loss beyond which no language fits, from rows ordered by language:
    every other row is decoded by a model of the rest, languages that it lacks
    left out."""
    losses = [np.zeros(0)]
    for half in (0, 1):
        known, of_row = np.unique(y[half::2], return_inverse=True)
        rest = np.flatnonzero(np.isin(y[1 - half::2], known)) * 2 + 1 - half
        if len(known) > 1 and len(rest):
            losses.append(fitted([str(i) for i in known], x[half::2], of_row).losses(x[rest]).min(axis=1))
    losses = np.concatenate(losses)
    return max(SLACK * float(np.quantile(losses, USUAL)), LEAST_BOUND) if len(losses) else np.inf


def trained(labelled: DataFrame, id_col: str = "doc_id", per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Fit on rows of (id, text, lang) of every language.  Rows are chosen by id
    alone; what reaches the driver is their feature rows of FEATURES numbers:
    FIT_ROWS, or LEAST_ROWS a language where that is more."""
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = usable.groupBy("lang").count()
    equal = F.floor(F.lit(FIT_ROWS) / F.count(F.lit(1)).over(Window.partitionBy()))  # a window over one row a language
    sizes = sizes.withColumn("_k", F.least(F.lit(per_language), F.greatest(equal, F.lit(LEAST_ROWS))))
    # a share of each language by hash, ample for its rows, then exactly so many
    spot = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20)) / float(1 << 20)
    some = usable.select(F.col(id_col).alias("_id"), "lang", spot.alias("_p")).join(F.broadcast(sizes), "lang")
    some = some.where(F.col("_p") * F.col("count") < 1.2 * F.col("_k") + 100)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_p", "_id"))
    chosen = some.withColumn("_r", rank).where(F.col("_r") <= F.col("_k")).select("_id").distinct()
    rows = usable.join(F.broadcast(chosen), F.col(id_col) == F.col("_id"), "left_semi").select("lang", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch["text"], rows=256):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part["lang"], pa.array([v.astype("<f2").tobytes() for v in ngram_features(part["text"])], pa.binary())], names=["lang", "x"])

    got = rows.mapInArrow(features, "lang string, x binary").toArrow()
    if not got.num_rows:
        return None
    names = got["lang"].to_pylist()
    languages = sorted(set(names))
    x = np.frombuffer(b"".join(got["x"].to_pylist()), "<f2").reshape(-1, FEATURES).astype(np.float32)
    place = {v: i for i, v in enumerate(languages)}
    y = np.array([place[v] for v in names])
    order = np.lexsort((x[:, 0], x[:, 1], x[:, 2], y))  # the same sums however Spark dealt the rows
    x, y = x[order], y[order]
    model = fitted(languages, x, y)
    model.bound = loss_bound(x, y)
    return model


def scored(docs: DataFrame, model: LanguageModel | None, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """docs plus lang_pred, lang_score (0 to 1), ambiguous and lang_fits (whether
    some codeword fits the text; the bound is wider for texts of few n-grams,
    which say less).  Texts without letters fit none; without a model all do."""
    kept = without(docs, "lang_pred", "lang_score", "ambiguous", "lang_fits")
    letter = F.coalesce(F.regexp_like(F.col(text), F.lit(r"\p{L}")), F.lit(False))
    if model is None:
        return kept.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("lang_score", F.lit(0.0)).withColumn("ambiguous", F.lit(True)).withColumn("lang_fits", letter)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x bits and FEATURES x bits numbers

    @F.arrow_udf("lang_pred string, lang_score double, ambiguous boolean, lang_fits boolean")
    def predict(texts: pa.Array) -> pa.Array:
        m = sent.value
        parts = [m.decided(ngram_features(texts.slice(a, b - a))) for a, b in slices(texts, rows=256)]
        give_back()
        best, top, second, least = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, int), *[np.zeros(0)] * 3)
        grams = np.maximum(pc.binary_length(texts).to_numpy(zero_copy_only=False), 1)
        fits = least <= m.bound * (1 + (SHORT / grams) ** 2)
        return pa.StructArray.from_arrays([pa.array([m.languages[i] for i in best], pa.string()), pa.array(top), pa.array(top < second + margin), pa.array(fits)],
                                          names=["lang_pred", "lang_score", "ambiguous", "lang_fits"])

    out = kept.withColumn("_lang", F.when(letter, predict(F.coalesce(F.col(text), F.lit("")))))
    return out.withColumn("lang_pred", F.coalesce(F.col("_lang.lang_pred"), F.lit(UNKNOWN))).withColumn(
        "lang_score", F.coalesce(F.col("_lang.lang_score"), F.lit(0.0))).withColumn("ambiguous", F.coalesce(F.col("_lang.ambiguous"), F.lit(True))).withColumn(
        "lang_fits", F.coalesce(F.col("_lang.lang_fits"), F.lit(False))).drop("_lang")


def op4_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = trained(docs.where(~in_fold("doc_id", 4, HELD_OUT)))
    out = scored(docs.select("doc_id", "text"), model)
    return out.select("doc_id", in_fold("doc_id", 4, HELD_OUT).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "ambiguous")
