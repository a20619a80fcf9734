"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text is lower-cased, every run of other characters than letters counts as
one boundary, and its character 1- to 4-grams are hashed into ``BUCKETS``.
The text's vector is the average of its subwords' embeddings; a linear
softmax gives the languages.  Embeddings and softmax are trained together by
stochastic gradient descent in numpy on a bounded sample: rows are drawn by
a hash of their id, about ``SAMPLE_PER_LANG`` for each language value.  A
quarter of the sample is kept back for calibration: a temperature is fitted
to it, and a prediction is rejected under ``min(MAX_THRESHOLD,
REJECT_QUANTILE of the right calibration scores)``.

For prediction the embedding and the softmax are multiplied into one table
(bucket x language), so a text costs one count of its subwords.  The table
is the only thing sent to tasks (``BUCKETS`` x languages floats).

Defined results: null text, or text with no letter, gives ``und`` with score
0, rejected.  Without any labelled row every text is ``und``; with one
language every text with a letter gets it.  A null ``doc_id`` is not held
out.  Repeated rows are predicted alike; other columns are kept.  Whole
texts are used in training and prediction.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, uniform

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
DIM = 16
EPOCHS = 12
BATCH = 16
RATE = 20.0
SAMPLE_PER_LANG = 400
MAX_THRESHOLD = 0.5
REJECT_QUANTILE = 0.001
SEED = 7
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def subword_counts(text: str | None) -> np.ndarray | None:
    """Subword counts by bucket, or None if the text has no letter."""
    if not text:
        return None
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[a]
    if not letter.any():
        return None
    a = np.where(letter, a, 32).astype(np.uint32)
    a = a[np.concatenate(([True], (a[1:] != 32) | (a[:-1] != 32)))]  # one boundary for a run
    a = np.concatenate((np.array([32], np.uint32), a, np.array([32], np.uint32)))
    counts = np.zeros(BUCKETS)
    h = np.zeros(len(a), np.uint32)
    for n in range(1, 5):
        if len(a) < n:
            break
        h = h[: len(a) - n + 1] * np.uint32(0x01000193) + a[n - 1:]
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
        counts += np.bincount(mixed >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)
    return counts


@dataclass(frozen=True)
class Model:
    """``table`` maps subword counts to logits; empty ``langs``: knows nothing."""

    langs: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    threshold: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts = subword_counts(text) if self.langs else None
        if counts is None:
            return UNKNOWN, 0.0, True
        logits = counts @ self.table / counts.sum() + self.bias
        e = np.exp(logits - logits.max())
        best = int(e.argmax())
        score = float(e[best] / e.sum())
        return self.langs[best], score, score < self.threshold


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """Train on (lang, buckets, shares) samples; shares of a sample add up to 1."""
    langs = tuple(sorted({s[0] for s in samples}))
    c = len(langs)
    if not c:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    rng = np.random.default_rng(SEED)
    y = np.array([langs.index(s[0]) for s in samples])
    order = rng.permutation(len(samples))
    held, train = order[: len(order) // 4], order[len(order) // 4:]
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    out, bias = rng.uniform(-1, 1, (DIM, c)), np.zeros(c)
    steps, step = EPOCHS * max(1, -(-len(train) // BATCH)), 0
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for at in range(0, len(train), BATCH):
            rate = RATE * (1 - step / steps)
            step += 1
            part = train[at: at + BATCH]
            v = np.stack([samples[i][2] @ emb[samples[i][1]] for i in part])
            g = _softmax(v @ out + bias)
            g[np.arange(len(part)), y[part]] -= 1
            g /= len(part)
            back = g @ out.T
            out -= 0.1 * rate * (v.T @ g)
            bias -= 0.01 * rate * g.sum(axis=0)
            for k, i in enumerate(part):
                emb[samples[i][1]] -= rate * samples[i][2][:, None] * back[k]
    table = emb @ out
    heat, threshold = 1.0, 0.0
    if len(held):
        z = np.stack([samples[i][2] @ table[samples[i][1]] for i in held]) + bias
        grid = np.geomspace(0.25, 4, 40)
        loss = [-np.log(_softmax(z / t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in grid]
        heat = float(grid[int(np.argmin(loss))])
        p = _softmax(z / heat)
        right = p.max(axis=1)[p.argmax(axis=1) == y[held]]
        threshold = min(MAX_THRESHOLD, float(np.quantile(right, REJECT_QUANTILE))) if len(right) else 0.0
    return Model(langs, table / heat, bias / heat, threshold)


def held_out(doc_id: Column) -> Column:
    """Whether the id's crc32, as text, is 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Fit a model on the rows with a language that are not held out."""
    labelled = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}  # one row a language
    if not counts:
        return fit([])
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_lang / n))])
    # Each row has its own draw, also among rows without an id or with equal ones.
    own = uniform(F.col("doc_id"), F.xxhash64("text"), F.col("__row"), seed=SEED)
    drawn = labelled.withColumn("__row", F.monotonically_increasing_id()).where(
        own < F.element_at(share, F.col("lang"))).select("lang", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(lang, subword_counts(text)) for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist(), strict=True)]
            rows = [(lang, np.flatnonzero(n), n) for lang, n in rows if n is not None]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1].astype("<u2").tobytes() for r in rows], pa.binary()),
                pa.array([(r[2][r[1]] / r[2].sum()).astype("<f4").tobytes() for r in rows], pa.binary()),
            ], names=["lang", "buckets", "shares"])

    rows = drawn.mapInArrow(features, "lang string, buckets binary, shares binary").collect()
    samples = [(r[0], np.frombuffer(r[1], "<u2").astype(np.int64), np.frombuffer(r[2], "<f4").astype(float)) for r in rows]
    samples.sort(key=lambda s: (s[0], s[1].tobytes(), s[2].tobytes()))  # tasks end in any order
    return fit(samples)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with struct column ``__lang`` (lang_pred, score, rejected)."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    return docs.withColumn("__lang", predict.asNondeterministic()(F.col("text")))  # evaluated once


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "__lang.lang_pred", "__lang.score", "__lang.rejected")
