"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)),
which takes time linear in the number of features a text has.

Inputs of a text: log counts of its hashed words (unit length), statistics of its
structure, and the metadata columns the caller names (log of the number; missing
has an input of its own).  Labels, language, source and id are never inputs.

Defined cases: a null text is an empty one and is scored; a null, negative or
non-finite metadata value counts as missing; labels that are null, neither 0 nor 1,
or without a text are not learnt from; repeated label rows count once each; with no
usable label of one of the classes every score is the share of label 1 (0.5 with no label).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickroll.llm.common import Memo, encoded, query, rows_of, table

STRUCTURE = (
    "log_words", "word_length", "word_length_spread", "distinct_words", "top_word", "upper", "digits",
    "symbols", "bars", "line_breaks", "log_line_length", "repeated_lines", "non_ascii", "repeats", "empty",
)


@dataclass(frozen=True)
class Settings:
    """Size of the model and of its training.

    ``train_rows`` bounds the labelled rows learnt from: those with the smallest
    hash of their id are taken.
    """

    buckets: int = 1 << 14
    rank: int = 8
    train_rows: int = 6_000
    epochs: int = 30
    batch: int = 128
    rate: float = 0.02
    decay: float = 2e-5
    seed: int = 7
    metadata: tuple[str, ...] = ()


@dataclass
class Model:
    """Weights; ``dense`` inputs come behind the ``buckets`` of words."""

    settings: Settings
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))

    def score(self, buckets: np.ndarray, values: np.ndarray, dense: np.ndarray) -> float:
        s = self.settings
        x = np.concatenate([values, np.clip((dense - self.mean) / self.scale, -4, 4)])
        at = np.concatenate([buckets, np.arange(s.buckets, s.buckets + len(dense))])
        v = self.factors[at] * x[:, None]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v * v).sum(axis=0)).sum())
        z = self.bias + float(self.linear[at] @ x) + pairs
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


_UPPER, _DIGIT, _SYMBOL = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SYMBOL[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,'-|"]] = True


def word_buckets(buckets: int) -> Memo:
    return Memo(lambda w: xxhash.xxh3_64_intdigest(w) % buckets)


def inputs(raw: bytes, metadata: tuple, memo: Memo) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, their values, and the dense inputs of one text."""
    words = raw.lower().split()
    n = len(words)
    at = np.fromiter(map(memo.__getitem__, words), np.int64, n)
    buckets, counts = np.unique(at, return_counts=True)
    values = np.log1p(counts)
    values /= max(float(np.sqrt(values @ values)), 1e-9)
    size = max(len(raw), 1)
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / size
    lengths = np.fromiter(map(len, words), np.float64, n) if n else np.zeros(1)
    lines = raw.split(b"\n")
    dense = [
        math.log1p(n), float(lengths.mean()), float(lengths.std()), len(buckets) / max(n, 1) ** 0.8,
        float(counts.max() / n) if n else 0.0, float(by_byte[_UPPER].sum()), float(by_byte[_DIGIT].sum()),
        float(by_byte[_SYMBOL].sum()), float(by_byte[124]), float(by_byte[10]),
        math.log1p(size / len(lines)), 1 - len(set(lines)) / len(lines), float(by_byte[128:].sum()),
        float((at[1:] == at[:-1]).mean()) if n > 1 else 0.0, float(n == 0),
    ]
    for value in metadata:
        known = value is not None and math.isfinite(value) and value >= 0
        dense += [math.log1p(value) if known else 0.0, 0.0 if known else 1.0]
    return buckets, values, np.array(dense)


def _numbers(metadata: tuple[str, ...]) -> list[Column]:
    return [F.col(c).cast("double").alias(f"_m{i}") for i, c in enumerate(metadata)]


def train(documents: DataFrame, labels: DataFrame, settings: Settings = Settings(), *,
          text: str = "text", key: str = "doc_id", label: str = "quality") -> Model:
    """Fit the machine to at most ``settings.train_rows`` labelled rows."""
    usable = labels.select(F.col(key).alias("_k"), F.col(label).cast("int").alias("_y")).where(
        F.col("_k").isNotNull() & F.col("_y").isin(0, 1))
    # at most train_rows rows of two numbers each: small enough to send to every task
    chosen = usable.orderBy(F.xxhash64("_k"), "_k", "_y").limit(settings.train_rows)
    names = [f"_m{i}" for i in range(len(settings.metadata))]
    rows = documents.select(F.col(key).alias("_k"), F.col(text).alias("_t"), *_numbers(settings.metadata)).join(
        F.broadcast(chosen), "_k").where(F.col("_t").isNotNull())

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_buckets(settings.buckets)
        for k, y, t, *m in rows_of(batches, "_k", "_y", "_t", *names):
            buckets, values, dense = inputs(encoded(t), tuple(m), memo)
            yield pa.RecordBatch.from_pydict({
                "k": pa.array([str(k)]), "y": pa.array([y], pa.int32()),
                "at": pa.array([buckets.astype("<i4").tobytes()], pa.binary()),
                "x": pa.array([values.astype("<f4").tobytes()], pa.binary()),
                "d": pa.array([dense.astype("<f8").tobytes()], pa.binary())})

    learnt = rows.mapInArrow(features, "k string, y int, at binary, x binary, d binary").collect()
    learnt.sort(key=lambda r: (xxhash.xxh3_64_intdigest(r.k), r.k, r.y, bytes(r.at)))
    return fit([(np.frombuffer(r["at"], "<i4"), np.frombuffer(r.x, "<f4"), np.frombuffer(r.d, "<f8"), r.y)
                for r in learnt], settings)


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], settings: Settings) -> Model:
    """Adagrad on the logistic loss of rows (buckets, values, dense, label)."""
    n_dense = len(STRUCTURE) + 2 * len(settings.metadata)
    size, rng = settings.buckets + n_dense, np.random.default_rng(settings.seed)
    w, v = np.zeros(size), rng.normal(0, 0.01, (size, settings.rank))
    labels = np.array([r[3] for r in rows], float)
    share = float(labels.mean()) if len(rows) else 0.5
    mean, scale = np.zeros(n_dense), np.ones(n_dense)
    if share in (0.0, 1.0) or not rows:
        bias = 0.0 if not rows else (60.0 if share else -60.0)
        return Model(settings, bias, w, v * 0, mean, scale)
    dense = np.array([r[2] for r in rows])
    mean, scale = dense.mean(axis=0), np.maximum(dense.std(axis=0), 1e-3)
    dense = np.clip((dense - mean) / scale, -4, 4)
    tail = np.arange(settings.buckets, size)
    bias, g_b, g_w, g_v = math.log(share / (1 - share)), 1e-8, np.full(size, 1e-8), np.full(v.shape, 1e-8)
    for _ in range(settings.epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), settings.batch):
            some = order[start:start + settings.batch]
            at = np.concatenate([np.concatenate([rows[i][0], tail]) for i in some])
            x = np.concatenate([np.concatenate([rows[i][1], dense[i]]) for i in some])
            ends = np.cumsum([len(rows[i][0]) + n_dense for i in some])
            starts, owner = np.concatenate([[0], ends[:-1]]), np.repeat(np.arange(len(some)), np.diff(ends, prepend=0))
            vx = v[at] * x[:, None]
            sums = np.add.reduceat(vx, starts)
            z = bias + np.add.reduceat(w[at] * x, starts) + 0.5 * (
                (sums ** 2).sum(axis=1) - np.add.reduceat((vx ** 2).sum(axis=1), starts))
            loss = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels[some]) / len(some)
            each = loss[owner] * x
            used, inverse = np.unique(at, return_inverse=True)
            d_w = np.bincount(inverse, each, len(used)) + settings.decay * w[used]
            slope = each[:, None] * (sums[owner] - vx)
            d_v = np.stack([np.bincount(inverse, slope[:, f], len(used)) for f in range(settings.rank)], axis=1)
            d_v += settings.decay * v[used]
            g_b += float(loss.sum()) ** 2
            bias -= settings.rate * float(loss.sum()) / math.sqrt(g_b)
            g_w[used] += d_w ** 2
            w[used] -= settings.rate * d_w / np.sqrt(g_w[used])
            g_v[used] += d_v ** 2
            v[used] -= settings.rate * d_v / np.sqrt(g_v[used])
    return Model(settings, bias, w, v, mean, scale)


def scored(documents: DataFrame, model: Model, *, text: str = "text", out: str = "score") -> DataFrame:
    """The rows of ``documents`` with their score; a column named ``out`` is replaced."""
    # the model goes with the function, about a megabyte whatever the input
    @F.pandas_udf("double")
    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        memo = word_buckets(model.settings.buckets)
        for frame in frames:
            texts = frame["_t"].array
            metadata = [frame[c].array for c in frame.columns if c != "_t"]
            yield pd.Series([
                model.score(*inputs(encoded(t), tuple(None if pd.isna(m[i]) else float(m[i]) for m in metadata),
                                      memo))
                for i, t in enumerate(texts)], dtype="float64")

    return documents.withColumn(out, score(F.struct(
        F.coalesce(F.col(text), F.lit("")).alias("_t"), *_numbers(model.settings.metadata))))


PREDICT_AT = 0.7
"""Score from which a text counts as label 1."""

PRODUCTION = Settings(metadata=("n_chars",))


def held_out(key: str = "doc_id") -> Column:
    """Rows no label is learnt from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality_model(spark: SparkSession, sf_dir: str) -> Model:
    """The machine fitted to the labels that are not held out."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out())
    return train(table(spark, sf_dir, "documents", "doc_id", "text", "n_chars"), labels, PRODUCTION)


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "n_chars")
    scores = scored(documents, quality_model(spark, sf_dir))
    return scores.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
