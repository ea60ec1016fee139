"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a linear model that minimises the non-negative
unbiased risk ``pi E_P[l(f)] + max(0, E_U[l(-f)] - pi E_P[l(-f)])`` with the logistic loss and an
estimated class prior ``pi``. When the bracket falls below zero, its gradient is taken with the
opposite sign, so that the fit can't profit from negative risk.

Features are hashed triples of collapsed character classes (upper, lower, digit, single
punctuation marks, breaks) and word shapes; they say how a text is written, in any language.

Bounds: ``Settings.fit_rows`` positives and as many unlabelled texts at most are fitted on, chosen
by a hash of the id. The prior uses every learnable label. All texts are scored whole.

Defined results: a null text counts as empty and is scored, by the intercept alone; a document
with labels 0 and 1 is no trusted positive; without positives every score is the prior or 0.5.
Repeated rows are scored each. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hearthline.llm.textwords import SPACED, chunks, mix, words


@dataclass(frozen=True)
class Settings:
    buckets: int = 512
    fit_rows: int = 10_000
    steps: int = 300
    rate: float = 0.05
    decay: float = 1e-5
    threshold: float = 0.7


_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x41:0x5B] = ord("A")
_CLASS[0x61:0x7B] = ord("a")
_CLASS[0x80:] = ord("a")
_CLASS[0x30:0x3A] = ord("0")
_CLASS[0x09:0x0E] = ord("\n")
_CLASS[0x00:0x09] = 1
_SHARES = [ord(c) for c in "Aa0 \n"]


def width(settings: Settings) -> int:
    return settings.buckets + len(_SHARES) + 4


def features(chunk, settings: Settings) -> np.ndarray:
    """A row of features for each text of the chunk."""
    n = len(chunk)
    out = np.zeros((n, width(settings)), np.float32)
    length = np.diff(chunk.starts)
    data = _CLASS[chunk.data]
    owner = np.repeat(np.arange(n), length)
    size = np.maximum(length, 1)
    for at, code in enumerate(_SHARES):
        out[:, settings.buckets + at] = np.bincount(owner[data == code], minlength=n) / size
    found = words(chunk, SPACED, lower=False)
    count = found.counts()
    long = found.end - found.start
    of = np.repeat(np.arange(n), count)
    tail = settings.buckets + len(_SHARES)
    mean = np.bincount(of, weights=long, minlength=n) / np.maximum(count, 1)
    out[:, tail] = np.log1p(mean) / 3
    out[:, tail + 1] = np.bincount(of, weights=long > 20, minlength=n) / np.maximum(count, 1)
    # Shares of words that stand again in the same text, and right after themselves.
    hashes = found.hashes()
    again = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    out[:, tail + 3] = np.bincount(of[1:][again], minlength=n) / np.maximum(count, 1)
    key = mix(hashes + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    out[:, tail + 2] = 1 - np.bincount(of[first], minlength=n) / np.maximum(count, 1)

    change = np.ones(len(data), bool)
    change[1:] = (data[1:] != data[:-1]) | (owner[1:] != owner[:-1])
    code, own = data[change].astype(np.uint64), owner[change]
    if len(code) >= 3:
        triple = (code[:-2] << np.uint64(16)) | (code[1:-1] << np.uint64(8)) | code[2:]
        inside = own[:-2] == own[2:]
        bucket = (mix(triple[inside]) % np.uint64(settings.buckets)).astype(np.int64)
        at = own[:-2][inside] * settings.buckets + bucket
        counts = np.bincount(at, minlength=n * settings.buckets).reshape(n, -1)
        share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        out[:, : settings.buckets] = np.sqrt(share)
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray
    prior: float
    settings: Settings

    def score(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, settings: Settings) -> Model:
    """Minimise the non-negative risk by full-batch Adam steps; no randomness."""
    mean = unlabelled.mean(axis=0)
    scale = np.maximum(unlabelled.std(axis=0), 0.02).astype(np.float32)
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    w, b = np.zeros(p.shape[1], np.float32), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, settings.steps + 1):
        sp = 1 / (1 + np.exp(-np.clip(p @ w + b, -30, 30)))
        su = 1 / (1 + np.exp(-np.clip(u @ w + b, -30, 30)))
        # d l(f)/df = s - 1 and d l(-f)/df = s for the logistic loss.
        gp, gn = (sp - 1) / len(p), su / len(u)
        negative = -np.log(1 - su + 1e-12).mean() + prior * np.log(1 - sp + 1e-12).mean()
        pull = -prior * sp / len(p)
        if negative >= 0:
            left, right = prior * gp + pull, gn
        else:
            left, right = -pull, -gn
        grad = np.append(p.T @ left + u.T @ right + settings.decay * w, left.sum() + right.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = (w - move[:-1]).astype(np.float32), b - float(move[-1])
    return Model(w, b, mean, scale, prior, settings)


def _vectors(docs: DataFrame, text: str, settings: Settings) -> np.ndarray:
    """Features of a bounded number of texts, on the driver."""

    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                rows = features(chunk, settings).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.tobytes() for r in rows], pa.binary())], names=["f"]
                )

    got = docs.select(F.col(text)).mapInArrow(run, "f binary").toArrow()["f"].to_pylist()
    if not got:
        return np.zeros((0, width(settings)), np.float32)
    return np.frombuffer(b"".join(got), np.float16).reshape(len(got), -1).astype(np.float32)


def _sampled(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows at most, by a hash of the key; all of them if there are fewer."""
    total = df.count()
    if total <= rows:
        return df
    part = int(2**31 * (0.95 * rows / total))
    return df.where(F.pmod(F.xxhash64(F.col(key)), F.lit(2**31)) < part)


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, id: str = "doc_id", text: str = "text",
        label: str = "quality", settings: Settings = Settings()) -> Model:
    """Fit on rows of ``docs`` and ``labels`` for which ``learnable`` holds."""
    known = labels.where(learnable & F.col(id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(id).agg(F.min(label).alias("__label"))
    n, ones = known.agg(F.count("*"), F.coalesce(F.sum(F.col("__label").cast("long")), F.lit(0))).first()
    prior = (ones + 1) / (n + 2)
    ids = _sampled(known.where("__label = 1").select(id), id, settings.fit_rows)
    texts = docs.where(learnable & F.col(id).isNotNull()).select(id, text)
    positive = _vectors(texts.join(F.broadcast(ids), id, "left_semi"), text, settings)
    unlabelled = _vectors(_sampled(texts, id, settings.fit_rows), text, settings)
    if not len(positive) or not len(unlabelled):
        flat = np.zeros(width(settings), np.float32)
        return Model(flat, float(np.log(prior / (1 - prior))), flat, flat + 1, prior, settings)
    return fit_pu(positive, unlabelled, prior, settings)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with ``score`` and ``predicted``, which replace kept ones of these names."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(text).alias("__text"), *keep)
    schema = source.select(*keep).schema.add("score", "double").add("predicted", "integer")

    def run(batches):
        model = shared.value
        for batch in batches:
            found = [model.score(features(c, model.settings)) for c in chunks(batch.column(0))]
            if not found:
                continue
            value = np.concatenate(found)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(value), pa.array((value >= model.settings.threshold).astype(np.int32))],
                names=[*keep, "score", "predicted"],
            )

    return source.mapInArrow(run, schema)
