"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A document's features are the distinct hashed n-grams of its whole lower-cased
text. Each feature is scaled by the log ratio of its smoothed frequency among
toxic and other training documents, and a logistic regression learns how far
to trust the scaled features. Training sees a bounded labelled sample; scoring
runs in batches over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import held_out, sigmoid, training_rows

ORDERS = (3, 4, 5)
BITS = 18
PER_CLASS = 1500
SMOOTHING = 1.0
PENALTY = 1e-4
STEPS = 100
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)


@dataclass(frozen=True)
class LinearModel:
    weights: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> float:
        return float(sigmoid(self.bias + float(self.weights[features].sum(dtype=np.float64))))


class Features:
    """Distinct hashed character n-grams of a text, in time linear in its length."""

    def __init__(self, orders=ORDERS, bits: int = BITS):
        self.orders, self.bits = orders, bits
        self.last = np.zeros(1 << bits, dtype=np.int64)

    def __call__(self, text: str) -> np.ndarray:
        chars = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32)
        hashed = []
        for n in self.orders:
            size = len(chars) - n + 1
            if size <= 0:
                continue
            h = np.full(size, n * 0x51ED270B & 0xFFFFFFFF, dtype=np.uint32)
            for i in range(n):
                h ^= chars[i:i + size] * _MULTIPLIERS[i]
                h *= np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
            hashed.append(h >> np.uint32(32 - self.bits))
        if not hashed:
            return np.zeros(0, dtype=np.uint32)
        h = np.concatenate(hashed)
        # of equal hashes only the last place finds its own number again
        places = np.arange(len(h))
        self.last[h] = places
        return h[self.last[h] == places]


def _rows(model=None, orders=ORDERS, bits: int = BITS):
    """Batches of (doc_id, flag, text) to features, or to scores when a model is given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(orders, bits)
        for batch in batches:
            found = (features(t or "") for t in batch.column(2).to_pylist())
            if model is None:
                last, name = pa.array([f.astype("<u4").tobytes() for f in found], pa.binary()), "features"
            else:
                m = model.value
                last, name = pa.array([m.score(f) for f in found], pa.float64()), "score"
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), last], names=["doc_id", "flag", name])
    return run


def fit(rows: list[tuple[int, np.ndarray]], bits: int = BITS, smoothing: float = SMOOTHING, penalty: float = PENALTY,
        steps: int = STEPS, prior: float | None = None) -> LinearModel:
    """Fit on (label, distinct features). ``prior`` is the share of label 1 among all labelled documents.

    Without both labels the model is constant at the prior (0 without any).
    """
    y = np.array([label for label, _ in rows], dtype=np.float64)
    if len(set(y.tolist())) < 2:
        share = prior if prior is not None else float(y.mean()) if len(y) else 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        return LinearModel(np.zeros(1 << bits, dtype=np.float32), float(np.log(share / (1 - share))))
    sizes = np.array([len(f) for _, f in rows])
    index = np.concatenate([f for _, f in rows]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    size = 1 << bits
    p = smoothing + np.bincount(index, weights=y[owner], minlength=size)
    q = smoothing + np.bincount(index, weights=1 - y[owner], minlength=size)
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    scale = ratio[index]
    # accelerated gradient descent; the step follows from the largest squared row norm
    norm = np.bincount(owner, weights=scale ** 2, minlength=len(rows))
    step = 4.0 * len(rows) / max(norm.sum(), 1e-9)
    w, look, bias, look_bias = np.zeros(size), np.zeros(size), 0.0, 0.0
    share = y.mean()
    balance = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    for i in range(steps):
        margin = np.bincount(owner, weights=scale * look[index], minlength=len(rows)) + look_bias
        error = balance * (sigmoid(margin) - y) / len(rows)
        grad = np.bincount(index, weights=scale * error[owner], minlength=size) + penalty * look
        new_w, new_bias = look - step * grad, look_bias - step * error.sum()
        momentum = i / (i + 3)
        look, look_bias = new_w + momentum * (new_w - w), new_bias + momentum * (new_bias - bias)
        w, bias = new_w, new_bias
    return LinearModel((w * ratio).astype(np.float32), float(bias))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> LinearModel:
    """Collect the features of at most ``2 * per_class`` labelled documents outside the held-out fold and fit."""
    rows = (training_rows(docs, labels, "toxic", per_class)
            .select("doc_id", F.col("label").alias("flag"), "text")
            .mapInArrow(_rows(), "doc_id long, flag int, features binary"))
    found = sorted((r["doc_id"], r["flag"], r["features"]) for r in rows.toLocalIterator())
    return fit([(flag, np.frombuffer(f, dtype="<u4")) for _, flag, f in found])


def score_documents(docs: DataFrame, model: LinearModel, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row.

    Null and empty texts score like a text of two blanks; repeated rows score
    alike; a null doc_id counts as not held out. Other columns are not carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits numbers
    return (docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("flag"), "text")
            .mapInArrow(_rows(shared), "doc_id long, flag boolean, score double")
            .select("doc_id", F.col("flag").alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
