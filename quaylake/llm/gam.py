"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting over features: in every round each feature in turn gets one
shallow tree on its binned values, fitted to the current residuals and added
to the feature's lookup table. Then the pairs of features whose residuals
interact most get tables of their own, boosted the same way with trees that
split both features once. A score is a sum of table entries, so scoring is a
few vectorised additions per feature.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import hashed_sample, held_out, keep_rows, materialize, sigmoid, training_ids

FEATURES = ("log_words", "word_chars", "symbols", "marks", "upper", "digits", "distinct_words", "top_word",
            "compression", "distinct_lines", "line_words", "short_words", "symbol_words", "title_words")
SYMBOLS = b"#*$%&|<>"
MARKS = b"!?.,;:"
PER_CLASS = 8000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 120
PAIR_ROUNDS = 40
RATE = 0.1
LEAST = 5
RIDGE = 1.0

_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, dtype=np.uint8))
_MARK = np.isin(np.arange(256), np.frombuffer(MARKS, dtype=np.uint8))


def text_features(text: str) -> tuple[float, ...]:
    """Surface statistics of a whole text; all 0 for a text without a word."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    chars = sum(map(len, words))
    distinct: dict[bytes, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    lines = [line for line in data.split(b"\n") if line.strip()]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    return (
        float(np.log1p(n)), chars / n, counts[_SYMBOL].sum() / n, counts[_MARK].sum() / n,
        counts[65:91].sum() / max(1, counts[65:91].sum() + counts[97:123].sum()), counts[48:58].sum() / chars,
        len(distinct) / n, max(distinct.values()) / n, len(zlib.compress(data, 1)) / len(data),
        len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), float((sizes <= 3).mean()),
        sum(w[-1] in SYMBOLS for w in distinct) / len(distinct), sum(w.isupper() for w in distinct) / len(distinct),
    )


@dataclass(frozen=True)
class AdditiveModel:
    """``cuts[f]`` bin feature f for ``tables[f]``; ``pair_tables`` use the coarser ``pair_cuts``."""

    bias: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for f, (cuts, values) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += values[np.searchsorted(cuts, x[:, f], side="right")]
        for (f, g), values in zip(self.pairs, self.pair_tables, strict=True):
            total += values[np.searchsorted(self.pair_cuts[f], x[:, f], side="right"),
                            np.searchsorted(self.pair_cuts[g], x[:, g], side="right")]
        return sigmoid(total)


def quantile_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` ascending cut points between distinct values."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Tree with up to two splits over ordered bins: its value for every bin."""
    cg, ch, cn = (np.concatenate(([0.0], np.cumsum(a))) for a in (g, h, n))

    def split(a: int, b: int) -> tuple[float, int]:
        at = np.arange(a + 1, b)
        if not len(at):
            return 0.0, a
        left, right = cg[at] - cg[a], cg[b] - cg[at]
        gain = (left ** 2 / (ch[at] - ch[a] + RIDGE) + right ** 2 / (ch[b] - ch[at] + RIDGE)
                - (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + RIDGE))
        gain[(cn[at] - cn[a] < LEAST) | (cn[b] - cn[at] < LEAST)] = 0.0
        best = int(np.argmax(gain))
        return float(gain[best]), int(at[best])

    edges = [0, len(g)]
    for _ in range(2):
        found = max((split(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)), default=(0.0, 0))
        if found[0] <= 1e-12:
            break
        edges = sorted({*edges, found[1]})
    out = np.empty(len(g))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        out[a:b] = _leaf(cg[b] - cg[a], ch[b] - ch[a])
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best tree that splits both features of a pair once: (gain, value for every cell)."""
    def corners(a):
        c = np.zeros((a.shape[0] + 1, a.shape[1] + 1))
        c[1:, 1:] = a.cumsum(0).cumsum(1)
        return c
    cg, ch = corners(g), corners(h)
    best, table = 0.0, np.zeros_like(g)
    base = cg[-1, -1] ** 2 / (ch[-1, -1] + RIDGE)
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            cells = [(c[i, j], c[i, -1] - c[i, j], c[-1, j] - c[i, j], c[-1, -1] - c[i, -1] - c[-1, j] + c[i, j])
                     for c in (cg, ch)]
            gain = sum(x * x / (y + RIDGE) for x, y in zip(*cells, strict=True)) - base
            if gain > best:
                best = gain
                v = [_leaf(x, y) for x, y in zip(*cells, strict=True)]
                table = np.empty_like(g)
                table[:i, :j], table[:i, j:], table[i:, :j], table[i:, j:] = v
    return best, table


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS, pairs: int = PAIRS,
        rate: float = RATE, weights: np.ndarray | None = None) -> AdditiveModel:
    """Fit on features (rows x features) and labels 0/1; with one label only the model is constant.

    ``weights`` say how many rows each one stands for; only their ratios count, and
    without them all rows count alike.
    """
    n_features = x.shape[1] if x.ndim == 2 else len(FEATURES)
    w = np.ones(len(y)) if weights is None or not len(y) else weights / weights.mean()
    share = min(max(float((w * y).mean()) if len(y) else 0.5, 1e-4), 1 - 1e-4)
    bias = float(np.log(share / (1 - share)))
    if len(set(y.tolist())) < 2:
        empty = [np.zeros(0)] * n_features
        return AdditiveModel(bias, empty, [np.zeros(1)] * n_features, empty, [], [])
    cuts = [quantile_cuts(x[:, f], BINS) for f in range(n_features)]
    coarse = [quantile_cuts(x[:, f], PAIR_BINS) for f in range(n_features)]
    binned = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(binned, tables, strict=True)]
    total = np.full(len(y), bias)
    for _ in range(rounds):
        for f, b in enumerate(binned):
            p = sigmoid(total)
            size = len(tables[f])
            step = rate * _tree(np.bincount(b, weights=w * (y - p), minlength=size),
                                np.bincount(b, weights=w * p * (1 - p), minlength=size), counts[f])
            tables[f] += step
            total += step[b]
    cells = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(coarse)]

    def sums(f: int, g: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[int, int]]:
        shape = (len(coarse[f]) + 1, len(coarse[g]) + 1)
        cell = cells[f] * shape[1] + cells[g]
        p = sigmoid(total)
        size = shape[0] * shape[1]
        return (cell, np.bincount(cell, weights=w * (y - p), minlength=size).reshape(shape),
                np.bincount(cell, weights=w * p * (1 - p), minlength=size).reshape(shape), shape)

    gains = []
    for f in range(n_features):
        for g in range(f + 1, n_features):
            _, sg, sh, _ = sums(f, g)
            gains.append((_pair_tree(sg, sh)[0], f, g))
    chosen = [(f, g) for gain, f, g in sorted(gains, reverse=True)[:pairs] if gain > 0]
    pair_tables = [np.zeros((len(coarse[f]) + 1, len(coarse[g]) + 1)) for f, g in chosen]
    for _ in range(pair_rounds):
        for k, (f, g) in enumerate(chosen):
            cell, sg, sh, _ = sums(f, g)
            step = rate * _pair_tree(sg, sh)[1]
            pair_tables[k] += step
            total += step.ravel()[cell]
    return AdditiveModel(bias, cuts, tables, coarse, chosen, pair_tables)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [list(text_features(t or "")) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))],
                                         names=["doc_id", "label", "x"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> AdditiveModel:
    """Collect the features of at most ``2 * per_class`` labelled documents outside the held-out fold and fit.

    The classes are sampled apart; a sampled row stands for as many as its class has
    among all labelled documents that are there, outside the fold, so scores refer to
    the mix of the classes in ``docs``, whatever its size and whatever else is labelled.
    """
    there = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    ids = materialize(training_ids(labels, "quality").join(there, "doc_id", "left_semi"), "labelled")
    sizes = {r["label"]: r["n"] for r in ids.groupBy("label").agg(F.count("*").alias("n")).collect()}
    sample = docs.select("doc_id", "text").join(F.broadcast(hashed_sample(ids, per_class)), "doc_id")
    rows = (sample.select("doc_id", "label", "text")
            .mapInArrow(_feature_rows, "doc_id long, label int, x array<double>").collect())
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    weights = np.array([sizes[r["label"]] / min(sizes[r["label"]], per_class) for r in rows])
    return fit(x, np.array([r["label"] for r in rows], dtype=np.float64), weights=weights)


def score_documents(docs: DataFrame, model: AdditiveModel, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row.

    Null and empty texts have all features 0 and the score of that bin; repeated
    rows score alike; a null doc_id counts as not held out. Other columns are not
    carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few lookup tables

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([text_features(t or "") for t in batch.column(2).to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared.value.score(x))],
                                             names=["doc_id", "held_out", "score"])

    return (docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(run, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, model: AdditiveModel, least: float) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide():
        def accept(texts: list[str | None]) -> list[bool]:
            x = np.array([text_features(t or "") for t in texts]).reshape(-1, len(FEATURES))
            return (shared.value.score(x) >= least).tolist()
        return accept

    return keep_rows(docs, decide)
