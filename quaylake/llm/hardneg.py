"""Hard negatives of anchors, searched along a spanning tree of the anchors.

Scores are integer inner products. With the scores of a parent anchor known, the
score of a child anchor differs by at most the length of the edge between them
times the norm of the candidate, so only candidates whose bounds overlap a
window of the child are scored again. Two passes over the candidates: the first
finds the positives of every anchor, the second fills the windows that the
positives open. A window rises to its worst kept score once it is full.

Candidates are packed once into blocks by a hash of their id. Anchors are a
stated query set; they come in groups of bounded size, each with its own tree,
and a group visits all blocks in one job without a shuffle of candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import materialize

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH, SCALE = 30, 90, 100
ANCHOR_EVERY = 100
FACTOR = 256
BLOCK_ROWS = 8192
GROUP_ROWS = 2048
# rows of a block whose bounds are held for a whole tree at once
SLICE_ROWS = 2048
EXACT = float(1 << 53)
PACKED = "dimension int, n int, ids binary, labels binary, kind string, data binary"


def usable_rows(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                label: Column | str = "label") -> DataFrame:
    """(vec_id, label, v) of the rows that take part: id and label not null, all components finite."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col(label) if isinstance(label, str) else label
    return (vectors.where(F.col(vec_id).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False)))
            .select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), v.alias("v")))


def _distinct_rows(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list]:
    """ids, labels and vectors in order of id; of rows that repeat an id the smallest label, then vector."""
    order = sorted(zip(rows["vec_id"].to_pylist(), rows["label"].to_pylist(), map(tuple, rows["v"].to_pylist()), strict=True))
    kept = [r for i, r in enumerate(order) if i == 0 or r[0] != order[i - 1][0]]
    ids, labels, vectors = zip(*kept, strict=True)
    return np.array(ids, dtype=np.int64), np.array(labels, dtype=np.int64), list(vectors)


def scaled(vectors: list, factor: int) -> np.ndarray:
    """floor(factor * x) of every component, as doubles that hold integers."""
    return np.floor(np.array(vectors, dtype=np.float64).reshape(len(vectors), -1) * factor)


def blocks_of(rows: DataFrame, n_blocks: int, factor: int = FACTOR) -> DataFrame:
    """Candidates packed by dimension and block: ids, labels and scaled vectors as raw bytes."""
    def pack(part: pa.Table) -> pa.Table:
        ids, labels, vectors = _distinct_rows(part)
        x = scaled(vectors, factor)
        return pa.table({"dimension": part["dimension"].slice(0, 1),
                         "n": pa.array([len(ids)], pa.int32()), "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                         "labels": pa.array([labels.astype("<i8").tobytes()], pa.binary()),
                         "kind": pa.array([narrowest(x)]), "data": pa.array([x.astype(narrowest(x)).tobytes()], pa.binary())})

    return (rows.withColumn("dimension", F.size("v"))
            .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
            .groupBy("dimension", "block")
            .applyInArrow(pack, PACKED))


def narrowest(x: np.ndarray) -> str:
    """The smallest type that holds these whole numbers."""
    most = np.abs(x).max(initial=0.0)
    return "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"),
            np.frombuffer(row["data"], row["kind"]).astype(np.float64).reshape(row["n"], row["dimension"]))


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prim's tree of least total edge length: (order of visit, parent of every row or -1, length of its edge)."""
    n = len(x)
    order, parent, edge = np.zeros(n, dtype=np.int64), np.full(n, -1), np.full(n, np.inf)
    left = np.ones(n, dtype=bool)
    edge[:1] = 0.0
    for k in range(n):
        at = int(np.argmin(np.where(left, edge, np.inf)))
        order[k], left[at] = at, False
        length = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        closer = left & (length < edge)
        edge[closer], parent[closer] = length[closer], at
    return order, parent, edge


def anchor_groups(blocks: DataFrame, every: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Anchors packed with their tree, about ``group_rows`` to a row, dealt by a hash of the id."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, x = unpack(row)
                mine = ids % every == 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(int(mine.sum()), row["dimension"]), pa.int32()), pa.array(ids[mine], pa.int64()),
                     pa.array(labels[mine], pa.int64()), pa.array(list(x[mine]), pa.list_(pa.float64()))],
                    names=["dimension", "vec_id", "label", "v"])

    def grow(part: pa.Table) -> pa.Table:
        part = part.sort_by("vec_id")
        x = np.array(part["v"].to_pylist(), dtype=np.float64).reshape(part.num_rows, -1)
        order, parent, edge = spanning_tree(x)
        return pa.table({"dimension": part["dimension"].slice(0, 1), "n": pa.array([len(x)], pa.int32()),
                         "ids": pa.array([part["vec_id"].to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "labels": pa.array([part["label"].to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "kind": pa.array([narrowest(x)]), "data": pa.array([x.astype(narrowest(x)).tobytes()], pa.binary()),
                         "number": part["number"].slice(0, 1), "order": pa.array([order.astype("<i8").tobytes()], pa.binary()),
                         "parent": pa.array([parent.astype("<i8").tobytes()], pa.binary()),
                         "edge": pa.array([edge.astype("<f8").tobytes()], pa.binary())})

    anchors = materialize(blocks.mapInArrow(pick, "dimension int, vec_id long, label long, v array<double>"), "anchors")
    n_groups = max(1, -(-anchors.count() // group_rows))
    return (anchors.withColumn("number", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(n_groups)).cast("int"))
            .groupBy("dimension", "number")
            .applyInArrow(grow, f"{PACKED}, number int, order binary, parent binary, edge binary"))


class Tree:
    """The anchors of a group and bounds of their scores, parent before child."""

    def __init__(self, row: dict):
        self.dimension = row["dimension"]
        self.ids, self.labels, self.x = unpack(row)
        self.order, self.parent = np.frombuffer(row["order"], "<i8"), np.frombuffer(row["parent"], "<i8")
        self.edge = np.frombuffer(row["edge"], "<f8")
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        self.children = np.bincount(self.parent[self.parent >= 0], minlength=len(self.ids))

    def visit(self, x: np.ndarray, wanted) -> int:
        """Bound the scores of all anchors with the rows ``x``; returns how many were computed.

        ``wanted(anchor, low, high)`` gives the places of the rows that may matter and
        a function that takes their exact scores. Bounds of an anchor are dropped
        with its last child.
        """
        norms = np.sqrt((x * x).sum(axis=1))
        largest = norms.max(initial=0.0)
        held, waiting, computed = {}, self.children.copy(), 0
        for a in self.order:
            p = self.parent[a]
            if p < 0:
                low, high = np.full(len(x), -np.inf), np.full(len(x), np.inf)
            else:
                # room for the rounding of lengths, norms and bounds
                slack = np.nan_to_num((self.edge[a] + 2.0 ** -50 * self.norm[p]) * norms * (1 + 1e-9), nan=np.inf) + 1.0
                low, high = held[p][0] - slack, held[p][1] + slack
                waiting[p] -= 1
                if not waiting[p]:
                    del held[p]
            places, take = wanted(a, low, high)
            if p < 0:
                places = np.arange(len(x))
            if len(places):
                scores = self.products(a, x, places, largest)
                computed += len(places)
                low[places] = high[places] = scores.astype(np.float64)
                take(places, scores)
            if waiting[a]:
                held[a] = low, high
        return computed

    def products(self, a: int, x: np.ndarray, places: np.ndarray, largest: float) -> np.ndarray:
        """Inner products as integers: in doubles where every sum is exact, else in whole numbers of any size."""
        rows = x if len(places) == len(x) else x[places]
        if self.norm[a] * largest < EXACT / 2:
            return (rows @ self.x[a]).astype(np.int64)
        whole = [sum(int(p) * int(q) for p, q in zip(row, self.x[a], strict=True)) for row in rows]
        return np.array(whole, dtype=np.int64)


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties by smaller id."""
    if len(scores) > n:
        edge = np.partition(scores, len(scores) - n)[len(scores) - n]
        kept = np.flatnonzero(scores >= edge)
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))[:n]]


class Kept:
    """Up to ``n`` best (score, id) of many lists, filled slice by slice."""

    def __init__(self, lists: int, n: int):
        self.n = n
        self.scores = [np.zeros(0, dtype=np.int64)] * lists
        self.ids = [np.zeros(0, dtype=np.int64)] * lists

    def worst(self, i: int) -> float:
        """A lower score than this cannot enter the list any more."""
        return self.scores[i][-1] if len(self.scores[i]) == self.n else -np.inf

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate((self.scores[i], scores)), np.concatenate((self.ids[i], ids))
        first = best(scores, ids, self.n)
        self.scores[i], self.ids[i] = scores[first], ids[first]


def _slices(batches: Iterator[pa.RecordBatch], dimension: int):
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["dimension"] == dimension:
                ids, labels, x = unpack(row)
                for at in range(0, len(ids), SLICE_ROWS):
                    yield ids[at:at + SLICE_ROWS], labels[at:at + SLICE_ROWS], x[at:at + SLICE_ROWS]


def same_label_best(tree: Tree, slices, n: int) -> tuple[Kept, int]:
    """The ``n`` best other rows of the same label for every anchor, and how many scores were computed."""
    found, computed = Kept(len(tree.ids), n), 0
    for ids, labels, x in slices:
        def wanted(a, low, high):
            fits = (labels == tree.labels[a]) & (ids != tree.ids[a])
            places = np.flatnonzero(fits & (high >= found.worst(a)))

            def take(places, scores):
                mine = fits[places]
                found.add(a, scores[mine], ids[places[mine]])
            return places, take
        computed += tree.visit(x, wanted)
    return found, computed


def window_best(tree: Tree, slices, windows: list[list[tuple[int, int, int]]], n: int) -> tuple[Kept, int]:
    """The ``n`` best rows of other labels in every window, and how many scores were computed.

    ``windows[a]`` lists (number, lowest, highest score) of the anchor's windows.
    """
    found, computed = Kept(sum(map(len, windows)), n), 0
    for ids, labels, x in slices:
        def wanted(a, low, high):
            other = labels != tree.labels[a]
            overlap = np.zeros(len(ids), dtype=bool)
            for w, least, most in windows[a]:
                if least > most:
                    continue
                overlap |= (high >= max(least, found.worst(w))) & (low <= most)

            def take(places, scores):
                for w, least, most in windows[a]:
                    mine = other[places] & (scores >= max(least, found.worst(w))) & (scores <= most)
                    if mine.any():
                        found.add(w, scores[mine], ids[places[mine]])
            return np.flatnonzero(overlap & other), take
        computed += tree.visit(x, wanted)
    return found, computed


def _ranked(hits: DataFrame, key: list[str], value: str, score: str, n: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.desc(score), value)
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(rows: DataFrame, every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, scale: int = SCALE, factor: int = FACTOR,
                   block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors.

    ``rows`` are ``usable_rows``; anchors are those whose id is divisible by
    ``every``. Positives are the ``positives`` highest scored other rows of the
    anchor's label, negatives the ``negatives`` highest scored rows of other labels
    with low * p <= scale * n <= high * p. Ties go to the smaller id, shorter lists
    are returned whole, a positive without negatives has no row.

    An id is one row: of rows that repeat it the smallest label, then vector, stands
    for it. Only vectors of one length are compared; vectors of no component score
    0. An empty table, or one without anchors, gives no rows. A score beyond 64
    bits is an error.
    """
    spark = rows.sparkSession
    n_blocks = max(1, -(-rows.count() // block_rows))
    blocks = materialize(blocks_of(rows, n_blocks, factor), "hardneg-blocks")
    groups = materialize(anchor_groups(blocks, every, group_rows), "hardneg-anchors")
    parts = []
    for key in groups.select("dimension", "number").distinct().toLocalIterator():
        # one group: at most about group_rows vectors
        packed = groups.where((F.col("dimension") == key["dimension"]) & (F.col("number") == key["number"])).first().asDict()
        shared = spark.sparkContext.broadcast(packed)
        mine = blocks.where(F.col("dimension") == key["dimension"])
        near = materialize(_ranked(_positives(mine, shared, positives), ["anchor_id"], "positive_id", "positive_score",
                                   positives).drop("rank"), "hardneg-positives")
        # bounded like the group: a few positives for each of its anchors
        opened = spark.sparkContext.broadcast([tuple(r) for r in near.collect()])
        hits = _negatives(mine, shared, opened, negatives, low, high, scale)
        parts.append(materialize(_ranked(hits, ["anchor_id", "positive_id"], "negative_id", "negative_score", negatives),
                                 "hardneg-found"))
        shared.unpersist()
        opened.unpersist()
    found = parts[0] if parts else spark.createDataFrame(
        [], "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long, rank int")
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _positives(blocks: DataFrame, shared, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(shared.value)
        found, _ = same_label_best(tree, _slices(batches, tree.dimension), n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(tree.ids, [len(s) for s in found.scores]), pa.int64()),
             pa.array(np.concatenate(found.ids), pa.int64()), pa.array(np.concatenate(found.scores), pa.int64())],
            names=["anchor_id", "positive_id", "positive_score"])

    return blocks.mapInArrow(run, "anchor_id long, positive_id long, positive_score long")


def _negatives(blocks: DataFrame, shared, opened, n: int, low: int, high: int, scale: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(shared.value)
        place = {int(i): k for k, i in enumerate(tree.ids)}
        windows = [[] for _ in tree.ids]
        for number, (anchor, _, score) in enumerate(opened.value):
            # whole scores between the two ends of the window
            windows[place[anchor]].append((number, -(-low * score // scale), high * score // scale))
        found, _ = window_best(tree, _slices(batches, tree.dimension), windows, n)
        times = [len(s) for s in found.scores]
        anchors, near, scores = (np.array([r[k] for r in opened.value], dtype=np.int64) for k in range(3))
        empty = [np.zeros(0, dtype=np.int64)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(column, times), pa.int64()) for column in (anchors, near, scores)]
            + [pa.array(np.concatenate(column or empty), pa.int64()) for column in (found.ids, found.scores)],
            names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return blocks.mapInArrow(run, "anchor_id long, positive_id long, positive_score long, "
                                  "negative_id long, negative_score long")


def hard_negatives_of_sample(vectors: DataFrame) -> DataFrame:
    """Hard negatives with the next label for ids divisible by 7."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(usable_rows(vectors, label=label))
