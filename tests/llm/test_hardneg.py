"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from quaylake.llm import hardneg

SCHEMA = "vec_id long, embedding array<double>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute_force(rows, every, positives=5, negatives=10, low=30, high=90, scale=100):
    kept = {}
    for i, v, y in rows:
        if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v):
            kept[i] = min(kept.get(i, (y, tuple(v))), (y, tuple(v)))
    x = {i: [math.floor(256 * c) for c in v] for i, (_, v) in kept.items()}
    out = []
    for a in kept:
        if a % every:
            continue
        score = {i: sum(p * q for p, q in zip(x[a], x[i], strict=True)) for i in kept
                 if i != a and len(x[i]) == len(x[a])}
        near = sorted((i for i in score if kept[i][0] == kept[a][0]), key=lambda i: (-score[i], i))[:positives]
        for p in near:
            fits = sorted((i for i in score if kept[i][0] != kept[a][0]
                           and low * score[p] <= scale * score[i] <= high * score[p]), key=lambda i: (-score[i], i))
            out += [(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(fits[:negatives])]
    return sorted(out)


def mined(spark, rows, schema=SCHEMA, **options):
    usable = hardneg.usable_rows(spark.createDataFrame(rows, schema))
    return sorted(tuple(r[c] for c in COLUMNS) for r in hardneg.hard_negatives(usable, **options).collect())


def clustered(n, dimension, seed, labels=3, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels + 2, dimension))
    return [(i, (centres[i % len(centres)] + spread * rng.normal(size=dimension)).tolist(), int(rng.integers(labels)))
            for i in range(n)]


@pytest.mark.parametrize("seed,block_rows,group_rows", [(1, 10_000, 10_000), (2, 60, 10_000), (3, 60, 7)])
def test_equals_brute_force(spark, seed, block_rows, group_rows):
    rows = clustered(400, 6, seed)
    got = mined(spark, rows, every=10, block_rows=block_rows, group_rows=group_rows)
    assert got == brute_force(rows, 10)
    assert len(got) > 500


def test_public_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
            for r in vectors.collect()]
    got = sorted(tuple(r[c] for c in COLUMNS) for r in hardneg.hard_negatives_of_sample(vectors).collect())
    assert got == brute_force(rows, 100)


def test_awkward_rows(spark):
    rows = clustered(60, 4, 4) + [
        (100, None, 1), (101, [1.0, None, 0.0, 0.0], 1), (102, [float("nan")] * 4, 1), (103, [float("inf")] * 4, 0),
        (104, [0.1] * 4, None), (None, [0.1] * 4, 1), (105, [0.0] * 4, 1), (110, [0.0] * 4, 1), (107, [0.5] * 3, 1),
        (120, [0.25] * 3, 1), (121, [0.25] * 3, 2), (108, [], 1), (130, [], 0), (131, [], 1)]
    # ties: one vector under many ids; rows that repeat an id, alike and not alike
    rows += [(200 + i, rows[0][1], i % 3) for i in range(40)] + [rows[10], rows[10], (20, [-3.0] * 4, 2)]
    got = mined(spark, [(*r, "x", 1.0) for r in rows], SCHEMA + ", n string, dimension double", every=10)
    assert got == brute_force(rows, 10)
    assert {r[0] for r in got} >= {0, 10}


def test_empty_table_and_no_anchor(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []


def test_scores_beyond_exact_doubles(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(int(c)) for c in rng.integers(-2**21, 2**21, size=3)], i % 2) for i in range(80)]
    assert mined(spark, rows, every=10) == brute_force(rows, 10)


def test_bounds_hold_and_spare_work():
    rng = np.random.default_rng(7)
    anchors = np.concatenate([c + rng.integers(-3, 4, size=(40, 8)) for c in rng.integers(-400, 400, size=(4, 8))]).astype(float)
    x = rng.integers(-400, 400, size=(3000, 8)).astype(float)
    order, parent, edge = hardneg.spanning_tree(anchors)
    assert sorted(order.tolist()) == list(range(160)) and (parent >= 0).sum() == 159
    seen = {a: k for k, a in enumerate(order.tolist())}
    for a in range(160):
        if parent[a] >= 0:
            assert seen[parent[a]] < seen[a]
            assert math.isclose(edge[a], np.linalg.norm(anchors[a] - anchors[parent[a]]))
    n = len(anchors)
    tree = hardneg.Tree({"dimension": 8, "n": n, "ids": np.arange(n).astype("<i8").tobytes(),
                         "labels": np.zeros(n, "<i8").tobytes(), "kind": "<f8", "data": anchors.tobytes(),
                         "order": order.tobytes(), "parent": parent.tobytes(), "edge": edge.tobytes()})

    def wanted(a, low, high):
        exact = x @ anchors[a]
        assert (low <= exact).all() and (exact <= high).all()
        return np.flatnonzero(high >= np.partition(exact, -20)[-20]), lambda places, scores: None
    computed = tree.visit(x, wanted)
    assert computed < 0.3 * n * len(x)
