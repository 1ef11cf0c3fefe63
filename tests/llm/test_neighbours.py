"""Permutation index and near-duplicates against brute force."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from quaylake.llm import minhash, permutation

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_recall_and_exact_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)
    found = {}
    for r in permutation.neighbours_of_sample(vectors).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(found) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, ranks in found.items():
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        assert sorted(ranks) == list(range(1, 21))
        hits += len(set(best.tolist()) & {v for v, _ in ranks.values()})
        for v, s in ranks.values():
            assert abs(s - score[ids == v][0]) < 1e-12
    assert hits >= 0.9 * 20 * len(found)


def test_blocks_agree_with_brute_force_when_everything_is_reranked(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=5) * rng.integers(1, 4)).tolist()) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (7, rows[7][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = permutation.nearest(vectors, vectors.where("vec_id % 10 = 0"), neighbours=6, pivots=8, share=1.0,
                              block_rows=17, query_rows=4).collect()
    x = {i: np.array(v) for i, v in rows}
    for q in [i for i in x if i % 10 == 0]:
        want = sorted(((-float(x[v] @ x[q]), v) for v in x if v != q))[:6]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[1] for m in mine] == [v for _, v in want]
        assert np.allclose([m[2] for m in mine], [-s for s, _ in want])


def test_repeated_ids_leave_room_for_other_neighbours(spark):
    rng = np.random.default_rng(2)
    single = [(i, rng.normal(size=5).tolist()) for i in range(80)]
    # every row twice; one id thirty times, once with a vector that is no neighbour of the queries
    rows = single * 2 + [single[9]] * 28 + [(9, (-np.array(single[9][1])).tolist())]
    queries = spark.createDataFrame([r for r in single if r[0] % 8 == 0], "vec_id long, v array<double>")
    vectors = spark.createDataFrame(rows, "vec_id long, v array<double>")
    assert len({tuple(p) for p in permutation.choose_pivots(vectors, 5, 16).tolist()}) == 16
    got = permutation.nearest(vectors, queries, neighbours=20, pivots=8, share=1.0).collect()
    x = {i: np.array(v) for i, v in single}
    for q in range(0, 80, 8):
        score = {v: float(x[v] @ x[q]) for v in x if v != q}
        if 9 in score:
            score[9] = abs(score[9])
        want = sorted((-s, v) for v, s in score.items())[:20]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[1] for m in mine] == [v for _, v in want]
        assert np.allclose([m[2] for m in mine], [-s for s, _ in want])
    # the reranked share counts ids: copies of near rows do not use it up
    few = [tuple(r) for r in permutation.nearest(spark.createDataFrame(single, "vec_id long, v array<double>"), queries,
                                                 pivots=8, share=0.3, least=1).orderBy("query_id", "rank").collect()]
    doubled = permutation.nearest(spark.createDataFrame(single * 2, "vec_id long, v array<double>"), queries, pivots=8,
                                  share=0.3, least=1).orderBy("query_id", "rank").collect()
    assert [r[:3] for r in few] == [tuple(r)[:3] for r in doubled]


def test_unusable_vectors_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [1.0, None]), (80, [nan, 1.0]), (100, [inf, 1.0]),
            (None, [1.0, 1.0]), (3, [0.5, 0.5]), (5, [1.0, 2.0, 3.0]), (6, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in permutation.neighbours_of_sample(vectors).collect()]
    assert got == [(0, 1, 3, 0.5)]
    assert permutation.neighbours_of_sample(vectors.limit(0)).count() == 0


def sets_of(rows, width):
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate(FOLD))
        out[i] = ({tuple(w[j:j + width]) for j in range(len(w) - width + 1)} if len(w) >= width
                  else {tuple(w)} if w else set())
    return out


def brute(rows, width):
    sets = sets_of(rows, width)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def corpus(seed, groups, copies):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(groups):
        base = [rnd.choice(words) for _ in range(50)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rnd.randrange(6)):
                text[rnd.randrange(50)] = rnd.choice(words)
            texts.append(" ".join(text))
        for _ in range(6):  # a chain that drifts away
            base[rnd.randrange(50)] = rnd.choice(words)
            texts.append(" ".join(base))
    texts += [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 40))) for _ in range(40)]
    texts += ["", None, " \n", "a", "A", "b c", "B  C", "a b c", texts[0], texts[1].upper()]
    return list(enumerate(texts))


@pytest.mark.parametrize("width,hot,copies", [(2, 5, 24), (2, 48, 8), (5, 48, 8)])
def test_components_equal_brute_force(spark, width, hot, copies):
    rows = corpus(width + hot, 3, copies)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs, width, hot=hot).collect()
    want = brute(rows, width)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want and len(got) == len(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_a_large_group_at_the_default_settings(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(90)]
    texts = []
    for i in range(200):
        text = list(base)
        for _ in range(rnd.randrange(2, 10)):
            text[rnd.randrange(90)] = f"own{i}" if rnd.random() < 0.5 else rnd.choice(words)
        texts.append(" ".join(text))
    texts += [" ".join(rnd.choice(words) for _ in range(60)) for _ in range(60)]
    rows = list(enumerate(texts))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    want = brute(rows, 2)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    sizes = [sum(c == i for _, c in want.values()) for i in {c for _, c in want.values()}]
    assert max(sizes) > minhash.HOT and len(sizes) > 60


def test_signatures_estimate_as_plain_sets_do():
    rng, k = np.random.default_rng(4), minhash.SIGNATURE
    pairs = []
    for n in (1, 5, 40, 64, 100, 300):
        base = rng.choice(1 << 32, size=2 * n, replace=False)
        pairs += [(set(base[:n].tolist()), set(base[i:n + i].tolist())) for i in (0, n // 10, n // 2, n)]
    sigs = [[np.array(sorted(s)[:k], dtype=np.uint32).view(np.int32) for s in side] for side in zip(*pairs, strict=True)]
    got = minhash._overlap(*(pa.array(x, pa.list_(pa.int32())) for x in sigs))
    for (a, b), est in zip(pairs, got, strict=True):
        union = sorted(a | b)[:k]
        assert est == sum(v in a and v in b for v in union) / len(union)


def test_classes_count_all_documents(spark):
    rows = [(i, "a b c" if i < 9 else f"x{i} y{i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    classes = minhash.frequency_classes(docs, 2, bits=20)
    shingles = minhash.Shingler(2)
    at = [(shingles(t) >> np.uint64(44)).astype(int).tolist() for t in ("a b c", "x9 y9")]
    assert [classes[i] for i in at[0]] == [3, 3] and classes[at[1][0]] == 0


def test_near_duplicates_of_awkward_rows(spark, awkward):
    out = minhash.near_duplicates(awkward, 2).collect()
    assert len(out) == awkward.count()
    by_id = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert by_id[2]["n_shingles"] == by_id[3]["n_shingles"] == by_id[4]["n_shingles"] == 0
    assert all(r["kept"] for r in out) and sum(r["doc_id"] == 1 for r in out) == 2
    assert minhash.near_duplicates(awkward.limit(0), 2).count() == 0


def test_sketches_hold_what_similar_sets_must_share():
    for n in range(1, 300):
        k = minhash.must_share(n, 80)
        # 80 per cent of the union is at least 80 per cent of either set, so fewer than k values can be missing
        assert n - k + 1 <= -(-n * 80 // 100) and k <= n


def test_jobs_and_pairs_do_not_grow_with_a_group_of_near_copies(spark, monkeypatch):
    """The largest group passes through a bounded number of jobs, as tied members and parts, not as all its pairs."""
    rnd = random.Random(7)
    base = [f"b{i}" for i in range(80)]
    texts = []
    for i in range(150):
        text = list(base)
        for j in rnd.sample(range(80), rnd.randrange(1, 12)):
            text[j] = f"own{i}x{j}"
        texts.append(" ".join(text))
    texts += [" ".join(rnd.choice(base) for _ in range(40)) for _ in range(30)]
    rows = list(enumerate(texts))
    met, est = [], minhash.estimated
    monkeypatch.setattr(minhash, "estimated", lambda pairs, *rest: met.append(pairs) or est(pairs, *rest))
    monkeypatch.setattr(minhash, "PART_HASHES", 1 << 12)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.sparkContext.setJobGroup("one-group", "near copies")
    got = minhash.near_duplicates(docs, 2, hot=8).collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("one-group"))
    spark.sparkContext.setJobGroup("other", "other")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, 2)
    assert sum(p.count() for p in met) < 10 * len(rows)
    assert jobs < 150


def test_marks_differ_by_no_more_than_the_sets():
    rng = np.random.default_rng(5)
    for n in (1, 4, 60, 600):
        for own in (1, max(1, n // 9)):
            values = np.unique(rng.integers(0, 1 << 63, size=n + 2 * own, dtype=np.uint64) * np.uint64(2))
            a, b = values[:n + own], np.unique(np.concatenate((values[:n], values[n + own:])))
            bits = sum(int(x).bit_count() for x in (minhash.mark(a) ^ minhash.mark(b)).view(np.uint64))
            assert bits <= 2 * own
    assert minhash.mark(np.zeros(0, dtype=np.uint64)).tolist() == [0, 0]
