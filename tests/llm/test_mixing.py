"""Source mixing against a plain recomputation and its own promises."""

import hashlib
import math
import random
import re

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from quaylake.llm import mixing
from quaylake.llm.queries import ORACLE

SCHEMA = "doc_id long, text string, source string"


def key_of(doc_id, text):
    name = f"{'' if doc_id is None else doc_id}|{text or ''}"
    u = (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    t = text or ""
    solid = re.sub(r"[\x20\x09-\x0D]", "", t)
    letters = re.sub(r"[\x00-\x40\x5B-\x60\x7B-\x7F]", "", t)
    lines = t.split("\n")
    weight = max(len(letters) / len(solid) if solid else 0.0, 0.05) * max(len(set(lines)) / len(lines), 0.05)
    return -math.log(u) / weight


def brute_force(rows, weights=(5, 2, 1), most=3):
    docs = [(d, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s, key_of(d, t)) for d, t, s in rows]
    sources = sorted({s for *_, s, _ in docs}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(d[1] for d in docs if d[2] == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    target, open_ = {}, set(sources)
    while True:
        left = sum(size.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > most * size[s]}
        if not above:
            break
        target.update({s: most * size[s] for s in above})
        open_ -= above
    target.update(share)
    out = []
    for s in sources:
        mine = sorted((d for d in docs if d[2] == s), key=lambda d: d[3])
        complete = int(target[s] // size[s]) if size[s] else 0
        left, taken = target[s] - complete * size[s], set()
        if left > 0 and complete < most:
            def prefix(budget):
                out, gap = set(), budget
                for i, d in enumerate(mine):
                    if d[1] > gap:
                        break
                    gap -= d[1]
                    out.add(i)
                return out, gap
            past = len(prefix(left)[0])
            words = mine[past][1]
            taken, gap = prefix(left + words)
            taken -= {past}
            if words <= left and prefix(left - words)[1] < gap:
                taken, gap = prefix(left - words)
                taken.add(past)
            rest = [i for i in range(len(mine)) if i not in taken and mine[i][1] > 0 and abs(gap - mine[i][1]) < gap]
            if rest:
                taken.add(min(rest, key=lambda i: (abs(gap - mine[i][1]), mine[i][3])))
        out += [(d[0], d[1], size[s], target[s], d[1] * (complete + (i in taken))) for i, d in enumerate(mine)]
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


def mixed(docs):
    return [tuple(r) for r in mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()]


def corpus(n, seed, sources):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # one source holds most of the rows; one document is very long
        source = sources[0] if rng.random() < 0.6 else rng.choice(sources)
        words = 40_000 if i == 7 else rng.randint(0, 60)
        text = "".join(rng.choice(("word ", "x1 ", "#\n", "é ")) for _ in range(words))
        rows.append((i, text, source))
    return rows


@pytest.mark.parametrize("seed,sources", [(1, ["b", "a", "C", "é", "zz", None]), (2, ["only"]),
                                          (4, [f"s{i:02}" for i in range(17)])])
def test_equals_brute_force(spark, seed, sources):
    rows = corpus(400, seed, sources)
    got, want = mixed(spark.createDataFrame(rows, SCHEMA)), brute_force(rows)
    for g, w in zip(ordered(got), ordered(want), strict=True):
        assert g[:3] == w[:3] and math.isclose(g[3], w[3], rel_tol=1e-12) and g[4] == w[4]


def test_promises(spark):
    rows = corpus(600, 5, ["a", "b", "c", "d"])
    got = mixed(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert ordered(got) == ordered(mixed(spark.createDataFrame(rows[::-1], SCHEMA)))
    assert all(g[4] <= 3 * g[1] for g in got)
    by_source = {}
    for g, source in zip(ordered(got), (r[2] for r in rows), strict=True):
        by_source.setdefault(source, []).append(g)
    assert math.isclose(sum(m[0][3] for m in by_source.values()), sum(g[1] for g in got))
    for mine in by_source.values():
        assert mine[0][3] <= 3 * mine[0][2]
        # the long document does not keep its source from its target
        assert abs(sum(g[4] for g in mine) - mine[0][3]) <= 30


def test_capped_sources_and_oracle(spark, tmp_path):
    # the heavy sources are small: they stop at three times their size, one after another
    rows = [(i, "w " * (i % 9 + 1), s) for i, s in enumerate(["a"] * 3 + ["b"] * 10 + ["c"] * 500 + ["d"] * 4 + [None] * 20)]
    rows += [(1, None, "e"), (None, "x y", "e"), (None, None, None), (2, "", ""), (2, "", ""), (3, "w w", "a"), (3, "w w", "a")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixed(docs)
    pq.write_table(docs.toArrow(), tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    con.execute(f"CREATE VIEW embeddings AS SELECT 1")
    sql = con.execute(ORACLE["op12_mixing"])
    names = [d[0] for d in sql.description]
    place = [names.index(c) for c in ("doc_id", "size", "source_size", "target", "taken")]
    want = [tuple(r[p] for p in place) for r in sql.fetchall()]
    assert ordered(got) == ordered(want)
    full = {g[2]: g for g in got if g[2] and g[3] == 3 * g[2]}
    assert len(full) >= 2
    assert all(g[4] == 3 * g[1] for g in got if g[2] in full)


def test_awkward_rows_extra_columns_and_empty_table(spark, awkward):
    clash = awkward.selectExpr("*", "9 AS size", "1.0 AS rid", "'k' AS target", "2 AS left")
    got = mixed(clash)
    assert len(got) == clash.count()
    assert {g[1] for g in got if g[0] in (2, 3, 4)} == {0}
    rows = [(r["doc_id"], r["text"], r["source"]) for r in awkward.collect()]
    assert [g[:3] + g[4:] for g in ordered(got)] == [w[:3] + w[4:] for w in ordered(brute_force(rows))]
    assert mixed(awkward.limit(0)) == []
    silent = spark.createDataFrame([(1, "", "a"), (2, None, "b")], SCHEMA)
    assert sorted(mixed(silent)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_weights_and_sizes_may_be_given(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "a" if i % 2 else "b", float(1 + i % 5)) for i in range(3000)],
                                 SCHEMA + ", w double")
    rows = mixing.mix(docs, weights=(1, 3), size=F.lit(10).cast("long"), weight=F.col("w")).collect()
    taken = {i: 0 for i in range(1, 6)}
    for r in rows:
        assert r["taken"] == 10 * r["epochs"]
        if r["doc_id"] % 2:
            taken[1 + r["doc_id"] % 5] += r["epochs"]
    # half of a source is taken: heavier documents more often
    assert sum(taken.values()) == 750
    assert taken[5] > taken[3] > taken[1]
