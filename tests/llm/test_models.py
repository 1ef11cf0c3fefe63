"""The learned operators: held-out accuracy, awkward rows and degenerate training data."""

import math
import tracemalloc
import zlib

import numpy as np
import pytest
from quaylake.llm import crf, gam, nbsvm
from quaylake.llm.common import held_out, hashed_sample, training_rows
from pyspark.sql import functions as F

ROOT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{ROOT}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{ROOT}/labels.parquet")


def test_fold_and_sample(spark, docs, labels):
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    sample = training_rows(docs, labels, "quality", 7).collect()
    assert len(sample) == 14 and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in sample)
    empty = spark.createDataFrame([], "doc_id long, label int")
    assert hashed_sample(empty, 3).count() == 0


def test_quality_on_held_out_documents(docs, labels, awkward):
    model = gam.train(docs, labels)
    judged = gam.score_documents(docs, model).join(labels, "doc_id").where("held_out AND quality IS NOT NULL").collect()
    assert sum(r["predicted"] == r["quality"] for r in judged) >= 0.95 * len(judged)
    rows = gam.score_documents(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    kept = gam.keep_good(awkward, model, 0.0)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()


def test_quality_prior_does_not_depend_on_the_cap(docs, labels):
    whole, capped = gam.train(docs, labels), gam.train(docs, labels, per_class=40)
    rows = training_rows(docs, labels, "quality", 10**6).collect()
    ones = sum(r["label"] for r in rows)
    assert ones > 40 < len(rows) - ones
    want = math.log(ones / (len(rows) - ones))
    assert abs(whole.bias - want) < 1e-9 and abs(capped.bias - want) < 1e-9
    # only the ratios of the weights count
    rng = np.random.default_rng(0)
    x, y = rng.random((200, 2)), np.arange(200) % 2.0
    a, b = (gam.fit(x, y, 5, 2, weights=np.full(200, k)) for k in (1.0, 9.0))
    assert np.allclose(a.score(x), b.score(x)) and np.allclose(a.score(x), gam.fit(x, y, 5, 2).score(x))


def test_additive_model_finds_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.95
    # tables add up: the score is the sum of lookups
    one = model.bias + sum(t[np.searchsorted(c, v, side="right")] for c, t, v in zip(model.cuts, model.tables, x[0]))
    one += sum(t[np.searchsorted(model.pair_cuts[f], x[0, f], side="right"),
                 np.searchsorted(model.pair_cuts[g], x[0, g], side="right")]
               for (f, g), t in zip(model.pairs, model.pair_tables))
    assert math.isclose(1 / (1 + math.exp(-one)), model.score(x[:1])[0])


def test_toxicity_separates_planted_words(spark, awkward):
    clean = ["we walked to the river and had lunch", "a quiet morning with tea", "the report lists all numbers"] * 12
    toxic = ["you are a stupid idiot and a loser", "what an idiot he is", "shut up you stupid fool"] * 12
    rows = [(i, f"{t} note {i}") for i, t in enumerate(clean + toxic)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= len(clean))) for i, _ in rows] + [(None, 1), (5, None)],
                                   "doc_id long, toxic int")
    model = nbsvm.train(docs, labels)
    judged = nbsvm.score_documents(docs, model).collect()
    assert all(r["predicted"] == int(r["doc_id"] >= len(clean)) for r in judged)
    out = nbsvm.score_documents(awkward, model).collect()
    assert len(out) == awkward.count() and all(0 <= r["score"] <= 1 for r in out)


def test_scores_equal_plain_scorers(spark, docs, labels):
    sample = docs.limit(40)
    model = gam.train(docs, labels)

    def bin_of(cuts, x):
        return sum(c <= x for c in cuts.tolist())

    def additive(text):
        x = list(gam.text_features(text or ""))
        total = model.bias + sum(t[bin_of(c, v)] for c, t, v in zip(model.cuts, model.tables, x, strict=True))
        for (f, g), t in zip(model.pairs, model.pair_tables, strict=True):
            total += t[bin_of(model.pair_cuts[f], x[f]), bin_of(model.pair_cuts[g], x[g])]
        return 1 / (1 + math.exp(-total))
    texts = {r["doc_id"]: r["text"] for r in sample.collect()}
    for r in gam.score_documents(sample, model).collect():
        assert math.isclose(r["score"], additive(texts[r["doc_id"]]), rel_tol=1e-9, abs_tol=1e-12)
        assert r["predicted"] == int(r["score"] >= 0.3)

    linear, features = nbsvm.train(docs, labels), nbsvm.Features()
    for r in nbsvm.score_documents(sample, linear).collect():
        total = linear.bias + math.fsum(float(linear.weights[i]) for i in set(features(texts[r["doc_id"]] or "").tolist()))
        assert math.isclose(r["score"], 1 / (1 + math.exp(-total)), rel_tol=1e-6, abs_tol=1e-9)


def test_prior_counts_labels_of_documents_that_are_there(spark):
    docs = spark.createDataFrame([(i, "good words here " * 9 if i % 2 else "## !! $$") for i in range(60)],
                                 "doc_id long, text string")
    own = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    others = own.unionByName(spark.createDataFrame([(i, 1) for i in range(1000, 3000)], "doc_id long, quality int"))
    a, b = (sorted(map(tuple, gam.score_documents(docs, gam.train(docs, x)).collect())) for x in (own, others))
    assert a == b


def test_languages_are_bounded_and_repeated_ids_are_one_sample(spark):
    rows = [(i, f"wort{i % 7} und mehr", "de") for i in range(30)] + [(100 + i, f"word{i % 7} and more", "en") for i in range(20)]
    rows += [(200 + i, "x y", f"rare{i}") for i in range(9)] + [(1, "wort1 und mehr", "de")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(crf.train(docs, languages=2).labels) == ["de", "en"]


def test_distinct_features_are_the_distinct_ngrams():
    f = nbsvm.Features()
    for text in ["", "a", "abab abab", "ÄÖ ä" * 50]:
        got = f(text)
        padded = f" {text.lower()} "
        grams = {padded[i:i + n] for n in nbsvm.ORDERS for i in range(len(padded) - n + 1)}
        assert len(got) == len(set(got.tolist())) and len(grams) - 2 <= len(got) <= len(grams)


def test_models_without_usable_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    few = docs.limit(5)
    assert {r["score"] for r in gam.score_documents(few, gam.train(few, none)).collect()} == {0.5}
    assert nbsvm.score_documents(few, nbsvm.train(few, none)).where("predicted = 1").count() == 0
    untold = few.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in crf.label_documents(untold, crf.train(untold)).collect()} == {"und"}
    empty = docs.limit(0)
    assert gam.score_documents(empty, gam.train(empty, none)).count() == 0
    assert crf.label_documents(empty, crf.train(empty)).count() == 0


def test_language_on_held_out_and_code_switched_text(docs, awkward):
    model = crf.train(docs)
    known = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    judged = crf.label_documents(docs, model).where("held_out").collect()
    assert sum(r["lang_pred"] == known[r["doc_id"]] for r in judged) >= 0.95 * len(judged)
    out = {r["doc_id"]: r for r in crf.label_documents(awkward, model).collect()}
    assert [out[i]["lang_pred"] for i in (2, 3, 4, 7)] == ["und"] * 4
    assert all(0 <= r["score"] <= 1 for r in out.values())
    words = "the and of with that und der die nicht mit".split()
    marginals, _ = crf.Labeller(model).word_probabilities([words])
    best = [model.labels[i] for i in marginals.argmax(axis=1)]
    assert best == ["en"] * 5 + ["de"] * 5
    kept = crf.keep_identified(awkward, model, 0.3)
    assert kept.columns == awkward.columns and kept.where("doc_id IN (2, 3, 4, 7)").count() == 0


def peak_of(job):
    tracemalloc.start()
    try:
        out = job()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_labelling_takes_little_memory():
    """An executor holds several Python workers: new words and long texts are worked off in parts."""
    rng = np.random.default_rng(1)
    text = " ".join(f"{a:x}wort{b:x}" for a, b in rng.integers(0, 1 << 32, size=(60_000, 2)).tolist())
    model = crf.fit([("de", "der hund und die katze " * 20), ("en", "the dog and the cat " * 20),
                     ("es", "el perro y el gato " * 20), ("fr", "le chien et le chat " * 20)], steps=3)
    words = crf.words_of(text)
    got, mb = peak_of(lambda: model.emissions(words))
    assert mb < 30
    some = range(crf.WORDS_AT_ONCE - 3, crf.WORDS_AT_ONCE + 3)
    assert np.array_equal(got[list(some)], np.concatenate([model.emissions([words[i]]) for i in some]))
    assert model.emissions([]).shape == (0, 4)
    # many words again and again: beside the probabilities, no list of them all
    often = ["the dog and the cat " * 50] * 2000
    labeller = crf.Labeller(model)
    out, mb = peak_of(lambda: labeller.predict([*often, None, "12"]))
    assert mb < 90
    assert out[-2:] == [("und", 0.0)] * 2 and {lang for lang, _ in out[:-2]} == {"en"}


def test_forward_backward_equals_enumeration():
    import itertools
    rng = np.random.default_rng(3)
    sizes = np.array([3, 1, 4])
    logits, t, start = rng.normal(size=(8, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got, pairs = crf.forward_backward(logits, sizes, t, start)
    want, want_pairs, at = [], np.zeros((3, 3)), 0
    for n in sizes:
        total, marg = 0.0, np.zeros((n, 3))
        acc = np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            w = np.exp(start[path[0]] + sum(logits[at + i, y] for i, y in enumerate(path))
                       + sum(t[a, b] for a, b in zip(path, path[1:])))
            total += w
            for i, y in enumerate(path):
                marg[i, y] += w
            for a, b in zip(path, path[1:]):
                acc[a, b] += w
        want.append(marg / total)
        want_pairs += acc / total
        at += n
    assert np.allclose(got, np.concatenate(want)) and np.allclose(pairs, want_pairs)
