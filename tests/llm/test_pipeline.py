"""The pipeline, stage by stage, against direct versions on the smallest tables."""

import corpus_pipeline
from quaylake.llm import crf, gam, packing, pii
from quaylake.llm.common import materialize

from .conftest import SF
from .test_neighbours import brute


def test_stages(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs, kept = documents, [{r["doc_id"]: r for r in documents.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == documents.columns
        kept.append({r["doc_id"]: r for r in docs.collect()})
    start, language, quality, single, private = kept
    judged = {r["doc_id"]: r for r in crf.label_documents(documents, crf.train(documents)).collect()}
    assert set(language) == {i for i, r in judged.items() if r["lang_pred"] != "und" and r["score"] >= 0.3}
    after = documents.where(documents["doc_id"].isin([int(i) for i in language]))
    scored = {r["doc_id"]: r["score"] for r in gam.score_documents(after, gam.train(after, labels)).collect()}
    assert set(quality) == {i for i, s in scored.items() if s >= 0.3}
    classes = brute([(i, r["text"]) for i, r in quality.items()], 5)
    assert set(single) == {i for i, (_, root) in classes.items() if i == root}
    assert set(private) == set(single)
    for i, r in private.items():
        assert r["n_chars"] == len(r["text"])
        assert "@" not in single[i]["text"] or r["text"] != single[i]["text"]
    assert pii.pseudonymize(docs, "x").count() == len(private)
    # clean labelled documents pass the first two stages
    clean = {r["doc_id"] for r in labels.where("quality = 1").collect()} & set(start)
    assert len(clean & set(quality)) >= 0.97 * len(clean)


def test_run_packs_all_that_is_kept(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    totals = {}
    for r in rows:
        totals.setdefault(r["doc_id"], [0, r["doc_tokens"]])[0] += r["length"]
    assert rows and all(a == b for a, b in totals.values())
    assert max(r["offset"] + r["length"] for r in rows) <= packing.CAPACITY


def test_stages_on_awkward_rows(spark, awkward, tmp_path):
    spark.createDataFrame([(1, 1, 0), (4, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    docs = awkward.where("doc_id IS NULL OR doc_id <> 5").withColumn("n_chars", awkward["n_words"].cast("long"))
    for rows in (docs, docs.withColumn("lang", docs["doc_id"].cast("string").substr(9, 1)), docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, str(tmp_path))
            assert name == "packing" or out.columns == corpus_pipeline.COLUMNS
            out.collect()
    repeated = {r["doc_id"]: r["count"] for r in
                corpus_pipeline.language(spark, docs, str(tmp_path)).groupBy("doc_id").count().collect()}
    assert repeated[1] == 2 and 2 not in repeated and 3 not in repeated


def test_a_corpus_without_languages_stays_whole(spark):
    docs = spark.createDataFrame([(i, f"A plain text with the number {i} in it.", None, "s", 30) for i in range(20)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.language(spark, docs, SF).count() == 20
