"""Corpus preparation from the text operators: language, quality, near-duplicates, personal data, packing.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; ``run`` writes each result as Parquet in the shared
folder and reads it back as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.llm import crf, gam, minhash, packing, pii
from quaylake.llm.common import materialize, share_code, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# a text goes when hardly any of its words has a clear language
LEAST_LANGUAGE_SCORE = 0.3
LEAST_QUALITY = 0.3
SHINGLE_WORDS = 5
PII_KEY = "test-tables"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in which the word labels agree on a language.

    Null texts and texts without a letter have none and go. Where no document
    outside the held-out fold has a ``lang`` there is nothing to learn from, and all
    rows stay. Repeated rows stay or go together; columns beside those of
    ``documents`` are not carried (here and in the next stages).
    """
    share_code(spark)
    model = crf.train(docs)
    if not model.labels:
        return docs.select(*COLUMNS)
    return crf.keep_identified(docs, model, LEAST_LANGUAGE_SCORE).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality model does not reject.

    Null and empty texts have the score of a text without words. Without labels all
    rows score alike, above the limit, and stay.
    """
    share_code(spark)
    return gam.keep_good(docs, gam.train(docs, table(spark, sf_dir, "labels")), LEAST_QUALITY).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: the one with the smallest id.

    Rows that repeat an id are one document and stay or go together; rows without
    an id cannot be named as copies and stay.
    """
    share_code(spark)
    kept = minhash.near_duplicates(docs, width=SHINGLE_WORDS).where("kept").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").select(*COLUMNS)
    return named.unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by surrogates; ``n_chars`` follows the new text."""
    share_code(spark)
    return (pii.pseudonymize(docs.select(*COLUMNS), PII_KEY)
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place the token pieces of the documents in sequences; a null or empty text is the end id alone."""
    share_code(spark)
    return packing.packed_documents(docs, added=packing.added_tokens())


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", pack),
]
# no stage has an SQL form; the tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
