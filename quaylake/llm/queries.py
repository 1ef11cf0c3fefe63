"""Registered queries of the text operators and, where SQL can say it, their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quaylake.llm import (alignment, bpe, crf, gam, hardneg, linkgraph, minhash, mixing, nbsvm, packing, permutation,
                          pii, rules)
from quaylake.llm.common import share_code, table
from quaylake.llm.sql import HARD_NEGATIVES_SQL, MIXING_SQL, PROPAGATION_SQL, QUALITY_RULES_SQL


# the key of the surrogates is a secret of the job that runs; this one serves the test tables
PII_KEY = "test-tables"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_documents(spark, table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), added=packing.added_tokens())


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return gam.score_documents(docs, gam.train(docs, table(spark, sf_dir, "labels")))


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op6_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.neighbours_of_sample(table(spark, sf_dir, "embeddings"))


def op7_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op8_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return crf.label_documents(docs, crf.train(docs))


def op9_nb_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return nbsvm.score_documents(docs, nbsvm.train(docs, table(spark, sf_dir, "labels")))


def op10_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judge_pages(table(spark, sf_dir, "pages"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.hard_negatives_of_sample(table(spark, sf_dir, "embeddings"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_packing": op2_packing,
    "op3_quality_rules": op3_quality_rules,
    "op4_gam_quality": op4_gam_quality,
    "op5_pii_surrogates": op5_pii_surrogates,
    "op6_permutation_index": op6_permutation_index,
    "op7_bottom_k": op7_bottom_k,
    "op8_crf_language": op8_crf_language,
    "op9_nb_toxicity": op9_nb_toxicity,
    "op10_link_graph": op10_link_graph,
    "op11_alignment": op11_alignment,
    "op12_mixing": op12_mixing,
    "op13_hard_negatives": op13_hard_negatives,
}

def _with_code(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(share_code(spark), sf_dir)


QUERIES = {name: _with_code(query) for name, query in _QUERIES.items()}

ORACLE: dict[str, str] = {
    "op3_quality_rules": QUALITY_RULES_SQL,
    "op10_link_graph": PROPAGATION_SQL,
    "op12_mixing": MIXING_SQL,
    "op13_hard_negatives": HARD_NEGATIVES_SQL,
}
