"""Quality rules with risk-controlled thresholds.

Every document gets surface statistics in one pass of SQL functions. A rule
compares one statistic with a cut-off. The cut-offs come from labelled
holdouts: for each stratum (a band of document lengths) and each cut-off of a
fixed grid, the clean holdouts that the cut-off would reject are counted, and
the exact binomial tail decides whether the false rejection rate is provably
below the rule's share of ``risk``. All grid points of all rules and strata
are tested at once, so the level of each test is ``delta`` divided by their
number (Bonferroni). Among the cut-offs that pass, the one that removes the
most junk for the clean text it costs is used; a rule without one is off in
that stratum.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import NON_SPACE_CLASS, SPACE_CLASS, materialize, one_label

SYMBOLS = "#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Reject when ``numerator / n_words`` is above (or below) a cut-off.

    ``cutoffs`` are listed from the strictest to the most lenient.
    """

    name: str
    numerator: str
    above: bool
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols", True, (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.75, 1.0, 1.5, 2.0)),
    Rule("duplicate_lines", "n_dup_lines", True, (0.01, 0.02, 0.03, 0.04, 0.05, 0.08, 0.1, 0.15, 0.2, 0.3)),
    Rule("repeats", "n_repeat_words", True, (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45)),
    Rule("short_words", "word_chars", False, (4.0, 3.75, 3.5, 3.25, 3.0, 2.75, 2.5, 2.25, 2.0, 1.5)),
    Rule("long_words", "word_chars", True, (6.5, 7.0, 7.5, 8.0, 8.5, 9.0, 10.0, 12.0, 15.0, 20.0)),
)
STRATA = (("short", 0), ("medium", 150), ("long", 400))
RISK = 0.05
DELTA = 0.05
CLEAN_COST = 10


def document_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the statistics of every whole text; a null text counts as empty.

    ``n_repeat_words`` counts the words inside three-word windows whose content
    occurs at least twice: windows are hashed, and only documents with an equal
    pair of hashes sort (hash, position) pairs to find the repeated ones.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    # fixed helper names that cannot clash with the caller's columns
    out = docs.withColumn("__t", t)
    out = out.withColumn("__w", F.filter(F.split("__t", SPACE_CLASS + "+"), lambda w: w != ""))
    out = out.withColumn("n_words", F.size("__w").cast("long"))
    out = out.withColumn(
        "__h", F.expr("""CASE WHEN n_words >= 4 THEN transform(sequence(1, CAST(n_words AS INT) - 2), i ->
                         xxhash64(element_at(__w, i), element_at(__w, i + 1), element_at(__w, i + 2)))
                         ELSE CAST(array() AS ARRAY<BIGINT>) END"""))
    out = out.withColumn(
        "__s", F.expr("""CASE WHEN size(array_distinct(__h)) < size(__h)
                         THEN sort_array(transform(__h, (h, i) -> named_struct('h', h, 'p', i)))
                         ELSE CAST(array() AS ARRAY<STRUCT<h: BIGINT, p: INT>>) END"""))
    out = out.withColumn(
        "__p", F.expr("""sort_array(transform(filter(__s, (x, i) ->
                            (i > 0 AND element_at(__s, i).h = x.h) OR
                            (i < size(__s) - 1 AND element_at(__s, i + 2).h = x.h)), x -> x.p))"""))
    lines = F.filter(F.split("__t", "\n"), lambda line: line.rlike(NON_SPACE_CLASS))
    return out.withColumns({
        "word_chars": F.length(F.regexp_replace("__t", SPACE_CLASS + "+", "")).cast("long"),
        "n_symbols": (F.length("__t") - F.length(F.translate(F.col("__t"), SYMBOLS, ""))).cast("long"),
        "__l": lines,
    }).withColumns({
        "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
        "n_repeat_words": F.expr("""aggregate(__p, named_struct('last', -3, 'n', 0L),
                (a, p) -> named_struct('last', p, 'n', a.n + least(3, p - a.last)), a -> a.n)"""),
    }).drop("__t", "__w", "__h", "__s", "__p", "__l")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def stratum_of(strata=STRATA) -> Column:
    out = F.lit(strata[0][0])
    for name, least in strata[1:]:
        out = F.when(F.col("n_words") >= least, F.lit(name)).otherwise(out)
    return out


def strictness(rule: Rule) -> Column:
    """How many of the rule's cut-offs would reject the document (from the lenient end)."""
    value = F.col(rule.numerator).cast("double") / F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    cuts = F.array(*[F.lit(c) for c in reversed(rule.cutoffs)])
    hits = F.filter(cuts, lambda c: (value > c) if rule.above else (value < c))
    return F.size(hits).cast("int")


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) by summing its terms in logarithms; 1 beyond the mean."""
    odds = math.log(p / (1 - p))
    start = F.struct((n.cast("double") * F.lit(math.log1p(-p))).alias("term"),
                     (n.cast("double") * F.lit(math.log1p(-p))).alias("total"))

    def step(acc, i):
        term = acc["term"] + F.log((n - i + 1).cast("double") / i.cast("double")) + F.lit(odds)
        top = F.greatest(acc["total"], term)
        return F.struct(term.alias("term"),
                        (top + F.log1p(F.exp(-F.abs(acc["total"] - term)))).alias("total"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1)).cast("long"))) \
        .otherwise(F.expr("CAST(array() AS ARRAY<BIGINT>)"))
    return F.when(k.cast("double") > n.cast("double") * F.lit(p), F.lit(1.0)).otherwise(
        F.exp(F.aggregate(terms, start, step, lambda acc: acc["total"])))


def calibrate(stats: DataFrame, labels: DataFrame, rules=RULES, strata=STRATA,
              risk: float = RISK, delta: float = DELTA, clean_cost: int = CLEAN_COST) -> DataFrame:
    """Choose per stratum and rule the cut-off; one row (stratum, limits) per stratum with any.

    ``limits[i]`` is the least ``strictness`` at which rule ``i`` rejects, null
    where no cut-off passed. ``labels`` has doc_id and quality (1 clean, 0 junk).
    The work is one join of narrow rows and counts per (stratum, rule, strictness).
    """
    tests = sum(len(r.cutoffs) for r in rules) * len(strata)
    per_rule = risk / len(rules)
    holdout = (stats.where(~base_failed()).join(one_label(labels, "quality"), "doc_id")
               .select(stratum_of(strata).alias("stratum"), "label",
                       F.posexplode(F.array(*[strictness(r) for r in rules])).alias("rule", "reached")))
    counted = (holdout.groupBy("stratum", "rule", "reached")
               .agg(F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("clean"),
                    F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("junk")))
    size = counted.groupBy("stratum", "rule").agg(F.sum("clean").alias("n"))
    cuts = (counted.where("reached > 0")
            .select("stratum", "rule", "clean", "junk", F.explode(F.sequence(F.lit(1), "reached")).alias("level"))
            .groupBy("stratum", "rule", "level").agg(F.sum("clean").alias("k"), F.sum("junk").alias("caught"))
            .join(size, ["stratum", "rule"]))
    passed = (cuts.withColumn("gain", F.col("caught") - clean_cost * F.col("k"))
              .where((F.col("gain") > 0)
                     & (binomial_tail(F.col("n"), F.col("k"), per_rule) <= delta / tests)))
    best = (passed.groupBy("stratum", "rule")
            .agg(F.max_by("level", F.struct("gain", "level")).alias("level")))
    return best.groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == i, F.col("level"))).alias(f"limit_{i}") for i in range(len(rules))])


def apply_rules(docs: DataFrame, labels: DataFrame, rules=RULES, strata=STRATA,
                risk: float = RISK, delta: float = DELTA, clean_cost: int = CLEAN_COST) -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` for every document.

    Null and empty texts have zero words and fail the base test. Repeated rows
    are judged alike and all kept in the result; other columns of ``docs`` are
    not carried. Without usable labels every rule is off and ``kept`` is the base
    verdict. The text is read once: only doc_id and five counts are written to
    the shared folder for the calibration and the verdict.
    """
    stats = materialize(document_stats(docs.select("doc_id", "text")).select("doc_id", *STATS), "rule-stats")
    limits = calibrate(stats, labels, rules, strata, risk, delta, clean_cost)
    # one row per stratum, so the broadcast side is bounded by len(strata)
    joined = stats.withColumn("stratum", stratum_of(strata)).join(F.broadcast(limits), "stratum", "left")
    rejected = F.lit(False)
    for i, rule in enumerate(rules):
        rejected = rejected | F.coalesce(strictness(rule) >= F.col(f"limit_{i}"), F.lit(False))
    return (joined.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~rejected)
            .select("doc_id", *STATS, "base_failed", "kept"))
