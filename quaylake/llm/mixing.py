"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key divided by its quality weight; in order
of the key the documents of a source are a weighted sample without replacement,
whatever its length. A source first gives complete epochs, then the documents
with the smallest keys while their words fit into what is left of its target.
One document that is too long for that is weighed against the ones around it.

No source is sorted as a whole. Its words are summed in bins of the key, the bin
that crosses the budget is cut into finer bins, and only the rows of the one
fine bin that crosses it are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import SPACE_CLASS, WORD_PATTERN, materialize
from quaylake.operators.discovery import global_index

SOURCE_WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
# a document of nothing but symbols or one repeated line keeps this weight
LEAST_WEIGHT = 0.05
# bins of the key's logarithm: so many to a unit, and so many finer ones to each
COARSE = 32
FINE = 8192
KEY_BITS = 52


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between LEAST_WEIGHT squared and 1: share of letters among what is not white space, times share of distinct lines."""
    solid = F.length(F.regexp_replace(text, SPACE_CLASS, ""))
    letters = F.length(F.regexp_replace(text, r"[\x00-\x40\x5B-\x60\x7B-\x7F]", ""))
    lines = F.split(text, "\n", -1)
    share = F.when(solid > 0, letters / solid).otherwise(0.0)
    return (F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(LEAST_WEIGHT))
            * F.greatest(F.coalesce(F.size(F.array_distinct(lines)) / F.size(lines), F.lit(0.0)), F.lit(LEAST_WEIGHT)))


def exponential_key(name: Column, weight: Column) -> Column:
    """-ln(u) / weight with u, strictly between 0 and 1, from the md5 digest of ``name``."""
    digits = F.conv(F.substring(F.md5(name), 1, KEY_BITS // 4), 16, 10).cast("long")
    u = (digits.cast("double") + F.lit(0.5)) / F.lit(float(1 << KEY_BITS))
    return -F.log(u) / weight


def measured(docs: DataFrame, size: Column, weight: Column) -> DataFrame:
    """(rid, doc_id, source, size, key) of every row of ``docs``, written to the shared folder.

    The key depends on id and text alone, so reruns agree and only rows that repeat
    both have equal keys; ``rid`` tells those apart.
    """
    name = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.col("source").cast("string"),
                       size.alias("size"), exponential_key(name.cast("binary"), weight).alias("key"))
    return materialize(rows, "mix-measured")


def targets(rows: DataFrame, weights: Sequence[float] = SOURCE_WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) of all sources.

    Sources in order of code point, null last, take ``weights`` in turn and share the
    sum of all sizes. A target above ``most`` times its source's size stops there and
    the excess goes to the other sources by weight, until none is above. Only the
    two sums of a round reach the driver.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = global_index(sizes.where("source IS NOT NULL"), ["source"])
    n = named.count()
    placed = named.unionByName(sizes.where("source IS NULL").withColumn("idx", F.lit(n)))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.col("idx") % len(weights) + 1).cast("int"))
    sources = materialize(placed.select("source", "source_size", turn.alias("weight")), "mix-sources")
    cap = F.lit(float(most)) * F.col("source_size")
    total, level, full = None, None, -1
    while True:
        above = F.lit(False) if level is None else cap < F.lit(level) * F.col("weight")
        r = sources.agg(F.sum("source_size").alias("total"), F.count_if(above).alias("full"),
                        F.sum(F.when(above, cap)).alias("held"), F.sum(F.when(~above, F.col("weight"))).alias("open")).first()
        total = float(r["total"] or 0)
        if not r["open"] or r["full"] == full:
            break
        full, left, share = r["full"], total - (r["held"] or 0.0), r["open"]
        level = left / share
    if level is None:
        return sources.select("source", "source_size", F.lit(0.0).alias("target"))
    open_target = F.lit(left) * F.col("weight") / F.lit(share)
    return sources.select("source", "source_size", F.when(above, cap).otherwise(open_target).alias("target"))


def _crossing(sums: DataFrame, budgets: DataFrame, bin_name: str, keys: list[str]) -> DataFrame:
    """(source, alt, bin, left): the first bin whose words do not all fit, and the budget left before it.

    ``sums`` has the words of every bin by ``keys``, ``budgets`` source, alt and left.
    A budget that holds all words is not returned.
    """
    upto = F.sum("words").over(Window.partitionBy(*keys).orderBy(bin_name))
    same = " AND ".join(f"s.{k} <=> b.{k}" for k in keys)
    over = sums.withColumn("upto", upto).alias("s").join(budgets.alias("b"), F.expr(same)).where("upto > left")
    first = F.min_by(F.struct(F.col(bin_name), (F.col("left") - F.col("upto") + F.col("words")).alias("left")), F.col(bin_name))
    return (over.groupBy(F.col("b.source").alias("source"), F.col("b.alt").alias("alt")).agg(first.alias("x"))
            .select("source", "alt", f"x.{bin_name}", "x.left"))


def prefix_stops(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, alt, stop): the first row, in order of key, that no longer fits into a budget (source, alt, left).

    ``stop`` has the row's key, rid and size, and the budget ``left`` before it. A
    budget that holds all rows of its source is not returned.
    """
    log = F.log("key")
    binned = rows.withColumn("coarse", F.floor(log * COARSE)).withColumn("fine", F.floor(log * (COARSE * FINE)))
    sums = binned.groupBy("source", "coarse").agg(F.sum("size").alias("words"))
    coarse = materialize(_crossing(sums, budgets, "coarse", ["source"]), "mix-coarse")
    within = (binned.alias("r").join(coarse.alias("c"), F.expr("r.source <=> c.source AND r.coarse = c.coarse"))
              .select("r.source", "c.alt", "r.fine", "r.size"))
    sums = within.groupBy("source", "alt", "fine").agg(F.sum("size").alias("words"))
    fine = materialize(_crossing(sums, coarse, "fine", ["source", "alt"]), "mix-fine")
    edge = (binned.alias("r").join(fine.alias("c"), F.expr("r.source <=> c.source AND r.fine = c.fine"))
            .select("r.source", "c.alt", "r.key", "r.rid", "r.size", "c.left"))
    order = (Window.partitionBy("source", "alt").orderBy("key", "rid")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    stop = F.struct("key", "rid", "size", (F.col("left") - F.col("upto") + F.col("size")).alias("left"))
    return materialize(edge.withColumn("upto", F.sum("size").over(order)).where("upto > left").groupBy("source", "alt")
                       .agg(F.min_by(stop, F.struct("key", "rid")).alias("stop")), "mix-stop")


def fractional_cut(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, stop, past, closing): how the documents of a fractional selection are told.

    ``budgets`` has source and left, less than the words of the source. Taken are the
    rows before ``stop`` in order of key, or all if it is null; ``past`` is the first
    row that does not fit into the budget. Either the rows after it go on filling
    what is left without it, or it is taken itself and the rows before it end
    earlier, whichever comes closer to the budget. Last, of the rows that are not
    taken, the one whose size is closest to the gap closes it, if that makes it
    smaller: its rid is ``closing``.
    """
    rows = rows.where("size > 0")
    budgets = materialize(budgets.select("source", F.lit("past").alias("alt"), "left"), "mix-budgets")
    first = prefix_stops(rows, budgets).select("source", F.col("stop").alias("past"))
    known = materialize(first.alias("f").join(budgets.alias("b"), F.expr("f.source <=> b.source"))
                        .select("f.source", "past", "left"), "mix-past")
    # the same order with two other budgets: beyond the row as if it were not there, and up to what it leaves
    other = materialize(
        known.select("source", F.lit("without").alias("alt"), (F.col("left") + F.col("past.size")).alias("left"))
        .unionByName(known.where("left >= past.size").select(
            "source", F.lit("with").alias("alt"), (F.col("left") - F.col("past.size")).alias("left"))), "mix-budgets")
    words = rows.groupBy("source").agg(F.sum("size").alias("words"))
    ends = (other.alias("o").join(prefix_stops(rows, other).alias("s"), F.expr("o.source <=> s.source AND o.alt = s.alt"), "left")
            .join(words.alias("w"), F.expr("o.source <=> w.source"))
            .select("o.source", "o.alt", "stop", F.coalesce("stop.left", F.col("o.left") - F.col("words")).alias("gap")))
    chosen = ends.groupBy("source").agg(F.min_by(F.struct("alt", "stop", "gap"), F.struct(
        F.col("gap"), (F.col("alt") == "with"))).alias("x")).select("source", "x.*")
    cut = materialize(chosen.alias("c").join(known.alias("k"), F.expr("c.source <=> k.source"))
                      .select("c.source", "alt", "stop", "past", "gap"), "mix-cut")
    rest = (rows.alias("r").join(cut.alias("c"), F.expr("r.source <=> c.source"))
            .where(~_selected() & (F.abs(F.col("gap") - F.col("size")) < F.col("gap"))))
    closing = rest.groupBy(F.col("c.source").alias("source")).agg(
        F.min_by("rid", F.struct(F.abs(F.col("gap") - F.col("size")), F.col("key"), F.col("rid"))).alias("closing"))
    return (cut.alias("s").join(closing.alias("c"), F.expr("s.source <=> c.source"), "left")
            .select("s.source", "alt", "stop", "past", "closing"))


def _selected() -> Column:
    """True for the rows that a cut takes, without the closing one."""
    before = F.expr("stop IS NULL OR struct(key, rid) < struct(stop.key, stop.rid)")
    return F.when(F.col("rid") == F.col("past.rid"), F.col("alt") == "with").otherwise(before)


def mix(docs: DataFrame, weights: Sequence[float] = SOURCE_WEIGHTS, most: int = MOST_EPOCHS,
        size: Column | None = None, weight: Column | None = None) -> DataFrame:
    """How often the mix takes every document: doc_id, size, source_size, target, epochs, taken.

    ``docs`` has doc_id, text and source; ``size`` (words of the text) and ``weight``
    (``quality_weight``, positive) may be given as columns of it. ``taken`` is ``size``
    times ``epochs``: the complete epochs of the source, and one more for the
    documents of its fractional selection, at most ``most`` together.

    A null text has size 0 and is never taken; a null source is a source of its own;
    repeated rows and null ids are documents of their own; sources without a word
    have target 0; an empty table gives no rows; other columns are not read.
    """
    text = F.col("text")
    rows = measured(docs, n_words(text) if size is None else size, quality_weight(text) if weight is None else weight)
    budget = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = materialize(
        targets(rows, weights, most).withColumn("complete", F.least(budget, F.lit(most)))
        .withColumn("left", F.col("target") - F.col("complete") * F.col("source_size")), "mix-plan")
    # a source whose target is a whole number of epochs has no fractional selection
    cut = fractional_cut(rows, plan.where("left > 0 AND complete < " + str(int(most))))
    ends = materialize(plan.alias("p").join(cut.alias("c"), F.expr("p.source <=> c.source"), "left")
                       .select("p.*", "alt", "stop", "past", "closing"), "mix-ends")
    chosen = F.col("past").isNotNull() & (_selected() | F.coalesce(F.col("rid") == F.col("closing"), F.lit(False)))
    epochs = F.col("complete") + F.when(chosen, 1).otherwise(0)
    return (rows.alias("r").join(ends.alias("e"), F.expr("r.source <=> e.source"))
            .select("doc_id", "size", "source_size", "target", epochs.cast("int").alias("epochs"),
                    (F.col("size") * epochs).cast("long").alias("taken")))
