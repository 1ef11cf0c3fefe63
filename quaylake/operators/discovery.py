"""Id bookkeeping.

Cumulative id sets are tables ``(kind, id, first_seen)`` instead of in-memory
lists. Everything is a distinct/anti-join/aggregate, so work scales with the
data and hot ids collapse in the map-side partial aggregate before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quaylake.functions.predicates import has_id
from quaylake.session import write_shared


def distinct_ids(df: DataFrame, key: str = "id") -> DataFrame:
    """Non-empty ids, once each (F2 + distinct)."""
    return df.where(has_id(key)).select(key).distinct()


def new_ids(current: DataFrame, known: DataFrame, key: str = "id") -> DataFrame:
    """Ids in ``current`` that ``known`` lacks (J2, U2): distinct first, then anti-join."""
    return distinct_ids(current, key).join(distinct_ids(known, key), key, "left_anti")


def unsubscribed(tokens: DataFrame, subscribed: DataFrame, key: str = "token_id") -> DataFrame:
    """Tokens not yet subscribed."""
    return new_ids(tokens, subscribed, key)


def id_union(*id_tables: DataFrame) -> DataFrame:
    """Cumulative id set: union, one row per (kind, id), earliest ``first_seen``.

    Ids are never removed (a closed market's tokens stay known).
    """
    u = id_tables[0]
    for t in id_tables[1:]:
        u = u.unionByName(t)
    return u.groupBy("kind", "id").agg(F.min("first_seen").alias("first_seen"))


def as_id_table(df: DataFrame, kind: str, key: str = "id", seen: str = "_fetched_at") -> DataFrame:
    return (df.where(has_id(key))
              .groupBy(F.col(key).cast("string").alias("id"))
              .agg(F.min(seen).alias("first_seen"))
              .select(F.lit(kind).alias("kind"), "id", "first_seen"))


def worklist(df: DataFrame, n: int, order: list) -> DataFrame:
    """First ``n`` rows by an explicit, total order (T1, T2, T4). Planned as TakeOrderedAndProject."""
    return df.orderBy(*order).limit(n)


def global_index(df: DataFrame, order: list[str], num_partitions: int | None = None,
                 col: str = "idx") -> DataFrame:
    """0-based position of each row in ``order`` without a single-partition window.

    Range-partition by the order, take the in-partition position from
    ``monotonically_increasing_id`` and add per-partition offsets from a tiny
    count table (one row per partition, so its broadcast is bounded by the
    partition count, not by the data). The positions are written to the shared
    folder first: counts and rows then come from the same partitions, whatever
    the optimizer reuses or recomputes.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
               .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("_pid", F.shiftright(F.col("_mid"), 33)) \
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    ordered = write_shared(ordered.drop("_mid"), "global-index")
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (ordered.join(F.broadcast(offsets), "_pid")
                   .withColumn(col, F.col("_off") + F.col("_pos"))
                   .drop("_pid", "_pos", "_off"))


def chunk_ids(ids: DataFrame, key: str, size: int, previously_subscribed: bool = False,
              num_partitions: int | None = None) -> DataFrame:
    """Split ids (ordered by ``key``) into batches of ``size``.

    Only the first batch is ``initial`` and only when nothing was subscribed.
    """
    idx = global_index(ids.select(key).distinct(), [key], num_partitions)
    chunk = F.floor(F.col("idx") / F.lit(size)).cast("long")
    return idx.select(key, "idx", chunk.alias("chunk_no"),
                      ((chunk == 0) & F.lit(not previously_subscribed)).alias("initial"))


def discovery_summary(markets: DataFrame, events: DataFrame, new_markets: DataFrame,
                      new_events: DataFrame, new_tokens: DataFrame, tokens: DataFrame) -> DataFrame:
    """One-row crawl summary (A4): counts, new counts and what changed.

    ``markets_changed`` (new markets or tokens) paces the market poller,
    ``events_changed`` the event poller; ``changed`` is either.

    All inputs are tagged and unioned, then counted in one aggregate (no joins).
    """
    parts = {"markets": markets, "events": events, "new_markets": new_markets,
             "new_events": new_events, "new_tokens": new_tokens, "total_tokens": tokens}
    tagged = None
    for name, df in parts.items():
        t = df.select(F.lit(name).alias("metric"))
        tagged = t if tagged is None else tagged.unionByName(t)
    out = tagged.agg(*[F.count_if(F.col("metric") == name).alias(name) for name in parts])
    return (out.withColumn("markets_changed", (F.col("new_markets") + F.col("new_tokens")) > 0)
            .withColumn("events_changed", F.col("new_events") > 0)
            .withColumn("changed", F.col("markets_changed") | F.col("events_changed")))
