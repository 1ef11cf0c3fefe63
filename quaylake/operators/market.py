"""Latest-state and reshaping operators over the documented nested fields
(X1-X8, J1, J4-J6, W4, T5, S9-S15, S17, P19, P22).

Every keyed operator is an aggregate with a map-side partial step (``max_by``,
``min``, ``count``) or a generator, so a hot key is pre-aggregated before the
shuffle; joins are equi-joins planned by AQE (broadcast only when the optimizer
has measured the side as small, or a caller-supplied work-list of bounded size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quaylake.functions import casts as C
from quaylake.functions.predicates import is_open
from quaylake.specs import SPECS

MONEY = C.MONEY
SIZE = "decimal(20,8)"
DEPTH = "decimal(38,16)"


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], tie: list[str] | None = None) -> DataFrame:
    """Latest row per key (X1, U3, S11): ``max_by(struct(row), struct(order, tie))``.

    A partial aggregate, so a key holding a third of all rows is reduced on the
    map side; no window sort of the hot key in one task.
    """
    tie = tie or []
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in order + tie])
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_r"))
              .select(*keys, *[F.col("_r")[c].alias(c) for c in rest]))


def latest_of_stream(df: DataFrame, stream: str, order: list[str] | None = None, tie: list[str] | None = None) -> DataFrame:
    """Latest row per key of a registered stream (X1, E1): the registry names the key."""
    keys = list(SPECS[stream].key)
    if not keys:
        raise ValueError(f"{stream} has no key")
    return latest_per_key(df, keys, order or ["_fetched_at"], tie)


def lookup_by_id(df: DataFrame, key: str, value, order: list[str], tie: list[str] | None = None) -> DataFrame:
    """Single market / event by id (S11): the latest snapshot row of that id."""
    return latest_per_key(df.where(F.col(key) == F.lit(value)), [key], order, tie)


def holders_of(df: DataFrame, condition_id: str, keep: list[str], key: str = "condition_id") -> DataFrame:
    """Holder rows of one market (S14): filter, then one row per holder."""
    return explode_holders(df.where(F.col(key) == F.lit(condition_id)), keep)


def open_only(df: DataFrame, active: str = "active", closed: str = "closed") -> DataFrame:
    """Open markets/events."""
    return df.where(is_open(active, closed))


def all_markets(df: DataFrame, closed: bool | None = None, col: str = "closed") -> DataFrame:
    """Optional closed filter (S9): ``None`` -> everything."""
    if closed is None:
        return df
    return df.where(F.coalesce(F.col(col), F.lit(False)) == F.lit(closed))


def merge_quotes(prices: DataFrame, mids: DataFrame, seq: list[str], key: str = "token_id",
                 mid_col: str = "mid") -> DataFrame:
    """Prices left-joined to midpoints (J1): duplicate mids -> last by ``seq`` wins,
    mids without a key are ignored, ``mid`` is renamed ``midpoint``."""
    last_mid = (mids.where(F.col(key).isNotNull())
                .groupBy(key).agg(F.max_by(F.col(mid_col), F.struct(*[F.col(c) for c in seq])).alias("midpoint")))
    return prices.join(last_mid, key, "left")


def price_record(df: DataFrame, key: str = "token_id", price: str = "price") -> DataFrame:
    """Keep only the id and price; missing id -> ``""``, missing price -> null."""
    return df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias(key),
                     F.col(price).alias(price))


def restrict_to_worklist(df: DataFrame, worklist: DataFrame, key: str) -> DataFrame:
    """Rows whose key is on the work-list (J4, S17); how to join is left to adaptive execution."""
    return df.join(worklist.select(key).distinct(), key, "left_semi")


def quotes_for(quotes: DataFrame, wanted: DataFrame, key: str, order: list[str], tie: list[str] | None = None
               ) -> DataFrame:
    """Latest quote of every wanted key that has one."""
    return latest_per_key(restrict_to_worklist(quotes, wanted, key), [key], order, tie)


def to_markets(facts: DataFrame, markets: DataFrame, fact_key: str, market_key: str) -> DataFrame:
    """Facts with the columns of their market (J6, trades side): an equi-join on the market's id."""
    return facts.join(markets, facts[fact_key] == markets[market_key])


def books_to_markets(books: DataFrame, markets: DataFrame, keep: list[str], asset: str = "asset_id",
                     **lists: str) -> DataFrame:
    """Books with the market and outcome their token belongs to (J6, books side).

    A market lists its tokens; they are exploded to rows of (``keep``, outcome,
    token_id) and joined on the token.
    """
    tokens = explode_outcomes(markets, keep, **lists).select(*keep, "outcome", "token_id")
    return books.join(tokens, books[asset] == tokens["token_id"]).drop("token_id")


def sports_to_tags(sports: DataFrame, tags: DataFrame, keep: list[str], col: str = "tags", tag_key: str = "id"
                   ) -> DataFrame:
    """One row per sport and tag with the tag's columns."""
    rows = csv_to_rows(sports, keep, col)
    return rows.join(tags, rows["tag_id"] == tags[tag_key].cast("string"))


def two_key_join(left: DataFrame, right: DataFrame, left_key: str, right_keys: list[str]) -> DataFrame:
    """``left.key IN (right.k1, right.k2, …)`` as a union of equi-joins, never an OR join.

    A right row that matches on an earlier key is not emitted again for a later one.
    """
    out = None
    for i, rk in enumerate(right_keys):
        cond = F.col(f"l.{left_key}") == F.col(f"r.{rk}")
        for prev in right_keys[:i]:
            cond = cond & ~F.col(f"r.{prev}").eqNullSafe(F.col(f"l.{left_key}"))
        j = left.alias("l").join(right.alias("r"), cond, "inner").select(
            "l.*", *[F.col(f"r.{c}").alias(f"r_{c}") for c in right.columns],
            F.lit(rk).alias("matched_on"))
        out = j if out is None else out.unionByName(j)
    return out


def readable_levels(levels: Column | str) -> Column:
    """Levels whose price and size are numbers, as (price, size) decimals; the others are skipped."""
    c = F.col(levels) if isinstance(levels, str) else levels
    parsed = F.transform(c, lambda x: F.struct(x["price"].try_cast(MONEY).alias("price"),
                                               x["size"].try_cast(SIZE).alias("size")))
    return F.filter(parsed, lambda x: x["price"].isNotNull() & x["size"].isNotNull())


def best_prices(bids: Column | str, asks: Column | str) -> dict[str, Column]:
    """Best bid/ask, midpoint and spread from level arrays.

    Level order is not trusted: max over bids, min over asks, of the readable levels.
    """
    best_bid = F.array_max(F.transform(readable_levels(bids), lambda x: x["price"]))
    best_ask = F.array_min(F.transform(readable_levels(asks), lambda x: x["price"]))
    return {"best_bid": best_bid, "best_ask": best_ask,
            "midpoint": (best_bid + best_ask) / F.lit(2), "spread": best_ask - best_bid}


def _depth(levels: Column) -> Column:
    """Sum of price times size over readable levels."""
    return F.aggregate(levels, F.lit(0).cast(DEPTH), lambda total, x: (
        total + F.coalesce((x["price"].cast(SIZE) * x["size"]).cast(DEPTH), F.lit(0).cast(DEPTH))).cast(DEPTH))


def book_quote(df: DataFrame, bids: str = "bids", asks: str = "asks", keep: list[str] | None = None) -> DataFrame:
    """Best bid/ask, midpoint, spread, notional depth per side and skipped levels.

    The levels are parsed in a projection of their own; prices and depth read the
    decimals.
    """
    keep = keep or []
    read = df.select(*keep, readable_levels(bids).alias("_b"), readable_levels(asks).alias("_a"),
                     (F.coalesce(F.size(bids), F.lit(0)) + F.coalesce(F.size(asks), F.lit(0))).alias("_n"))
    best = read.select(*keep, "_b", "_a", "_n", F.array_max(F.col("_b.price")).alias("best_bid"),
                       F.array_min(F.col("_a.price")).alias("best_ask"))
    bid, ask = F.col("best_bid"), F.col("best_ask")
    return best.select(*keep, "best_bid", "best_ask", ((bid + ask) / F.lit(2)).alias("midpoint"),
                       (ask - bid).alias("spread"), _depth(F.col("_b")).alias("bid_depth"),
                       _depth(F.col("_a")).alias("ask_depth"),
                       (F.col("_n") - F.coalesce(F.size("_b"), F.lit(0)) - F.coalesce(F.size("_a"), F.lit(0)))
                       .cast("int").alias("bad_levels"))


def token_quote(df: DataFrame, token, field: str, order: list[str], tie: list[str] | None = None,
                key: str = "asset_id") -> DataFrame:
    """One field of one token's latest row.

    Of books: best_bid, best_ask, midpoint, spread, or ``book`` for the levels
    themselves. Of prices: ``price``, as it was sent.
    """
    last = lookup_by_id(df, key, token, order, tie)
    if field == "book":
        return last.select(key, "bids", "asks")
    if field == "price":
        return last.select(key, "price")
    return last.select(key, best_prices("bids", "asks")[field].alias(field))


def explode_book_levels(df: DataFrame, keep: list[str], bids: str = "bids", asks: str = "asks") -> DataFrame:
    """One row per level: side, rank (0-based position), price, size."""
    bid = df.select(*keep, F.lit("bid").alias("side"), F.posexplode(bids).alias("rank", "lvl"))
    ask = df.select(*keep, F.lit("ask").alias("side"), F.posexplode(asks).alias("rank", "lvl"))
    return bid.unionByName(ask).select(*keep, "side", "rank", F.col("lvl.price").alias("price"),
                                       F.col("lvl.size").alias("size"))


def explode_price_changes(df: DataFrame, keep: list[str], col: str = "price_changes") -> DataFrame:
    """One row per changed token."""
    return df.select(*keep, F.posexplode(col).alias("change_no", "c")).select(*keep, "change_no", "c.*")


def explode_holders(df: DataFrame, keep: list[str], col: str = "holders") -> DataFrame:
    """One row per holder; a list-less record keeps one row with nulls."""
    return df.select(*keep, F.posexplode_outer(col).alias("holder_no", "h")).select(*keep, "holder_no", "h.*")


def explode_children(df: DataFrame, keep: list[str], col: str) -> DataFrame:
    """Events' nested markets / tags."""
    return df.select(*keep, F.posexplode_outer(col).alias("child_no", "child"))


def dedup_trades(df: DataFrame, keys: list[str], ts: str = "_fetched_at") -> DataFrame:
    """Overlapping polls -> one row per trade identity, first fetch kept."""
    return df.groupBy(*keys).agg(F.min(ts).alias(ts), F.count(F.lit(1)).alias("copies"))


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """Top ``n`` per group (W4). ``row_number() <= n`` is planned with a
    map-side WindowGroupLimit, so only n rows per group and partition are shuffled."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def recent_trades(df: DataFrame, market: str | None = None, market_col: str = "conditionId",
                  order: list[Column] | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    """Optional market filter, newest first, offset + limit."""
    if market is not None:
        df = df.where(F.col(market_col) == F.lit(market))
    return df.orderBy(*(order or [F.desc("timestamp"), F.asc("transactionHash")])).offset(offset).limit(limit)


def head_rows(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """Deterministic head / tail (T5): tail = head of the reversed order."""
    return df.orderBy(*order).limit(n)


def explode_outcomes(df: DataFrame, keep: list[str], outcomes: str = "outcomes",
                     prices: str = "outcomePrices", tokens: str = "clobTokenIds") -> DataFrame:
    """Outcome, price and token id aligned by position."""
    z = C.zip_outcomes(outcomes, prices, tokens)
    return df.select(*keep, F.posexplode_outer(z).alias("outcome_no", "o")).select(
        *keep, "outcome_no", F.col("o.outcome").alias("outcome"), F.col("o.price").alias("price"),
        F.col("o.token_id").alias("token_id"))


def csv_to_rows(df: DataFrame, keep: list[str], col: str, out: str = "tag_id") -> DataFrame:
    """Comma-separated ids -> one row each (P20, first half of X8)."""
    return df.select(*keep, F.explode(C.split_csv(col)).alias(out))
