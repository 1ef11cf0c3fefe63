"""Stream registry (E1): one declaration per landed stream.

Each spec names the stream, its rotation (hour or day), the ``_source`` value the
collector writes, the bronze schema (explicit, never inferred in production
paths), the key used by latest-per-key scans and top-level fields that are
dropped before parsing (series ``events`` can be 57 MB+ per record).
Unknown top-level keys are kept in ``_extra`` (``map<string,variant>``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

META_DDL = "_fetched_at DOUBLE, _source STRING"

LEVELS = "array<struct<price:string,size:string>>"


@dataclass(frozen=True)
class StreamSpec:
    name: str
    ddl: str
    daily: bool = False
    source_value: str | None = None
    key: tuple[str, ...] = ("id",)
    drop_fields: tuple[str, ...] = ()

    @property
    def source(self) -> str:
        return self.source_value or self.name

    @property
    def schema(self) -> StructType:
        """Bronze schema: metadata columns first, then the documented fields."""
        ddl = META_DDL + (", " + self.ddl if self.ddl else "")
        return StructType.fromDDL(ddl)

    @property
    def known_keys(self) -> list[str]:
        return [f.name for f in self.schema.fields] + list(self.drop_fields)

    @property
    def times(self) -> dict[str, str]:
        return TIME_FIELDS.get(self.name, {})


@dataclass(frozen=True)
class ChannelSpec:
    """A push channel: its streams by route, its control frames and how message types choose a route."""

    name: str
    streams: dict[str, str]
    control: tuple[str, ...] = ()
    event_routes: dict[str, str] = field(default_factory=dict)


# ---- fixed values: stream names, rotations and _source values -------------
SPECS: dict[str, StreamSpec] = {s.name: s for s in [
    StreamSpec("gamma/markets",
               "id STRING, question STRING, conditionId STRING, slug STRING, outcomes STRING, "
               "outcomePrices STRING, clobTokenIds STRING, volume STRING, volumeNum DOUBLE, "
               "volume24hr DOUBLE, volume1wk DOUBLE, volume1mo DOUBLE, volume1yr DOUBLE, "
               "liquidity STRING, liquidityNum DOUBLE, active BOOLEAN, closed BOOLEAN, "
               "startDate STRING, endDate STRING, createdAt STRING, updatedAt STRING, "
               "lastTradePrice DOUBLE, bestBid DOUBLE, bestAsk DOUBLE, spread DOUBLE, "
               "oneDayPriceChange DOUBLE, oneWeekPriceChange DOUBLE, negRisk BOOLEAN, "
               "enableOrderBook BOOLEAN, competitive DOUBLE, rewardsMinSize BIGINT, "
               "rewardsMaxSpread DOUBLE, category STRING, image STRING, description STRING"),
    StreamSpec("gamma/events",
               "id STRING, title STRING, slug STRING, description STRING, active BOOLEAN, "
               "closed BOOLEAN, volume DOUBLE, volume24hr DOUBLE, liquidity DOUBLE, "
               "openInterest BIGINT, startDate STRING, endDate STRING, competitive DOUBLE, "
               "commentCount BIGINT, negRisk BOOLEAN, markets ARRAY<VARIANT>, "
               "tags ARRAY<STRUCT<id:STRING,label:STRING,slug:STRING>>"),
    StreamSpec("gamma/tags",
               "id STRING, label STRING, slug STRING, publishedAt STRING, createdAt STRING, "
               "updatedAt STRING, requiresTranslation BOOLEAN", daily=True),
    StreamSpec("gamma/series",
               "id STRING, title STRING, ticker STRING, slug STRING, seriesType STRING, "
               "recurrence STRING, active BOOLEAN, closed BOOLEAN, volume DOUBLE, "
               "volume24hr DOUBLE, liquidity DOUBLE, commentCount BIGINT",
               daily=True, drop_fields=("events",)),
    StreamSpec("gamma/sports",
               "id BIGINT, sport STRING, image STRING, resolution STRING, ordering STRING, "
               "tags STRING, series STRING", daily=True),
    StreamSpec("clob/prices", "token_id STRING, price VARIANT, midpoint STRING",
               key=("token_id",)),
    StreamSpec("clob/books",
               f"asset_id STRING, market STRING, timestamp STRING, hash STRING, bids {LEVELS}, "
               f"asks {LEVELS}, last_trade_price STRING, min_order_size STRING, "
               "tick_size STRING, neg_risk BOOLEAN", key=("asset_id",)),
    StreamSpec("data_api/trades",
               "proxyWallet STRING, side STRING, asset STRING, conditionId STRING, size DOUBLE, "
               "price DOUBLE, timestamp BIGINT, title STRING, slug STRING, icon STRING, "
               "eventSlug STRING, outcome STRING, outcomeIndex INT, name STRING, "
               "pseudonym STRING, transactionHash STRING, bio STRING, profileImage STRING",
               key=("transactionHash", "asset", "proxyWallet", "side", "size", "price", "timestamp")),
    StreamSpec("data_api/holders",
               "condition_id STRING, token STRING, data VARIANT, holders ARRAY<STRUCT<"
               "proxyWallet:STRING,name:STRING,pseudonym:STRING,asset:STRING,amount:DOUBLE,"
               "outcomeIndex:INT,displayUsernamePublic:BOOLEAN,verified:BOOLEAN>>",
               key=("condition_id", "token")),
    StreamSpec("ws_market/book",
               f"market STRING, asset_id STRING, timestamp STRING, hash STRING, bids {LEVELS}, "
               f"asks {LEVELS}", key=("asset_id",)),
    StreamSpec("ws_market/price_change",
               "market STRING, price_changes ARRAY<STRUCT<asset_id:STRING,price:STRING,"
               "size:STRING,side:STRING,hash:STRING,best_bid:STRING,best_ask:STRING>>",
               key=("market",)),
    StreamSpec("ws_market/last_trade_price", "market STRING, last_trade_price VARIANT",
               key=("market",)),
    StreamSpec("ws_sports/events", "", source_value="ws_sports", key=()),
    StreamSpec("ws_rtds/activity", "channel STRING", source_value="ws_rtds", key=()),
    StreamSpec("ws_rtds/crypto_prices", "channel STRING", key=()),
]}
# Push channels: the stream of each route; text control frames, compared after stripping, case-sensitive;
# message type -> route, anything else (or null) -> DEFAULT_ROUTE.
CHANNELS: dict[str, ChannelSpec] = {c.name: c for c in [
    ChannelSpec("ws_market",
                {"book": "ws_market/book", "price_change": "ws_market/price_change",
                 "last_trade_price": "ws_market/last_trade_price"},
                control=("PONG",),
                event_routes={"book": "book", "price_change": "price_change", "last_trade_price": "last_trade_price",
                              "tick_size_change": "book", "new_market": "book", "resolution": "book"}),
    ChannelSpec("ws_sports", {"events": "ws_sports/events"}, control=("ping", "pong")),
    ChannelSpec("ws_rtds", {"activity": "ws_rtds/activity", "crypto_prices": "ws_rtds/crypto_prices"}),
]}
DEFAULT_ROUTE = "book"
# fields that hold a time, by the form they are sent in
TIME_FIELDS = {
    "gamma/markets": {"startDate": "iso", "endDate": "iso", "createdAt": "iso", "updatedAt": "iso"},
    "gamma/events": {"startDate": "iso", "endDate": "iso"},
    "gamma/tags": {"publishedAt": "iso", "createdAt": "iso", "updatedAt": "iso"},
    "clob/books": {"timestamp": "millis"},
    "ws_market/book": {"timestamp": "millis"},
    "data_api/trades": {"timestamp": "seconds"},
}
# ---------------------------------------------------------------------------


def spec_for(stream: str, ddl: str | None = None) -> StreamSpec:
    """Registered spec, or an ad-hoc one for a stream declared by the caller."""
    if stream in SPECS and ddl is None:
        return SPECS[stream]
    return StreamSpec(stream, ddl or "", key=())
