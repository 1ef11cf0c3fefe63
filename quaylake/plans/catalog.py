"""Query catalogue on the driver tables, part 1: pure DataFrame queries.

Each entry: ``fn(spark, sf_dir) -> DataFrame`` plus an equivalent DuckDB SQL
string. The TPC-H-like tables stand in for the feeds: ``events`` for pushed
messages, ``orders``/``lineitem`` for trades and quotes, ``part`` for markets,
``customer`` for wallets. Message texts are built row by row from the tables
(never by collecting groups), so every query reads its whole input.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.functions import jsonfn as J
from quaylake.functions import labels as L
from quaylake.functions.predicates import is_open, truthy_json
from quaylake.operators import discovery as D
from quaylake.operators import market as M
from quaylake.operators import monitor as MON
from quaylake.operators.land import metadata_json, resolve_source
from quaylake.operators.route import decode_frames
from quaylake.session import apply_conf
from quaylake.sources import pages as PG

# Fixed clock for every time-dependent query on the test tables.
FIXED_NOW = dt.datetime(2024, 1, 30, 12, 30, tzinfo=dt.timezone.utc)
HOUR_NOW = "2024-01-30T12"

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_conf(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- labels
@query("hour_label_counts", """
SELECT strftime(ts, '%Y-%m-%dT%H') AS label, event_type, count(*)::BIGINT AS n
FROM events GROUP BY ALL""")
def hour_label_counts(spark, sf):
    ev = table(spark, sf, "events")
    return ev.groupBy(L.hour_label("ts").alias("label"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("label_parts", """
SELECT label, substr(label, 1, 10) AS dt,
       CASE WHEN contains(label, 'T') THEN substr(label, 12) ELSE '00' END AS hour
FROM (SELECT strftime(ts, '%Y-%m-%dT%H') AS label FROM events
      UNION SELECT strftime(ts, '%Y-%m-%d') FROM events)""")
def label_parts(spark, sf):
    ev = table(spark, sf, "events")
    labels = ev.select(L.hour_label("ts").alias("label")).union(ev.select(L.day_label("ts"))).distinct()
    return labels.select("label", L.label_dt("label").alias("dt"), L.label_hour("label").alias("hour"))


@query("boundaries", """
SELECT event_id, epoch_us(date_trunc('hour', ts)) AS hour_start_us,
       epoch_us(date_trunc('day', ts)) AS day_start_us,
       epoch_us(date_trunc('hour', ts) + INTERVAL 1 HOUR) AS next_hour_us,
       strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%dT%H') AS next_label
FROM events""")
def boundaries(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.unix_micros(L.hour_boundary("ts")).alias("hour_start_us"),
                     F.unix_micros(L.day_boundary("ts")).alias("day_start_us"),
                     F.unix_micros(L.next_hour("ts")).alias("next_hour_us"),
                     L.hour_label(L.next_hour("ts")).alias("next_label"))


# ---------------------------------------------------------------- metadata
@query("with_metadata", """
SELECT event_id, epoch_us(ts) / 1000000.0 AS _fetched_at,
       CASE WHEN event_type = 'signup' THEN 'own'
            WHEN event_type = 'error' THEN 'desk-7'
            ELSE 'feed/events' END AS _source
FROM events""")
def with_metadata_q(spark, sf):
    ev = table(spark, sf, "events")
    rec = F.when(F.col("event_type") == "signup",
                 F.format_string('{"event_id":%d,"_source":"own"}', "event_id")) \
        .otherwise(F.format_string('{"event_id":%d}', "event_id"))
    stream = "feed/events"
    source = (F.when(F.col("event_type") == "error", resolve_source("desk-7", stream))
              .when(F.col("event_type") == "click", resolve_source("", stream))
              .otherwise(resolve_source(None, stream)))
    line = metadata_json(rec, L.epoch_seconds("ts"), source)
    return ev.select(F.get_json_object(line, "$.event_id").cast("bigint").alias("event_id"),
                     F.get_json_object(line, "$._fetched_at").cast("double").alias("_fetched_at"),
                     F.get_json_object(line, "$._source").alias("_source"))


# ---------------------------------------------------------------- JSON decode
_BROKEN_PROPS = "CASE WHEN event_id % 17 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END"


@query("decode_props", f"""
SELECT event_id, json_valid(p) AS valid,
       CASE WHEN json_valid(p) THEN json_extract_string(p, '$.k')::BIGINT END AS k,
       CASE WHEN NOT json_valid(p) THEN substr(p, 1, 200) END AS preview
FROM (SELECT event_id, {_BROKEN_PROPS} AS p FROM events)""")
def decode_props(spark, sf):
    ev = table(spark, sf, "events")
    p = F.when(F.col("event_id") % 17 == 0, F.expr("substr(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    ok = J.strict_json(p)
    return ev.select("event_id", ok.alias("valid"),
                     F.when(ok, J.key_text(p, "k").cast("bigint")).alias("k"),
                     F.when(~ok, J.preview(p)).alias("preview"))


# frames with 9 shapes on the market channel
def q_frame_spark():
    return (F.when(F.col("event_id") % 9 == 0, F.lit("PONG"))
                  .when(F.col("event_id") % 9 == 1, F.lit(" PONG "))
                  .when(F.col("event_id") % 9 == 2, F.lit("pong"))
                  .when(F.col("event_id") % 9 == 3, F.concat(F.format_string('{"event_id":%d,"pad":"', "event_id"),
                                                             F.repeat(F.lit("ab"), F.lit(300))))
                  .when(F.col("event_id") % 9 == 4, F.format_string("{'event_id':%d}", "event_id"))
                  .when(F.col("event_id") % 9 == 5, F.format_string('{"event_id":%d} {"b":2}', "event_id"))
                  .when(F.col("event_id") % 9 == 6, F.format_string("%d", "event_id"))
                  .otherwise(F.format_string('{"event_id":%d,"kind":"%s"}', "event_id", "event_type")))


@query("quarantine_frames", """
SELECT event_id,
       CASE WHEN m IN (2, 3, 4, 5) THEN 'bad_json' WHEN m = 6 THEN 'not_object' END AS reason,
       CASE WHEN m IN (7, 8) THEN 'book' END AS route,
       CASE WHEN m IN (7, 8) THEN 'unknown' END AS event_type,
       CASE m WHEN 2 THEN 'pong' WHEN 3 THEN '{"event_id":' || event_id || ',"pad":"' || repeat('ab', 300)
              WHEN 4 THEN '{''event_id'':' || event_id || '}' WHEN 5 THEN '{"event_id":' || event_id || '} {"b":2}'
              WHEN 6 THEN CAST(event_id AS VARCHAR) END AS raw
FROM (SELECT event_id, event_id % 9 AS m FROM events) WHERE m NOT IN (0, 1)""")
def quarantine_frames(spark, sf):
    ev = table(spark, sf, "events")
    frames = ev.select("event_id", F.lit("ws_market").alias("channel"), q_frame_spark().alias("raw"),
                       L.epoch_seconds("ts").alias("_fetched_at"))
    return decode_frames(frames).select("event_id", "reason", "route", "event_type", "raw")


# ---------------------------------------------------------------- detect / route
def detect_frame_spark():
    return (
    F.when(F.col("event_id") % 8 == 0, F.format_string('{"event_type":"%s","user":%d}', "event_type", "user_id"))
    .when(F.col("event_id") % 8 == 1, F.format_string('{"market":"m%d","price_changes":[{"p":%d}]}', "user_id", "event_id"))
    .when(F.col("event_id") % 8 == 2, F.format_string('{"market":"m%d","last_trade_price":%d}', "user_id", "event_id"))
    .when(F.col("event_id") % 8 == 3, F.format_string('{"asset_id":"a%d","bids":[],"asks":[]}', "user_id"))
    .when(F.col("event_id") % 8 == 4, F.format_string('{"type":"%s"}', "event_type"))
    .when(F.col("event_id") % 8 == 5, F.format_string('{"something":%d}', "event_id"))
    .when(F.col("event_id") % 8 == 6, F.lit('{"event_type":null,"price_changes":[]}'))
    .otherwise(F.format_string('{"asks":[{"price":"0.5","size":"%d"}]}', "user_id")))

_DETECT_FRAME_SQL = """CASE event_id % 8
  WHEN 0 THEN '{"event_type":"' || event_type || '","user":' || user_id || '}'
  WHEN 1 THEN '{"market":"m' || user_id || '","price_changes":[{"p":' || event_id || '}]}'
  WHEN 2 THEN '{"market":"m' || user_id || '","last_trade_price":' || event_id || '}'
  WHEN 3 THEN '{"asset_id":"a' || user_id || '","bids":[],"asks":[]}'
  WHEN 4 THEN '{"type":"' || event_type || '"}'
  WHEN 5 THEN '{"something":' || event_id || '}'
  WHEN 6 THEN '{"event_type":null,"price_changes":[]}'
  ELSE '{"asks":[{"price":"0.5","size":"' || user_id || '"}]}' END"""

_DETECT_SQL = """CASE WHEN list_contains(json_keys(f), 'event_type') THEN json_extract_string(f, '$.event_type')
  WHEN list_contains(json_keys(f), 'price_changes') THEN 'price_change'
  WHEN list_contains(json_keys(f), 'last_trade_price') THEN 'last_trade_price'
  WHEN list_contains(json_keys(f), 'bids') OR list_contains(json_keys(f), 'asks') THEN 'book'
  WHEN list_contains(json_keys(f), 'type') THEN json_extract_string(f, '$.type')
  ELSE 'unknown' END"""

_ROUTE_SQL = """CASE WHEN t = 'price_change' THEN 'price_change'
  WHEN t = 'last_trade_price' THEN 'last_trade_price' ELSE 'book' END"""


@query("detect_route", f"""
SELECT event_id, t AS event_type, {_ROUTE_SQL} AS route, 'ws_market/' || {_ROUTE_SQL} AS stream
FROM (SELECT event_id, {_DETECT_SQL} AS t FROM (SELECT event_id, {_DETECT_FRAME_SQL} AS f FROM events))""")
def detect_route(spark, sf):
    ev = table(spark, sf, "events")
    frames = ev.select("event_id", F.lit("ws_market").alias("channel"), detect_frame_spark().alias("raw"),
                       L.epoch_seconds("ts").alias("_fetched_at"))
    return decode_frames(frames).select("event_id", "event_type", "route", "stream")


def rtds_frame_spark():
    return (
    F.when(F.col("event_type") == "purchase", F.format_string('{"channel":"crypto_prices","id":%d}', "event_id"))
    .when(F.col("event_type") == "click", F.format_string('{"channel":"activity","id":%d}', "event_id"))
    .when(F.col("event_type") == "error", F.format_string('{"channel":null,"id":%d}', "event_id"))
    .when(F.col("event_type") == "signup", F.format_string('{"channel":"CRYPTO_PRICES","id":%d}', "event_id"))
    .otherwise(F.format_string('{"id":%d}', "event_id")))


@query("route_channel", """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'crypto_prices' ELSE 'activity' END AS route,
       CASE WHEN event_type = 'purchase' THEN 'ws_rtds/crypto_prices' ELSE 'ws_rtds/activity' END AS stream
FROM events""")
def route_channel_q(spark, sf):
    ev = table(spark, sf, "events")
    frames = ev.select("event_id", F.lit("ws_rtds").alias("channel"), rtds_frame_spark().alias("raw"),
                       L.epoch_seconds("ts").alias("_fetched_at"))
    return decode_frames(frames).select("event_id", "route", "stream")


# ---------------------------------------------------------------- list frames (R2)
@query("list_frames", """
SELECT event_id, i AS elem_no, 'book' AS route,
       '{"asset_id":"a' || user_id || '","i":' || i || '}' AS elem
FROM events, range(event_id % 3) t(i)""")
def list_frames(spark, sf):
    ev = table(spark, sf, "events")
    elems = F.transform(F.sequence(F.lit(0), (F.col("event_id") % 3 - 1).cast("int")),
                        lambda i: F.format_string('{"asset_id":"a%d","i":%d}', F.col("user_id"), i))
    raw = F.concat(F.lit("["), F.array_join(elems, ","), F.lit("]"))
    raw = F.when(F.col("event_id") % 3 == 0, F.lit("[]")).otherwise(raw)
    frames = ev.select("event_id", F.lit("ws_market").alias("channel"), raw.alias("raw"),
                       L.epoch_seconds("ts").alias("_fetched_at"))
    return decode_frames(frames).select("event_id", "elem_no", "route", "elem")


# ---------------------------------------------------------------- pages
def item_spark():
    return F.format_string('{"c":%d,"k":%d}', "o_custkey", "o_orderkey")
_ITEM_SQL = """'{"c":' || o_custkey || ',"k":' || o_orderkey || '}'"""


def _page_bodies(orders: DataFrame, page_key, shape) -> DataFrame:
    """Pages of at most 100 orders each, bodies in several shapes. Order keys are
    unique, so a page key ``orderkey div 100`` holds at most 100 rows: the
    ``collect_list`` below is bounded by construction, not by the data."""
    grouped = (orders.groupBy(page_key.alias("page_no"))
               .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", item_spark().alias("item")))).alias("its")))
    arr = F.concat(F.lit("["), F.array_join(F.transform("its", lambda x: x["item"]), ","), F.lit("]"))
    return grouped.select("page_no", shape(arr).alias("body"))


@query("unwrap_pages", f"""
WITH o AS (SELECT o_orderkey // 100 AS page_no, o_orderkey, {_ITEM_SQL} AS item FROM orders),
ranked AS (SELECT *, row_number() OVER (PARTITION BY page_no ORDER BY o_orderkey) - 1 AS item_no FROM o)
SELECT page_no, item_no, item FROM ranked WHERE page_no % 6 IN (0, 1, 2, 3)
UNION ALL
SELECT DISTINCT page_no, 0 AS item_no, '{{"data":5,"page":' || page_no || '}}' AS item FROM o WHERE page_no % 6 = 4""")
def unwrap_pages_q(spark, sf):
    orders = table(spark, sf, "orders")
    pk = F.floor(F.col("o_orderkey") / 100).cast("bigint")

    def shape(arr):
        m = F.col("page_no") % 6
        return (F.when(m == 0, arr)
                .when(m == 1, F.concat(F.lit('{"data":'), arr, F.lit("}")))
                .when(m == 2, F.concat(F.lit('{"results":'), arr, F.lit(',"next":null}')))
                .when(m == 3, F.concat(F.lit('{"items":'), arr, F.lit("}")))
                .when(m == 4, F.format_string('{"data":5,"page":%d}', "page_no"))
                .otherwise(F.concat(F.lit('{"x":'), arr, F.lit("}"))))
    pages = _page_bodies(orders, pk, shape)
    return PG.unwrap_pages(pages, ["page_no"])


_CUT_LIMIT = 3


@query("cut_pages", f"""
WITH o AS (SELECT o_orderkey // 1000 AS crawl_id, (o_orderkey % 1000) // 10 AS page_no, o_orderkey,
                  {_ITEM_SQL} AS item FROM orders),
pg AS (SELECT crawl_id, page_no, count(*) AS n,
              (page_no = 23 AND crawl_id % 2 = 1) AS scalar FROM o GROUP BY ALL),
stops AS (SELECT crawl_id, min(CASE WHEN scalar OR n < {_CUT_LIMIT} THEN page_no END) AS stop FROM pg GROUP BY crawl_id)
SELECT o.crawl_id, o.page_no, coalesce(o.page_no > stop, false) AS after_end, stop IS NULL AS truncated,
       row_number() OVER (PARTITION BY o.crawl_id, o.page_no ORDER BY o.o_orderkey) - 1 AS item_no, o.item
FROM o JOIN pg USING (crawl_id, page_no) JOIN stops USING (crawl_id) WHERE NOT scalar""")
def cut_pages_q(spark, sf):
    # pages of at most 10 unique order keys each (bounded collect_list)
    orders = table(spark, sf, "orders")
    crawl = F.floor(F.col("o_orderkey") / 1000).cast("bigint")
    page = F.floor((F.col("o_orderkey") % 1000) / 10).cast("bigint")
    grouped = (orders.groupBy(crawl.alias("crawl_id"), page.alias("page_no"))
               .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", item_spark().alias("item")))).alias("its")))
    arr = F.concat(F.lit("["), F.array_join(F.transform("its", lambda x: x["item"]), ","), F.lit("]"))
    scalar = (F.col("page_no") == 23) & (F.col("crawl_id") % 2 == 1)
    pages = grouped.select("crawl_id", "page_no", F.when(scalar, F.lit('"oops"')).otherwise(arr).alias("body"))
    return PG.crawl_items(pages, limit=_CUT_LIMIT)


@query("rejected_pages", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 1 THEN 'no_envelope_key' WHEN 2 THEN 'not_a_page' ELSE 'bad_json' END AS reason,
       CASE o_orderkey % 4 WHEN 1 THEN '{"x":' || o_custkey || '}' WHEN 2 THEN CAST(o_custkey AS VARCHAR)
                           ELSE '[{"c":' || o_custkey || '}' END AS raw
FROM orders WHERE o_orderkey % 4 <> 0""")
def rejected_pages_q(spark, sf):
    o, m = table(spark, sf, "orders"), F.col("o_orderkey") % 4
    body = (F.when(m == 0, F.format_string('{"data":[%d]}', "o_custkey"))
            .when(m == 1, F.format_string('{"x":%d}', "o_custkey"))
            .when(m == 2, F.format_string("%d", "o_custkey"))
            .otherwise(F.format_string('[{"c":%d}', "o_custkey")))
    return PG.rejected_pages(o.select("o_orderkey", body.alias("body")), ["o_orderkey"])


# ---------------------------------------------------------------- markets
@query("open_only", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus IN ('O', 'P')""")
def open_only_q(spark, sf):
    o = table(spark, sf, "orders")
    # flags as feeds send them: a word for true, zero for false
    active = F.when(F.col("o_orderstatus") != "F", F.lit("abc")).otherwise(F.lit("0"))
    closed = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
    markets = o.select("o_orderkey", "o_custkey", active.alias("active"), closed.alias("closed"))
    return M.open_only(markets).select("o_orderkey", "o_custkey")


@query("truthy_flags", """
SELECT o_orderkey, o_orderkey % 7 IN (1, 3, 5) AS flag FROM orders""")
def truthy_flags(spark, sf):
    """JSON truthiness of a flag that is not always boolean."""
    o, m = table(spark, sf, "orders"), F.col("o_orderkey") % 7
    raw = (F.when(m == 0, F.lit("{}")).when(m == 1, F.lit('{"f":"false"}')).when(m == 2, F.lit('{"f":0.0}'))
           .when(m == 3, F.lit('{"f":[0]}')).when(m == 4, F.lit('{"f":{}}')).when(m == 5, F.lit('{"f":true}'))
           .otherwise(F.lit('{"f":null}')))
    return o.select("o_orderkey", truthy_json(F.variant_get(F.parse_json(raw), "$.f", "variant")).alias("flag"))


@query("all_markets", """
SELECT 'all' AS kind, o_orderkey FROM orders UNION ALL SELECT 'closed', o_orderkey FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'open', o_orderkey FROM orders WHERE o_orderstatus <> 'F'""")
def all_markets_q(spark, sf):
    o = table(spark, sf, "orders")
    closed = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
    m = o.select("o_orderkey", closed.alias("closed"))
    parts = [M.all_markets(m, want).select(F.lit(kind).alias("kind"), "o_orderkey")
             for kind, want in (("all", None), ("closed", True), ("open", False))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def ids_rec_spark():
    return (
    F.when(F.col("p_partkey") % 5 == 0,
           F.format_string('{"id":"%d","clobTokenIds":"[\\"%d\\",\\"%d\\"]"}', "p_partkey", "p_partkey", "p_size"))
    .when(F.col("p_partkey") % 5 == 1,
          F.format_string('{"id":"%d","clobTokenIds":[%d,"x%d"]}', "p_partkey", "p_partkey", "p_size"))
    .when(F.col("p_partkey") % 5 == 2, F.format_string('{"id":"%d","clobTokenIds":"bad"}', "p_partkey"))
    .when(F.col("p_partkey") % 5 == 3, F.format_string('{"id":"%d","clobTokenIds":"{\\"a\\":1}"}', "p_partkey"))
    .otherwise(F.format_string('{"id":"%d","clobTokenIds":null}', "p_partkey")))


@query("parse_ids", """
SELECT p_partkey, pos, token FROM (
  SELECT p_partkey, p_size, 0 AS pos, CAST(p_partkey AS VARCHAR) AS token FROM part WHERE p_partkey % 5 = 0
  UNION ALL SELECT p_partkey, p_size, 1, CAST(p_size AS VARCHAR) FROM part WHERE p_partkey % 5 = 0
  UNION ALL SELECT p_partkey, p_size, 0, CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 5 = 1
  UNION ALL SELECT p_partkey, p_size, 1, 'x' || p_size FROM part WHERE p_partkey % 5 = 1)
WHERE p_size < 40""")
def parse_ids(spark, sf):
    p = table(spark, sf, "part")
    rec = ids_rec_spark()
    tokens = J.id_list(F.variant_get(F.parse_json(rec), "$.clobTokenIds", "variant"))
    markets = p.select("p_partkey", (F.col("p_size") < 40).alias("active"), F.lit(None).cast("boolean").alias("closed"),
                       tokens.alias("tokens"))
    return M.open_only(markets).select("p_partkey", F.posexplode("tokens").alias("pos", "token"))


# ---------------------------------------------------------------- joins
@query("merge_quotes", """
SELECT p_partkey AS token_id, p_retailprice AS price, m.midpoint
FROM part LEFT JOIN (
  SELECT l_partkey, l_extendedprice / l_quantity AS midpoint FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1
) m ON m.l_partkey = p_partkey""")
def merge_quotes_q(spark, sf):
    prices = table(spark, sf, "part").select(F.col("p_partkey").alias("token_id"), F.col("p_retailprice").alias("price"))
    mids = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("token_id"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("mid"),
        "l_shipdate", "l_orderkey", "l_linenumber")
    return M.merge_quotes(prices, mids, seq=["l_shipdate", "l_orderkey", "l_linenumber"])


_SPLIT = "TIMESTAMP '1998-01-01 00:00:00'"


@query("new_ids", f"""
SELECT o_custkey AS id FROM orders WHERE o_orderdate >= {_SPLIT}
EXCEPT SELECT o_custkey FROM orders WHERE o_orderdate < {_SPLIT}""")
def new_ids_q(spark, sf):
    o = table(spark, sf, "orders")
    split = F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    cur = o.where(F.col("o_orderdate") >= split).select(F.col("o_custkey").alias("id"))
    known = o.where(F.col("o_orderdate") < split).select(F.col("o_custkey").alias("id"))
    return D.new_ids(cur, known, "id")


@query("id_union", f"""
SELECT 'customer' AS kind, CAST(o_custkey AS VARCHAR) AS id, min(epoch_us(o_orderdate)) / 1000000.0 AS first_seen
FROM orders GROUP BY o_custkey""")
def id_union_q(spark, sf):
    o = table(spark, sf, "orders").withColumn("_fetched_at", L.epoch_seconds("o_orderdate"))
    split = F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    known = D.as_id_table(o.where(F.col("o_orderdate") < split), "customer", "o_custkey")
    cur = D.as_id_table(o.where(F.col("o_orderdate") >= split), "customer", "o_custkey")
    return D.id_union(known, cur)


@query("unsubscribed", """
SELECT p_partkey AS token_id FROM part WHERE NOT EXISTS (
  SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_shipdate < TIMESTAMP '1996-01-01')""")
def unsubscribed_q(spark, sf):
    """Tokens not yet subscribed: all parts vs the parts already traded before the split."""
    tokens = table(spark, sf, "part").select(F.col("p_partkey").alias("token_id"))
    li = table(spark, sf, "lineitem")
    subscribed = li.where(F.col("l_shipdate") < F.lit(dt.datetime(1996, 1, 1)).cast("timestamp_ntz")) \
        .select(F.col("l_partkey").alias("token_id"))
    return D.unsubscribed(tokens, subscribed, "token_id")


@query("worklist_semi", """
WITH top AS (SELECT l_partkey FROM lineitem GROUP BY l_partkey
             ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,2))) DESC, l_partkey LIMIT 100)
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM top)""")
def worklist_semi(spark, sf):
    li = table(spark, sf, "lineitem")
    rev = li.groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("rev"))
    wl = D.worklist(rev, 100, [F.desc("rev"), F.asc("l_partkey")])
    return M.restrict_to_worklist(li, wl, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("two_key_join", """
SELECT o_orderkey, c_custkey AS r_c_custkey,
       CASE WHEN o_orderkey % 2 = 0 THEN 'c_custkey' ELSE 'alt_key' END AS matched_on
FROM orders JOIN customer ON c_custkey = o_custkey""")
def two_key_join_q(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    left = o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey"))
                    .otherwise(F.col("o_custkey") + 1_000_000).alias("key"))
    right = c.select("c_custkey", (F.col("c_custkey") + 1_000_000).alias("alt_key"))
    return M.two_key_join(left, right, "key", ["c_custkey", "alt_key"]).select(
        "o_orderkey", "r_c_custkey", "matched_on")


@query("trades_to_markets", """
SELECT l_orderkey, l_linenumber, p_name, s_name, n_name
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey""")
def trades_to_markets(spark, sf):
    li, p, s, n = (table(spark, sf, t) for t in ("lineitem", "part", "supplier", "nation"))
    sellers = M.to_markets(s, n, "s_nationkey", "n_nationkey")
    return (M.to_markets(M.to_markets(li, p, "l_partkey", "p_partkey"), sellers, "l_suppkey", "s_suppkey")
            .select("l_orderkey", "l_linenumber", "p_name", "s_name", "n_name"))


@query("books_to_markets", """
SELECT l_orderkey, l_linenumber, p_partkey, p_name, CASE WHEN l_linenumber % 2 = 0 THEN 'Yes' ELSE 'No' END AS outcome
FROM lineitem JOIN part ON p_partkey = l_partkey""")
def books_to_markets_q(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    asset = F.concat(F.col("l_partkey").cast("string"), F.when(F.col("l_linenumber") % 2 == 0, "y").otherwise("n"))
    books = li.select("l_orderkey", "l_linenumber", asset.alias("asset_id"))
    markets = p.select("p_partkey", "p_name", F.lit('["Yes","No"]').alias("outcomes"),
                       F.lit('["0.5","0.5"]').alias("outcomePrices"),
                       F.format_string('["%dy","%dn"]', "p_partkey", "p_partkey").alias("clobTokenIds"))
    return M.books_to_markets(books, markets, ["p_partkey", "p_name"]).drop("asset_id")


# ---------------------------------------------------------------- latest state
@query("latest_per_key", """
SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) AS o_orderdate_us, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_per_key_q(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    out = M.latest_per_key(o, ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
    return out.select("o_custkey", "o_orderkey", F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("o_orderdate_us"),
                      "o_totalprice")


@query("lookup_by_id", """
SELECT 'market' AS kind, o_custkey AS id, o_orderkey AS found FROM orders WHERE o_custkey = 7
QUALIFY row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
UNION ALL SELECT 'holder', n_nationkey, n_nationkey * 10 + i FROM nation, range(3) t(i) WHERE n_nationkey = 5""")
def lookup_by_id_q(spark, sf):
    """Latest snapshot of one market and the holders of one market."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    market = M.lookup_by_id(o, "o_custkey", 7, ["o_orderdate"], ["o_orderkey"])
    n = table(spark, sf, "nation")
    held = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct((F.col("n_nationkey") * 10 + i).alias("w")))
    holders = M.holders_of(n.select(F.col("n_nationkey").alias("condition_id"), held.alias("holders")), 5,
                           ["condition_id"])
    return market.select(F.lit("market").alias("kind"), F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("found")) \
        .unionByName(holders.select(F.lit("holder").alias("kind"), F.col("condition_id").cast("bigint").alias("id"),
                                    F.col("w").cast("bigint").alias("found")))


@query("dedup_trades", """
SELECT l_orderkey, l_linenumber, l_partkey, min(f) AS _fetched_at, count(*)::BIGINT AS copies FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, 1.0 AS f FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01'
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_partkey, 2.0 AS f FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01')
GROUP BY ALL""")
def dedup_trades_q(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = ["l_orderkey", "l_linenumber", "l_partkey"]
    a = li.where(F.col("l_shipdate") < F.lit(dt.datetime(1997, 1, 1)).cast("timestamp_ntz")) \
        .select(*cols, F.lit(1.0).alias("_fetched_at"))
    b = li.where(F.col("l_shipdate") >= F.lit(dt.datetime(1996, 1, 1)).cast("timestamp_ntz")) \
        .select(*cols, F.lit(2.0).alias("_fetched_at"))
    return M.dedup_trades(a.unionByName(b), cols)


# ---------------------------------------------------------------- books
def _books(li: DataFrame) -> DataFrame:
    def lvl(price, size):
        return F.struct(price.cast("decimal(10,2)").cast("string").alias("price"),
                        size.cast("decimal(10,2)").cast("string").alias("size"))
    bids = F.array(lvl(F.col("l_discount"), F.col("l_quantity")), lvl(F.col("l_tax"), F.col("l_linenumber")))
    asks = F.array(lvl(F.col("l_discount") + F.lit(0.5), F.col("l_quantity")),
                   lvl(F.col("l_tax") + F.lit(0.25), F.col("l_linenumber")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", bids.alias("bids"), asks.alias("asks"))


_BOOKS_SQL = """(SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
  [{'price': CAST(CAST(l_discount AS DECIMAL(10,2)) AS VARCHAR), 'size': CAST(CAST(l_quantity AS DECIMAL(10,2)) AS VARCHAR)},
   {'price': CAST(CAST(l_tax AS DECIMAL(10,2)) AS VARCHAR), 'size': CAST(CAST(l_linenumber AS DECIMAL(10,2)) AS VARCHAR)}] AS bids,
  [{'price': CAST(CAST(l_discount + 0.5 AS DECIMAL(10,2)) AS VARCHAR), 'size': CAST(CAST(l_quantity AS DECIMAL(10,2)) AS VARCHAR)},
   {'price': CAST(CAST(l_tax + 0.25 AS DECIMAL(10,2)) AS VARCHAR), 'size': CAST(CAST(l_linenumber AS DECIMAL(10,2)) AS VARCHAR)}] AS asks
  FROM lineitem)"""


@query("book_quote", f"""
SELECT l_orderkey, l_linenumber,
  CAST(list_max(list_transform(bids, lambda x: CAST(x.price AS DECIMAL(38,18)))) AS DOUBLE) AS best_bid,
  CAST(list_min(list_transform(asks, lambda x: CAST(x.price AS DECIMAL(38,18)))) AS DOUBLE) AS best_ask,
  CAST((list_max(list_transform(bids, lambda x: CAST(x.price AS DECIMAL(38,18))))
        + list_min(list_transform(asks, lambda x: CAST(x.price AS DECIMAL(38,18))))) / 2 AS DOUBLE) AS midpoint,
  CAST(list_min(list_transform(asks, lambda x: CAST(x.price AS DECIMAL(38,18))))
       - list_max(list_transform(bids, lambda x: CAST(x.price AS DECIMAL(38,18)))) AS DOUBLE) AS spread,
  CAST(list_sum(list_transform(bids, lambda x: CAST(x.price AS DECIMAL(20,8)) * CAST(x.size AS DECIMAL(20,8)))) AS DOUBLE) AS bid_depth,
  CAST(list_sum(list_transform(asks, lambda x: CAST(x.price AS DECIMAL(20,8)) * CAST(x.size AS DECIMAL(20,8)))) AS DOUBLE) AS ask_depth,
  CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END AS bad_levels
FROM {_BOOKS_SQL}""")
def book_quote_q(spark, sf):
    # every third book has a level without a price: it is skipped and counted
    junk = F.array(F.struct(F.lit("x").alias("price"), F.lit("1").alias("size")))
    books = _books(table(spark, sf, "lineitem")).withColumn(
        "bids", F.when(F.col("l_linenumber") % 3 == 0, F.concat("bids", junk)).otherwise(F.col("bids")))
    b = M.book_quote(books, keep=["l_orderkey", "l_linenumber"])
    return b.select("l_orderkey", "l_linenumber", *[F.col(c).cast("double").alias(c) for c in b.columns[2:-1]],
                    "bad_levels")


@query("token_quote", f"""
SELECT l_partkey AS asset_id,
  CAST((list_max(list_transform(bids, lambda x: CAST(x.price AS DECIMAL(38,18))))
        + list_min(list_transform(asks, lambda x: CAST(x.price AS DECIMAL(38,18))))) / 2 AS DOUBLE) AS midpoint
FROM {_BOOKS_SQL} WHERE l_partkey = 7
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1""")
def token_quote_q(spark, sf):
    books = _books(table(spark, sf, "lineitem")).withColumnRenamed("l_partkey", "asset_id")
    return M.token_quote(books, 7, "midpoint", ["l_shipdate"], ["l_orderkey", "l_linenumber"]) \
        .withColumn("midpoint", F.col("midpoint").cast("double"))


@query("token_fields", f"""
WITH last AS (SELECT * FROM {_BOOKS_SQL} WHERE l_partkey IN (SELECT min(l_partkey) FROM lineitem)
              QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1)
SELECT 'price' AS field, 0 AS rank, CAST(l_extendedprice AS VARCHAR) AS value
FROM (SELECT * FROM lineitem WHERE l_partkey IN (SELECT min(l_partkey) FROM lineitem)
      QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1)
UNION ALL SELECT 'bid', i - 1, bids[i].price || '@' || bids[i].size FROM last, range(1, 3) t(i)
UNION ALL SELECT 'ask', i - 1, asks[i].price || '@' || asks[i].size FROM last, range(1, 3) t(i)""")
def token_fields(spark, sf):
    """Price and book of one token, the smallest that was traded."""
    li = table(spark, sf, "lineitem")
    token = li.agg(F.min("l_partkey").alias("m")).first()["m"]
    order, tie = ["l_shipdate"], ["l_orderkey", "l_linenumber"]
    price = M.token_quote(li.withColumn("price", F.col("l_extendedprice").cast("string")), token, "price", order, tie,
                          key="l_partkey")
    book = M.token_quote(_books(li).withColumnRenamed("l_partkey", "asset_id"), token, "book", order, tie)
    levels = M.explode_book_levels(book, ["asset_id"])
    return (price.select(F.lit("price").alias("field"), F.lit(0).cast("bigint").alias("rank"), F.col("price").alias("value"))
            .unionByName(levels.select(F.col("side").alias("field"), F.col("rank").cast("bigint").alias("rank"),
                                       F.concat_ws("@", "price", "size").alias("value"))))


@query("book_levels", f"""
SELECT l_orderkey, l_linenumber, 'bid' AS side, i - 1 AS rank, bids[i].price AS price, bids[i].size AS size
FROM {_BOOKS_SQL}, range(1, 3) t(i)
UNION ALL
SELECT l_orderkey, l_linenumber, 'ask', i - 1, asks[i].price, asks[i].size FROM {_BOOKS_SQL}, range(1, 3) t(i)""")
def book_levels(spark, sf):
    return M.explode_book_levels(_books(table(spark, sf, "lineitem")), ["l_orderkey", "l_linenumber"])


@query("latest_book", f"""
SELECT l_partkey AS asset_id,
  CAST(list_max(list_transform(bids, lambda x: CAST(x.price AS DECIMAL(38,18)))) AS DOUBLE) AS best_bid,
  CAST(list_min(list_transform(asks, lambda x: CAST(x.price AS DECIMAL(38,18)))) AS DOUBLE) AS best_ask
FROM {_BOOKS_SQL}
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1""")
def latest_book(spark, sf):
    books = _books(table(spark, sf, "lineitem")).withColumnRenamed("l_partkey", "asset_id")
    last = M.latest_per_key(books, ["asset_id"], ["l_shipdate"], ["l_orderkey", "l_linenumber"])
    q = M.best_prices("bids", "asks")
    return last.select("asset_id", q["best_bid"].cast("double").alias("best_bid"),
                       q["best_ask"].cast("double").alias("best_ask"))


@query("price_changes", """
SELECT o_orderkey AS market, 0 AS change_no, CAST(o_custkey AS VARCHAR) AS asset_id,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price, 'BUY' AS side FROM orders
UNION ALL
SELECT o_orderkey, 1, CAST(o_custkey + 1 AS VARCHAR), o_orderpriority, 'SELL' FROM orders""")
def price_changes(spark, sf):
    o = table(spark, sf, "orders")
    changes = F.array(
        F.struct(F.col("o_custkey").cast("string").alias("asset_id"),
                 F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"), F.lit("BUY").alias("side")),
        F.struct((F.col("o_custkey") + 1).cast("string").alias("asset_id"), F.col("o_orderpriority").alias("price"),
                 F.lit("SELL").alias("side")))
    msgs = o.select(F.col("o_orderkey").alias("market"), changes.alias("price_changes"))
    return M.explode_price_changes(msgs, ["market"])


# ---------------------------------------------------------------- zips, csv, holders
@query("explode_zip", """
SELECT p_partkey, i AS outcome_no, ['Yes', 'No'][i + 1] AS outcome,
       CASE WHEN i = 0 THEN CAST(CAST(p_size / 100 AS DECIMAL(10,2)) AS VARCHAR)
            ELSE CAST(CAST(1 - p_size / 100 AS DECIMAL(10,2)) AS VARCHAR) END AS price,
       p_partkey || CASE WHEN i = 0 THEN 'y' ELSE 'n' END AS token_id
FROM part, range(2) t(i)""")
def explode_zip(spark, sf):
    p = table(spark, sf, "part")
    outcomes = F.lit('["Yes","No"]')
    prices = F.format_string('["%s","%s"]', (F.col("p_size") / 100).cast("decimal(10,2)").cast("string"),
                             (1 - F.col("p_size") / 100).cast("decimal(10,2)").cast("string"))
    tokens = F.format_string('["%dy","%dn"]', "p_partkey", "p_partkey")
    markets = p.select("p_partkey", outcomes.alias("outcomes"), prices.alias("outcomePrices"),
                       tokens.alias("clobTokenIds"))
    return M.explode_outcomes(markets, ["p_partkey"])


@query("csv_ids", """
SELECT c_custkey, CAST(n_nationkey AS INTEGER) AS tag_id, n_name FROM customer
JOIN nation ON n_nationkey IN (c_nationkey, (c_nationkey + 1) % 25)""")
def csv_ids(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    sports = c.select("c_custkey", F.format_string("%d, %d,", "c_nationkey", (F.col("c_nationkey") + 1) % 25).alias("tags"))
    return M.sports_to_tags(sports, n, ["c_custkey"], tag_key="n_nationkey") \
        .select("c_custkey", F.col("tag_id").cast("int").alias("tag_id"), "n_name")


@query("top_holders", """
SELECT c_nationkey, c_custkey, c_acctbal,
       row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank
FROM customer QUALIFY rank <= 20""")
def top_holders(spark, sf):
    c = table(spark, sf, "customer")
    out = M.top_n_per_group(c, ["c_nationkey"], [F.desc("c_acctbal"), F.asc("c_custkey")], 20)
    return out.select("c_nationkey", "c_custkey", "c_acctbal", F.col("rank").cast("bigint").alias("rank"))


@query("explode_holders", """
SELECT n_nationkey AS token, i AS holder_no, 'w' || (n_nationkey * 10 + i) AS proxyWallet,
       CAST(n_nationkey * 10 + i AS DOUBLE) AS amount
FROM nation, range(n_regionkey) t(i)
UNION ALL SELECT n_nationkey, NULL, NULL, NULL FROM nation WHERE n_regionkey = 0""")
def explode_holders_q(spark, sf):
    n = table(spark, sf, "nation")
    holders = F.transform(F.sequence(F.lit(0), F.col("n_regionkey") - 1),
                          lambda i: F.struct(F.format_string("w%d", F.col("n_nationkey") * 10 + i).alias("proxyWallet"),
                                             (F.col("n_nationkey") * 10 + i).cast("double").alias("amount")))
    holders = F.when(F.col("n_regionkey") > 0, holders)
    recs = n.select(F.col("n_nationkey").alias("token"), holders.alias("holders"))
    return M.explode_holders(recs, ["token"]).select(
        "token", F.col("holder_no").cast("bigint").alias("holder_no"), "proxyWallet", "amount")


@query("recent_trades", """
SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'
ORDER BY o_orderdate DESC, o_orderkey LIMIT 100 OFFSET 10""")
def recent_trades_q(spark, sf):
    o = table(spark, sf, "orders")
    return M.recent_trades(o, market="O", market_col="o_orderstatus",
                           order=[F.desc("o_orderdate"), F.asc("o_orderkey")], limit=100, offset=10) \
        .select("o_orderkey")


@query("sample_rows", """
(SELECT 'head' AS kind, o_orderkey AS k FROM orders ORDER BY o_orderkey LIMIT 3)
UNION ALL (SELECT 'tail', o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5)
UNION ALL (SELECT 'worklist', c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 50)""")
def sample_rows(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    head = M.head_rows(o, 3, [F.asc("o_orderkey")]).select(F.lit("head").alias("kind"), F.col("o_orderkey").alias("k"))
    tail = M.head_rows(o, 5, [F.desc("o_orderdate"), F.desc("o_orderkey")]).select(
        F.lit("tail").alias("kind"), F.col("o_orderkey").alias("k"))
    wl = D.worklist(c, 50, [F.desc("c_acctbal"), F.asc("c_custkey")]).select(
        F.lit("worklist").alias("kind"), F.col("c_custkey").alias("k"))
    return head.unionByName(tail).unionByName(wl)


# ---------------------------------------------------------------- monitoring
@query("last_fetch", """
SELECT event_type AS _source, max(epoch_us(ts)) / 1000000.0 AS last_fetch FROM events GROUP BY event_type""")
def last_fetch_q(spark, sf):
    ev = table(spark, sf, "events").select(F.col("event_type").alias("_source"),
                                           L.epoch_seconds("ts").alias("_fetched_at"))
    return MON.last_fetch(ev)


_INTERVALS = [("signup", 600.0), ("purchase", 3600.0), ("error", 30.0), ("click", 7200.0), ("view", 86400.0)]


@query("staleness", f"""
WITH lf AS (SELECT event_type AS _source, max(epoch_us(ts)) / 1000000.0 AS last_fetch FROM events GROUP BY 1),
iv(_source, max_interval) AS (VALUES {", ".join(f"('{k}', {v})" for k, v in _INTERVALS)})
SELECT lf._source, last_fetch, max_interval, {FIXED_NOW.timestamp()} - last_fetch AS age,
       ({FIXED_NOW.timestamp()} - last_fetch) > max_interval AS stale
FROM lf LEFT JOIN iv USING (_source)""")
def staleness_q(spark, sf):
    ev = table(spark, sf, "events").select(F.col("event_type").alias("_source"),
                                           L.epoch_seconds("ts").alias("_fetched_at"))
    intervals = spark.createDataFrame(_INTERVALS, "_source STRING, max_interval DOUBLE")
    return MON.staleness(MON.last_fetch(ev), intervals, FIXED_NOW.timestamp()).select(
        "_source", "last_fetch", "max_interval", "age", "stale")


@query("health", """
SELECT kind, count(*)::BIGINT AS n FROM (
  SELECT DISTINCT 'market' AS kind, CAST(p_partkey AS VARCHAR) AS id FROM part
  UNION ALL SELECT DISTINCT 'token', CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) FROM lineitem
  UNION ALL SELECT DISTINCT 'event', CAST(o_orderkey AS VARCHAR) FROM orders) GROUP BY kind""")
def health_q(spark, sf):
    p, li, o = (table(spark, sf, t) for t in ("part", "lineitem", "orders"))
    ids = D.id_union(
        D.as_id_table(p.withColumn("_fetched_at", F.lit(0.0)), "market", "p_partkey"),
        D.as_id_table(li.withColumn("tok", F.concat_ws("-", "l_partkey", "l_suppkey"))
                      .withColumn("_fetched_at", F.lit(0.0)), "token", "tok"),
        D.as_id_table(o.withColumn("_fetched_at", F.lit(0.0)), "event", "o_orderkey"))
    return MON.health(ids)


@query("health_flags", """
WITH e AS (SELECT event_id, user_id, ts, event_type IN ('error', 'click') AS failed FROM events),
g AS (SELECT *, sum((NOT failed)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM e),
k AS (SELECT *, sum(failed::INT) OVER (PARTITION BY user_id, grp ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS streak FROM g)
SELECT user_id, streak::BIGINT AS streak, streak >= 2 AS fallback FROM k
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def health_flags(spark, sf):
    """Current failure streak and fallback flag per connection."""
    ev = table(spark, sf, "events")
    streaks = MON.failure_streak(ev, "user_id", ["ts", "event_id"], F.col("event_type").isin("error", "click"), threshold=2)
    return MON.fallback_flags(streaks, "user_id", ["ts", "event_id"])


@query("next_interval", """
WITH e AS (SELECT event_id, user_id, ts, event_type = 'purchase' AS changed FROM events),
g AS (SELECT *, sum(changed::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM e),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id, grp ORDER BY ts, event_id)
                - CASE WHEN grp > 0 THEN 1 ELSE 0 END AS k FROM g)
SELECT event_id, user_id, k::BIGINT AS unchanged_run, least(60.0 * pow(2.0, k), 300.0) AS next_interval FROM k""")
def next_interval_q(spark, sf):
    ev = table(spark, sf, "events")
    out = MON.next_interval(ev, "user_id", ["ts", "event_id"], F.col("event_type") == "purchase", 60, 300)
    return out.select("event_id", "user_id", "unchanged_run", "next_interval")


@query("cadence_report", """
WITH e AS (SELECT event_id, user_id, ts, event_type = 'purchase' AS changed FROM events),
g AS (SELECT *, sum(changed::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM e),
k AS (SELECT *, sum((NOT changed)::INT) OVER (PARTITION BY user_id, grp ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS quiet FROM g)
SELECT user_id, count(*)::BIGINT AS polls, count(*) FILTER (WHERE changed)::BIGINT AS changes,
       max(quiet)::BIGINT AS longest_quiet,
       CASE WHEN count(*) > 1 THEN (max(epoch_us(ts)) - min(epoch_us(ts))) / 1000000 / (count(*) - 1) END AS mean_wait
FROM k GROUP BY user_id""")
def cadence_report_q(spark, sf):
    ev = table(spark, sf, "events")
    return MON.cadence_report(ev, "user_id", ["ts", "event_id"], "ts", F.col("event_type") == "purchase")


@query("failure_streak", """
WITH e AS (SELECT event_id, user_id, ts, event_type = 'error' AS failed FROM events),
g AS (SELECT *, sum((NOT failed)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM e)
SELECT event_id, user_id,
       sum(failed::INT) OVER (PARTITION BY user_id, grp ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS streak,
       sum(failed::INT) OVER (PARTITION BY user_id, grp ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) >= 2 AS fallback
FROM g""")
def failure_streak_q(spark, sf):
    ev = table(spark, sf, "events")
    out = MON.failure_streak(ev, "user_id", ["ts", "event_id"], F.col("event_type") == "error", threshold=2)
    return out.select("event_id", "user_id", "streak", "fallback")


_LIMITS = [("signup", 0.1), ("purchase", 0.2), ("error", 0.1), ("click", 0.3), ("view", 0.3)]


@query("rate_audit", f"""
WITH w AS (SELECT event_type, epoch_us(ts) // 1000000 AS sec,
                  count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts)
                                 RANGE BETWEEN 9999999 PRECEDING AND CURRENT ROW) AS k FROM events),
s AS (SELECT event_type, CAST(sec AS BIGINT) AS sec, count(*)::BIGINT AS n, max(k)::BIGINT AS n_window FROM w GROUP BY ALL),
lim(event_type, rps) AS (VALUES {", ".join(f"('{k}', {v})" for k, v in _LIMITS)})
SELECT s.event_type, sec, n, n_window, rps, n_window > rps * 10 AS over FROM s LEFT JOIN lim USING (event_type)""")
def rate_audit_q(spark, sf):
    ev = table(spark, sf, "events")
    limits = spark.createDataFrame(_LIMITS, "event_type STRING, rps DOUBLE")
    out = MON.rate_audit(ev, "event_type", "ts", limits, window_s=10)
    return out.select("event_type", "sec", "n", F.col("n_window").cast("bigint").alias("n_window"), "rps", "over")


@query("chunk_ids", """
SELECT o_custkey, idx, idx // 200 AS chunk_no, idx // 200 = 0 AS initial FROM (
  SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 1 AS idx FROM (SELECT DISTINCT o_custkey FROM orders))""")
def chunk_ids_q(spark, sf):
    o = table(spark, sf, "orders")
    return D.chunk_ids(o, "o_custkey", 200)


@query("closed_counts", """
SELECT count(*)::BIGINT AS markets,
       count(*) FILTER (WHERE o_orderpriority <> '5-LOW')::BIGINT AS with_id,
       count(*) FILTER (WHERE o_orderstatus = 'F')::BIGINT AS closed,
       count(*) FILTER (WHERE o_orderstatus <> 'F')::BIGINT AS open
FROM orders""")
def closed_counts(spark, sf):
    o = table(spark, sf, "orders")
    ids = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.col("o_orderkey").cast("string"))
    closed = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
    m = o.select(ids.alias("id"), (F.col("o_orderstatus") != "F").alias("active"), closed.alias("closed"))
    from quaylake.functions.predicates import has_id, truthy
    return m.agg(F.count(F.lit(1)).alias("markets"), F.count_if(has_id("id")).alias("with_id"),
                 F.count_if(truthy("closed")).alias("closed"), F.count_if(is_open("active", "closed")).alias("open"))


@query("discovery_summary", f"""
WITH cur AS (SELECT * FROM orders WHERE o_orderdate >= {_SPLIT}),
old AS (SELECT * FROM orders WHERE o_orderdate < {_SPLIT})
SELECT (SELECT count(*) FROM cur)::BIGINT AS markets,
       (SELECT count(DISTINCT o_custkey) FROM cur)::BIGINT AS events,
       (SELECT count(*) FROM (SELECT o_orderkey FROM cur EXCEPT SELECT o_orderkey FROM old))::BIGINT AS new_markets,
       (SELECT count(*) FROM (SELECT o_custkey FROM cur EXCEPT SELECT o_custkey FROM old))::BIGINT AS new_events,
       (SELECT count(*) FROM (SELECT o_custkey, o_orderpriority FROM cur EXCEPT
                              SELECT o_custkey, o_orderpriority FROM old))::BIGINT AS new_tokens,
       (SELECT count(DISTINCT o_custkey || '-' || o_orderpriority) FROM orders)::BIGINT AS total_tokens,
       (SELECT count(*) FROM (SELECT o_orderkey FROM cur EXCEPT SELECT o_orderkey FROM old)) > 0
         OR (SELECT count(*) FROM (SELECT o_custkey, o_orderpriority FROM cur EXCEPT
                                   SELECT o_custkey, o_orderpriority FROM old)) > 0 AS markets_changed,
       (SELECT count(*) FROM (SELECT o_custkey FROM cur EXCEPT SELECT o_custkey FROM old)) > 0 AS events_changed,
       true AS changed""")
def discovery_summary_q(spark, sf):
    o = table(spark, sf, "orders")
    split = F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    cur, old = o.where(F.col("o_orderdate") >= split), o.where(F.col("o_orderdate") < split)
    token = F.concat_ws("-", "o_custkey", "o_orderpriority").alias("token")
    return D.discovery_summary(
        cur, cur.select("o_custkey").distinct(),
        D.new_ids(cur, old, "o_orderkey"), D.new_ids(cur, old, "o_custkey"),
        D.new_ids(cur.select(token), old.select(token), "token"), o.select(token).distinct())
