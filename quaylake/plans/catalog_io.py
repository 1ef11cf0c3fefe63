"""Query catalogue part 2: queries that land, compact, stream and read back.

Intermediate files go to a fresh folder under the cluster's shared
``spark.checkpoint.dir`` (never a machine-local temp folder). The landed and
compacted ``events`` table is built once per Spark application and input
folder and shared by the read-only queries; queries that mutate (reruns, late
files, retention, streams) build their own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quaylake.functions import jsonfn as J
from quaylake.functions import labels as L
from quaylake.functions import casts as C
from quaylake.functions.predicates import fetched_after
from quaylake.operators import compact as CP
from quaylake.operators import discovery as D
from quaylake.operators import market as M
from quaylake.operators import state as ST
from quaylake.operators.land import json_lines, land_jsonl, land_lines, metadata_json, wrap_non_object
from quaylake.plans.catalog import FIXED_NOW, HOUR_NOW, table
from quaylake.session import scratch_dir
from quaylake.sources import inventory as inv
from quaylake.sources import pages as PG
from quaylake.sources.tables import scan_dt, scan_hour_files, scan_jsonl, scan_table
from quaylake.streaming import jobs as S

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

EVENTS_STREAM = "feed/events"
EVENTS_DDL = "event_id BIGINT, ts_us BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
_CLOSED = f"strftime(ts, '%Y-%m-%dT%H') < '{HOUR_NOW}'"
_SHARED: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def event_records(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "user_id",
                     "event_type", "value", "props", L.epoch_seconds("ts").alias("_fetched_at"))


def _land_events(spark, sf, raw, where=None):
    recs = event_records(spark, sf)
    if where is not None:
        recs = recs.where(where)
    land_jsonl(recs, raw, EVENTS_STREAM)


def shared_lake(spark, sf):
    """Land all events hourly, add a broken copy of every 'error' event, an
    empty file and a stray stem; list; compact. Kept per application and input folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key in _SHARED:
        return _SHARED[key]
    root = scratch_dir(spark, "lake")
    raw = f"{root}/raw"
    recs = event_records(spark, sf)
    broken = (recs.where(F.col("event_type") == "error")
              .select(L.hour_label(L.from_epoch_seconds("_fetched_at")).alias("label"),
                      F.format_string('{"event_id":%d,"ts_us":', "event_id").alias("value")))
    land_lines(json_lines(recs, EVENTS_STREAM).unionByName(broken), raw, EVENTS_STREAM)
    # a collector's own file, logged as it is landed
    empty = f"{raw}/{EVENTS_STREAM}/label=2024-01-02T03/empty.json"
    inv.write_text_file(spark, empty, "")
    inv.log_files(spark.range(1).select(F.lit(empty).alias("path"), F.lit(0).alias("size"), F.lit(0).alias("mtime_ms")),
                  raw, "collector-1")
    inv.write_text_file(spark, f"{raw}/{EVENTS_STREAM}/old.jsonl", '{"event_id":-1}\n')
    CP.classify(inv.raw_inventory(spark, raw), FIXED_NOW).write.parquet(f"{root}/inventory")
    report = CP.compact(spark, raw, f"{root}/table", now=FIXED_NOW, ddl={EVENTS_STREAM: EVENTS_DDL})
    _SHARED[key] = (root, report)
    return _SHARED[key]


def flagship(spark, sf):
    root, _ = shared_lake(spark, sf)
    t = scan_table(spark, f"{root}/table", EVENTS_STREAM)
    return t.groupBy(F.lit(EVENTS_STREAM).alias("stream"), "dt", "hour", "event_type") \
        .agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- compaction
@query("compact_roundtrip", f"""
SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props,
       epoch_us(ts) / 1000000.0 AS _fetched_at, 'feed/events' AS _source,
       strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hour
FROM events WHERE {_CLOSED}""")
def compact_roundtrip(spark, sf):
    """Everything landed comes back, from at most one file per stream-hour and writer."""
    root, _ = shared_lake(spark, sf)
    t = scan_table(spark, f"{root}/table", EVENTS_STREAM, keep_src=True)
    raw_files = CP.run_files(spark, f"{root}/table").where(F.col("status") == "compacted").count()
    table_files = inv.file_listing(spark, f"{root}/table/{EVENTS_STREAM}").where(F.col("path").endswith(".parquet")).count()
    hours = t.select("dt", "hour").distinct().count()
    assert table_files < raw_files or table_files == hours, f"{raw_files} raw files became {table_files}"
    return t.drop("_extra", "_cast_errors", "src", "run")


@query("stream_volume", f"""
SELECT 'feed/events' AS stream, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hour, count(*)::BIGINT AS n
FROM events WHERE {_CLOSED} GROUP BY ALL""")
def stream_volume_q(spark, sf):
    from quaylake.operators.monitor import stream_volume
    root, _ = shared_lake(spark, sf)
    return stream_volume(scan_table(spark, f"{root}/table", EVENTS_STREAM).withColumn("stream", F.lit(EVENTS_STREAM)))


@query("compaction_report", f"""
SELECT strftime(ts, '%Y-%m-%dT%H') AS label, count(*)::BIGINT AS rows,
       count(*) FILTER (WHERE event_type = 'error')::BIGINT AS corrupt
FROM events WHERE {_CLOSED} GROUP BY 1""")
def compaction_report(spark, sf):
    _, report = shared_lake(spark, sf)
    return (report.where(F.col("status") == "compacted").groupBy("label")
            .agg(F.sum("rows").cast("bigint").alias("rows"), F.sum("corrupt").cast("bigint").alias("corrupt")))


@query("inventory_eligible", f"""
SELECT DISTINCT strftime(ts, '%Y-%m-%dT%H') AS label,
       CASE WHEN strftime(ts, '%Y-%m-%dT%H') = '{HOUR_NOW}' THEN 'current'
            WHEN strftime(ts, '%Y-%m-%dT%H') > '{HOUR_NOW}' THEN 'future' ELSE 'eligible' END AS status
FROM events
UNION ALL SELECT '2024-01-02T03', 'empty'
UNION ALL SELECT 'old', 'bad_label'""")
def inventory_eligible(spark, sf):
    root, _ = shared_lake(spark, sf)
    return spark.read.parquet(f"{root}/inventory").select("label", "status").distinct()


@query("fetched_after", f"""
SELECT event_id, event_type FROM events
WHERE {_CLOSED} AND epoch_us(ts) / 1000000.0 > {dt.datetime(2024, 1, 20, 6, tzinfo=dt.timezone.utc).timestamp()}""")
def fetched_after_q(spark, sf):
    root, _ = shared_lake(spark, sf)
    t = scan_table(spark, f"{root}/table", EVENTS_STREAM)
    cut = dt.datetime(2024, 1, 20, 6, tzinfo=dt.timezone.utc).timestamp()
    return t.where(fetched_after("_fetched_at", cut)).select("event_id", "event_type")


@query("scan_dt", f"""
SELECT event_id, strftime(ts, '%H') AS hour FROM events
WHERE {_CLOSED} AND strftime(ts, '%Y-%m-%d') = '2024-01-15'""")
def scan_dt_q(spark, sf):
    root, _ = shared_lake(spark, sf)
    return scan_dt(spark, f"{root}/table", EVENTS_STREAM, "2024-01-15").select("event_id", "hour")


@query("snapshot_count", f"""
SELECT count(*)::BIGINT AS rows, 12 AS n_columns FROM events WHERE {_CLOSED}""")
def snapshot_count_q(spark, sf):
    from quaylake.operators.monitor import snapshot_count
    root, _ = shared_lake(spark, sf)
    return snapshot_count(scan_table(spark, f"{root}/table", EVENTS_STREAM)) \
        .withColumn("n_columns", F.col("n_columns").cast("int"))


@query("unique_ids", f"""
SELECT user_id, event_id, epoch_us(ts) / 1000000.0 AS _fetched_at, count(*) OVER (PARTITION BY user_id)::BIGINT AS n
FROM events WHERE {_CLOSED}
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def unique_ids(spark, sf):
    """``unique("id")`` on a snapshot scan, deterministic form: latest row per id."""
    root, _ = shared_lake(spark, sf)
    t = scan_table(spark, f"{root}/table", EVENTS_STREAM)
    counts = t.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    last = M.latest_per_key(t.select("user_id", "_fetched_at", "event_id"), ["user_id"], ["_fetched_at"], ["event_id"])
    return last.join(counts, "user_id").select("user_id", "event_id", "_fetched_at", "n")


@query("compact_rerun", f"""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hour FROM events WHERE {_CLOSED}""")
def compact_rerun(spark, sf):
    """Compact, rerun (no-op), land late files into already compacted hours, compact again."""
    root = scratch_dir(spark, "rerun")
    raw, tbl = f"{root}/raw", f"{root}/table"
    ddl = {EVENTS_STREAM: EVENTS_DDL}
    _land_events(spark, sf, raw, F.col("event_type") != "error")
    CP.compact(spark, raw, tbl, now=FIXED_NOW, ddl=ddl)
    again = CP.compact(spark, raw, tbl, now=FIXED_NOW, ddl=ddl)
    assert again.where(F.col("status") == "compacted").count() == 0, "rerun compacted again"
    _land_events(spark, sf, raw, F.col("event_type") == "error")
    CP.compact(spark, raw, tbl, now=FIXED_NOW, ddl=ddl)
    return scan_table(spark, tbl, EVENTS_STREAM).select("event_id", "dt", "hour")


@query("retention", f"""
SELECT event_id, 'table' AS place FROM events WHERE {_CLOSED} AND strftime(ts, '%Y-%m-%d') >= '2024-01-10'
UNION ALL SELECT event_id, 'raw' FROM events WHERE NOT ({_CLOSED})""")
def retention(spark, sf):
    """Compact without deleting, then let the raw and the table retention delete: raw files that were
    compacted go when they are older than the retention, the open hours' files stay."""
    root = scratch_dir(spark, "retention")
    raw, tbl = f"{root}/raw", f"{root}/table"
    _land_events(spark, sf, raw)
    CP.compact(spark, raw, tbl, now=FIXED_NOW, ddl={EVENTS_STREAM: EVENTS_DDL}, delete_sources=False)
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=72)
    assert CP.purge_raw(spark, raw, tbl, now=later, keep_hours=48) > 0, "no raw file was deleted"
    CP.purge_table(spark, tbl, EVENTS_STREAM, now=FIXED_NOW, keep_days=20)
    kept = scan_table(spark, tbl, EVENTS_STREAM).select("event_id", F.lit("table").alias("place"))
    rest = spark.createDataFrame([], "event_id BIGINT")
    if inv.has_data(spark, raw):
        rest = scan_jsonl(spark, f"{raw}/{EVENTS_STREAM}", StructType.fromDDL("event_id BIGINT"))
    return kept.unionByName(rest.select("event_id", F.lit("raw").alias("place")))


@query("type_drift", """
SELECT event_id, event_id AS v_number, NULL AS v_text FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, NULL, 'x' || event_id FROM events WHERE event_type = 'error'""")
def type_drift(spark, sf):
    """Two runs over an undeclared stream whose key changes its type, under a root with a blank and
    another name than ``raw``."""
    root = scratch_dir(spark, "drift")
    raw, tbl = f"{root}/landing zone", f"{root}/table"
    ev = table(spark, sf, "events")
    for where, value in ((F.col("event_type") != "error", F.col("event_id")),
                         (F.col("event_type") == "error", F.concat(F.lit("x"), F.col("event_id").cast("string")))):
        lines = ev.where(where).select(F.lit("2024-01-02T03").alias("label"), F.to_json(F.struct(
            "event_id", value.alias("v"))).alias("value"))
        land_lines(lines, raw, "feed/loose")
        CP.compact(spark, raw, tbl, now=FIXED_NOW)
    t = scan_table(spark, tbl, "feed/loose")
    v = F.col("_extra")["v"]
    number = F.schema_of_variant(v) != "STRING"
    return t.select(F.variant_get(F.col("_extra")["event_id"], "$", "bigint").alias("event_id"),
                    F.when(number, F.try_variant_get(v, "$", "bigint")).alias("v_number"),
                    F.when(~number, F.try_variant_get(v, "$", "string")).alias("v_text"))


@query("scan_hour_files", f"""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hour FROM events WHERE {_CLOSED}""")
def scan_hour_files_q(spark, sf):
    """Rewrite the compacted table in the original ``dt=/hour=HH.parquet`` file layout, read it back."""
    root, _ = shared_lake(spark, sf)
    t = scan_table(spark, f"{root}/table", EVENTS_STREAM).drop("_extra", "_cast_errors")
    out = scratch_dir(spark, "hourfiles")
    (t.repartition("dt", "hour").withColumn("hour", F.concat("hour", F.lit(".parquet")))
     .write.partitionBy("dt", "hour").parquet(f"{out}/{EVENTS_STREAM}"))
    return scan_hour_files(spark, out, EVENTS_STREAM, EVENTS_DDL).select("event_id", "dt", "hour")


@query("merge_runs", f"""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hour FROM events WHERE {_CLOSED}""")
def merge_runs(spark, sf):
    """Three runs into the same hours, merged: readers see every row once before, between and after (K4)."""
    root = scratch_dir(spark, "merge")
    raw, tbl = f"{root}/raw", f"{root}/table"
    ddl = {EVENTS_STREAM: EVENTS_DDL}
    for third in range(3):
        _land_events(spark, sf, raw, F.col("event_id") % 3 == third)
        CP.compact(spark, raw, tbl, now=FIXED_NOW, ddl=ddl)
    before = scan_table(spark, tbl, EVENTS_STREAM).count()
    old = CP.partition_sizes(spark, tbl, EVENTS_STREAM)
    hours, folders = old.select("dt", "hour").distinct().count(), old.count()
    replaced = CP.merge_hours(spark, tbl, EVENTS_STREAM)
    # committed, and what it replaced still lies there
    assert scan_table(spark, tbl, EVENTS_STREAM).count() == before, "a reader in between does not see every row once"
    gone = CP.vacuum(spark, tbl)
    left = CP.partition_sizes(spark, tbl, EVENTS_STREAM).agg(F.count("*").alias("n"), F.sum("files").alias("files")).first()
    assert gone == replaced.count() and left["n"] == left["files"] == hours <= folders, "an hour has more than one file"
    return scan_table(spark, tbl, EVENTS_STREAM).select("event_id", "dt", "hour")


@query("landed_batches", """
SELECT event_id, count(*)::BIGINT AS n, strftime(ts, '%Y-%m-%dT%H') AS label FROM events GROUP BY event_id, ts""")
def landed_batches(spark, sf):
    """Every event in one of two batches, each sent twice, the second once more after a cut-off attempt (K2)."""
    root = scratch_dir(spark, "batches")
    recs = event_records(spark, sf)
    for name in ("b0", "b0", "b1", "b1"):
        land_jsonl(recs.where(F.col("event_id") % 2 == int(name[1])), root, EVENTS_STREAM, batch=name)
    # as if b1 had stopped before it was marked as done
    inv.delete_paths(spark, [f"{root}/{inv.LANDED_DIR}/done/{EVENTS_STREAM.replace('/', '%2F')}/b1"])
    land_jsonl(recs.where(F.col("event_id") % 2 == 1), root, EVENTS_STREAM, batch="b1")
    t = spark.read.schema("value STRING, label STRING, slice STRING").text(f"{root}/{EVENTS_STREAM}")
    return (t.select(J.key_text("value", "event_id").cast("bigint").alias("event_id"), "label")
            .groupBy("event_id", "label").agg(F.count("*").alias("n")))


# ---------------------------------------------------------------- JSONL scan
@query("jsonl_scan", """
SELECT event_id, user_id, CASE WHEN event_type = 'purchase' THEN value END AS amount, NULL AS raw
FROM events WHERE event_type <> 'error'
UNION ALL SELECT NULL, NULL, NULL, CASE WHEN event_id % 2 = 0 THEN '{"event_id":' || event_id || ','
                                        ELSE '{"event_id":' || event_id || '} {"b":2}' END
FROM events WHERE event_type = 'error'""")
def jsonl_scan(spark, sf):
    ev = table(spark, sf, "events")
    root = scratch_dir(spark, "jsonl")
    plain = ev.where(~F.col("event_type").isin("purchase", "error")).select(
        F.to_json(F.struct("event_id", "user_id")).alias("value"))
    extra = ev.where(F.col("event_type") == "purchase").select(
        F.to_json(F.struct("event_id", "user_id", F.col("value").alias("amount"), F.lit("x").alias("note"))).alias("value"))
    broken = ev.where(F.col("event_type") == "error").select(
        F.when(F.col("event_id") % 2 == 0, F.format_string('{"event_id":%d,', "event_id"))
        .otherwise(F.format_string('{"event_id":%d} {"b":2}', "event_id")).alias("value"))
    plain.unionByName(broken).write.text(f"{root}/a")
    extra.write.text(f"{root}/b")
    rows, bad = scan_jsonl(spark, [f"{root}/a", f"{root}/b"], "event_id BIGINT, user_id BIGINT, amount DOUBLE",
                           with_quarantine=True)
    return rows.withColumn("raw", F.lit(None).cast("string")).unionByName(bad.select("raw"), allowMissingColumns=True)


# ---------------------------------------------------------------- typed casts
@query("typed_cast", """
SELECT event_id,
  CASE WHEN event_id % 4 = 0 THEN epoch_us(ts) ELSE (epoch_us(ts) // 1000) * 1000 END AS ts_us,
  CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) * 1000000 AS ts_s_us,
  CAST(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS DECIMAL(38,18))::DOUBLE AS value_dec,
  NULL::DOUBLE AS bad_dec
FROM events""")
def typed_cast(spark, sf):
    ev = table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    m = F.col("event_id") % 4
    text = (F.when(m == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            .when(m == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'"))
            .when(m == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS'+00'"))
            .otherwise(F.floor(F.unix_micros(ts) / 1000).cast("string")))
    parsed = F.when(m == 3, C.epoch_millis_text(text)).otherwise(C.parse_time(text))
    secs = F.floor(F.unix_micros(ts) / 1_000_000).cast("bigint")
    return ev.select("event_id", F.unix_micros(parsed).alias("ts_us"),
                     F.unix_micros(C.epoch_seconds_int(secs)).alias("ts_s_us"),
                     C.to_decimal(F.col("value").cast("decimal(18,2)").cast("string")).cast("double").alias("value_dec"),
                     C.to_decimal(F.concat(F.lit("x"), F.col("value").cast("string"))).cast("double").alias("bad_dec"))


@query("normalise_times", """
SELECT event_id, epoch_us(ts) AS created_us, NULL::BIGINT AS bad_us, (epoch_us(ts) // 1000) * 1000 AS book_us,
       event_id % 3 = 0 AS bad_volume FROM events""")
def normalise_times_q(spark, sf):
    """Landed records through the typed layer of two streams and its time fields."""
    ev = table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    market = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("createdAt"),
        F.lit("soon").alias("endDate"), F.when(F.col("event_id") % 3 == 0, "n/a").alias("volumeNum")))
    markets = C.normalise_times(CP.apply_schema(ev.select(market.alias("raw")), "raw", "gamma/markets"), "gamma/markets")
    book = F.to_json(F.struct(F.col("event_id").cast("string").alias("asset_id"),
                              F.floor(F.unix_micros(ts) / 1000).cast("string").alias("timestamp")))
    books = C.normalise_times(CP.apply_schema(ev.select(book.alias("raw")), "raw", "clob/books"), "clob/books")
    return (markets.join(books, markets["id"] == books["asset_id"])
            .select(F.col("id").cast("bigint").alias("event_id"), F.unix_micros("createdAt").alias("created_us"),
                    F.unix_micros("endDate").alias("bad_us"), F.unix_micros("timestamp").alias("book_us"),
                    F.array_contains(markets["_cast_errors"], "volumeNum").alias("bad_volume")))


@query("long_numbers", """
SELECT event_id, repeat('7', 70) || event_id AS asset_id, 'feed/events' AS _source FROM events""")
def long_numbers(spark, sf):
    """Token ids sent as bare numbers keep all their digits when metadata is added."""
    ev = table(spark, sf, "events")
    raw = F.format_string('{"event_id":%d,"asset_id":%s%d}', F.col("event_id"), F.repeat(F.lit("7"), F.lit(70)),
                          F.col("event_id"))
    line = metadata_json(raw, F.lit(1.0), F.lit("feed/events"))
    return ev.select(J.key_text(line, "event_id").cast("bigint").alias("event_id"),
                     F.regexp_extract(line, r'"asset_id":(\d+)', 1).alias("asset_id"),
                     J.key_text(line, "_source").alias("_source"))


# ---------------------------------------------------------------- key tagging
@query("tag_and_wrap", """
SELECT c_custkey,
  CASE WHEN c_custkey % 3 = 1 THEN 'own' || c_custkey ELSE CAST(c_nationkey AS VARCHAR) END AS condition_id,
  CASE WHEN c_custkey % 3 = 2 THEN CAST(c_custkey AS VARCHAR) END AS data,
  CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE 'w' || c_custkey END AS proxyWallet
FROM customer""")
def tag_and_wrap(spark, sf):
    c = table(spark, sf, "customer")
    m = F.col("c_custkey") % 3
    entry = (F.when(m == 0, F.format_string('{"proxyWallet":"w%d"}', "c_custkey"))
             .when(m == 1, F.format_string('{"condition_id":"own%d","proxyWallet":"w%d"}', "c_custkey", "c_custkey"))
             .otherwise(F.format_string("%d", "c_custkey")))
    line = wrap_non_object(entry, "condition_id", F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", J.key_text(line, "condition_id").alias("condition_id"),
                    J.key_text(line, "data").alias("data"), J.key_text(line, "proxyWallet").alias("proxyWallet"))


@query("price_record", """
SELECT CASE WHEN p_size > 45 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS token_id,
       CASE WHEN p_size < 3 THEN NULL ELSE p_retailprice END AS price FROM part""")
def price_record_q(spark, sf):
    p = table(spark, sf, "part")
    raw = p.select(F.when(F.col("p_size") <= 45, F.col("p_partkey")).alias("token_id"),
                   F.when(F.col("p_size") >= 3, F.col("p_retailprice")).alias("price"), "p_name")
    return M.price_record(raw)


# ---------------------------------------------------------------- nested fields
@query("drop_nested", """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title, 'brand' AS extra_keys, p_brand AS brand FROM part""")
def drop_nested(spark, sf):
    p = table(spark, sf, "part")
    raw = p.select(F.format_string('{"id":"%d","title":"%s","events":[{"id":%d},{"id":%d}],"brand":"%s"}',
                                   "p_partkey", "p_name", "p_partkey", "p_size", "p_brand").alias("raw"))
    rec = CP.typed_records(raw, "raw", "gamma/series")
    return rec.where("_good").select(
        F.col("_rec.id").alias("id"), F.col("_rec.title").alias("title"),
        F.array_join(F.sort_array(F.map_keys("_extra")), ",").alias("extra_keys"),
        F.variant_get(F.col("_extra")["brand"], "$", "string").alias("brand"))


@query("event_children", """
SELECT o_orderkey, i AS child_no, o_orderkey * 10 + i + 1 AS market_id FROM orders, range(2) t(i)
WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, NULL, NULL FROM orders WHERE o_orderstatus <> 'O'""")
def event_children(spark, sf):
    o = table(spark, sf, "orders")
    markets = F.when(F.col("o_orderstatus") == "O",
                     F.array(F.struct((F.col("o_orderkey") * 10 + 1).alias("id")),
                             F.struct((F.col("o_orderkey") * 10 + 2).alias("id")))) \
        .when(F.col("o_orderstatus") == "F", F.array().cast("array<struct<id:bigint>>"))
    ev = o.select("o_orderkey", markets.alias("markets"))
    out = M.explode_children(ev, ["o_orderkey"], "markets")
    return out.select("o_orderkey", F.col("child_no").cast("bigint").alias("child_no"),
                      F.col("child.id").alias("market_id"))


@query("event_tags", """
SELECT o_orderkey, 0 AS child_no, o_orderpriority AS tag_label FROM orders""")
def event_tags(spark, sf):
    o = table(spark, sf, "orders")
    ev = o.select("o_orderkey", F.array(F.struct(F.col("o_orderpriority").alias("label"))).alias("tags"))
    out = M.explode_children(ev, ["o_orderkey"], "tags")
    return out.select("o_orderkey", F.col("child_no").cast("bigint").alias("child_no"),
                      F.col("child.label").alias("tag_label"))


# ---------------------------------------------------------------- quotes for a work-list
@query("quotes_for", """
SELECT l_partkey AS token_id, l_extendedprice / l_quantity AS midpoint FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 45)
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1""")
def quotes_for(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    mids = li.select(F.col("l_partkey").alias("token_id"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("midpoint"),
                     "l_shipdate", "l_orderkey", "l_linenumber")
    wanted = p.where(F.col("p_size") > 45).select(F.col("p_partkey").alias("token_id"))
    latest = M.quotes_for(mids, wanted, "token_id", ["l_shipdate"], ["l_orderkey", "l_linenumber"])
    return latest.select("token_id", "midpoint")


# ---------------------------------------------------------------- resumable ingest
_RUN1 = 25000


@query("resumable_ingest", f"""
WITH r AS (SELECT l_orderkey * 8 + l_linenumber AS item_offset,
                  row_number() OVER (ORDER BY l_orderkey * 8 + l_linenumber) - 1 AS rn FROM lineitem)
SELECT item_offset, CASE WHEN rn < {_RUN1} THEN 1 ELSE 2 END AS run,
       CASE WHEN rn < {_RUN1} THEN rn // 100 ELSE (rn - {_RUN1}) // 100 END AS page FROM r""")
def resumable_ingest_q(spark, sf):
    items = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("item_offset"))
    root = scratch_dir(spark, "backfill")
    run1 = PG.ingest_run(spark, root, items, limit=_RUN1)
    run2 = PG.ingest_run(spark, root, items)
    assert PG.ingest_run(spark, root, items).isEmpty(), "a completed ingest ran again"
    assert ST.load_state(spark, root)["cursor"].first()["completed"]
    return run1.withColumn("run", F.lit(1)).unionByName(run2.withColumn("run", F.lit(2))) \
        .select("item_offset", "run", "page")


# ---------------------------------------------------------------- state (K9)
@query("state_roundtrip", """
SELECT 'customer' AS kind, CAST(c_custkey AS VARCHAR) AS id, c_acctbal AS first_seen FROM customer
UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), p_retailprice FROM part""")
def state_roundtrip(spark, sf):
    c, p = table(spark, sf, "customer"), table(spark, sf, "part")
    ids = D.id_union(
        c.select(F.lit("customer").alias("kind"), F.col("c_custkey").cast("string").alias("id"),
                 F.col("c_acctbal").alias("first_seen")),
        p.select(F.lit("part").alias("kind"), F.col("p_partkey").cast("string").alias("id"),
                 F.col("p_retailprice").alias("first_seen")))
    root = scratch_dir(spark, "state")
    lf = c.groupBy(F.col("c_mktsegment").alias("source")).agg(F.max("c_acctbal").alias("last_fetch"))
    cursor = spark.createDataFrame([("backfill", 0, False)], ST.CURSOR_SCHEMA)
    ST.save_state(spark, root, {"ids": ids, "last_fetch": lf, "cursor": cursor})
    assert not ST.save_state(spark, root, {"ids": ids, "last_fetch": lf, "cursor": cursor})
    # saving one table alone leaves the others as they are
    assert ST.save_state(spark, root, {"cursor": cursor.withColumn("completed", F.lit(True))})
    state = ST.load_state(spark, root)
    assert state["cursor"].first()["completed"] and state["last_fetch"].count() == lf.count()
    return state["ids"]


@query("state_delta", """
SELECT 'customer' AS kind, CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_custkey % 100 = 1 THEN 0.5 ELSE c_acctbal END AS first_seen FROM customer WHERE c_custkey % 100 <> 2""")
def state_delta(spark, sf):
    """Saves of 1 % new, 1 % changed and 1 % removed ids write just those; a reader of the pointer before stays whole (K9)."""
    c = table(spark, sf, "customer")
    key, seen = F.col("c_custkey"), F.col("c_acctbal")

    def ids(where, first_seen=seen):
        return c.where(where).select(F.lit("customer").alias("kind"), key.cast("string").alias("id"),
                                     first_seen.alias("first_seen"))
    root = scratch_dir(spark, "state-delta")
    changed = F.when(key % 100 == 1, 0.5).otherwise(seen)
    before = ids(key % 100 != 0)
    ST.save_state(spark, root, {"ids": before})
    old = ST.read_pointer(spark, root)
    for given in (ids(key >= 0), ids(key >= 0, changed), ids(key % 100 != 2, changed)):
        step = len(ST.read_pointer(spark, root)["tables"]["ids"]["parts"]) - 1
        one_percent = c.where((key % 100 == step) & ((key % 100 != 1) | (seen != 0.5))).count()
        assert ST.save_state(spark, root, {"ids": given})
        part = ST.read_pointer(spark, root)["tables"]["ids"]["parts"][-1]
        assert spark.read.parquet(f"{root}/{part}").count() == one_percent, "a save wrote more than what changed"
    assert not ST.save_state(spark, root, {"ids": ids(key % 100 != 2, changed)})
    assert ST.load_state(spark, root, old)["ids"].count() == before.count(), "the older version is not whole"
    return ST.load_state(spark, root)["ids"]


# ---------------------------------------------------------------- streaming
def _stream_frames(spark, sf):
    """Market frames (the detect_route shapes) with a ``seq`` key, plus arrival time."""
    from quaylake.plans.catalog import detect_frame_spark
    ev = table(spark, sf, "events")
    raw = F.concat(F.format_string('{"seq":%d,', "event_id"), F.expr("substr(raw0, 2)"))
    return (ev.select("event_id", "user_id", "event_type", "ts", detect_frame_spark().alias("raw0"))
              .select(F.lit("ws_market").alias("channel"), raw.alias("raw"), L.epoch_seconds("ts").alias("_fetched_at"),
                      "event_type", "ts"))


def _run(q):
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _read_seq(spark, raw_root):
    r = S.read_routed(spark, raw_root)
    return r.select(J.key_text("line", "seq").cast("bigint").alias("seq"), "stream",
                    J.key_text("line", "_source").alias("_source"), "label")


_STREAM_ROUTE_SQL = f"""
SELECT event_id AS seq, 'ws_market/' || {{route}} AS stream, 'ws_market/' || {{route}} AS _source,
       strftime(ts, '%Y-%m-%dT%H') AS label
FROM (SELECT event_id, ts, {{detect}} AS t FROM (SELECT event_id, ts, {{frame}} AS f FROM events))"""


def _stream_route_sql():
    from quaylake.plans.catalog import _DETECT_FRAME_SQL, _DETECT_SQL, _ROUTE_SQL
    return _STREAM_ROUTE_SQL.format(route=f"({_ROUTE_SQL})", detect=_DETECT_SQL, frame=_DETECT_FRAME_SQL)


@query("stream_route", _stream_route_sql())
def stream_route(spark, sf):
    root = scratch_dir(spark, "stream-route")
    S.land_frames(_stream_frames(spark, sf).repartitionByRange("_fetched_at"), f"{root}/frames")
    _run(S.route_stream(spark, f"{root}/frames", f"{root}/raw", f"{root}/quarantine", f"{root}/ckpt",
                        max_files_per_trigger=2))
    return _read_seq(spark, f"{root}/raw")


@query("stream_recovery", _stream_route_sql())
def stream_recovery(spark, sf):
    """Two availableNow runs on one checkpoint: the second sees only the new files."""
    root = scratch_dir(spark, "stream-recovery")
    frames = _stream_frames(spark, sf)
    S.land_frames(frames.where(F.col("event_type") != "error"), f"{root}/frames")
    args = (spark, f"{root}/frames", f"{root}/raw", f"{root}/quarantine", f"{root}/ckpt")
    _run(S.route_stream(*args))
    S.land_frames(frames.where(F.col("event_type") == "error"), f"{root}/frames")
    _run(S.route_stream(*args))
    return _read_seq(spark, f"{root}/raw")


@query("stream_shared_root", _stream_route_sql())
def stream_shared_root(spark, sf):
    """Two streams with their own checkpoints land in the same folders; both start at epoch 0."""
    root = scratch_dir(spark, "stream-shared")
    frames = _stream_frames(spark, sf)
    for name, where in (("a", F.col("event_type") != "error"), ("b", F.col("event_type") == "error")):
        S.land_frames(frames.where(where), f"{root}/frames-{name}")
        _run(S.route_stream(spark, f"{root}/frames-{name}", f"{root}/raw", f"{root}/quarantine", f"{root}/ckpt-{name}"))
    return _read_seq(spark, f"{root}/raw")


@query("stream_split", """
SELECT event_id AS seq,
  CASE WHEN event_type IN ('click', 'view') THEN 'ws_sports/events'
       WHEN event_type = 'purchase' THEN 'ws_rtds/crypto_prices' ELSE 'ws_rtds/activity' END AS stream,
  CASE WHEN event_type IN ('click', 'view') THEN 'ws_sports'
       WHEN event_type = 'purchase' THEN 'ws_rtds/crypto_prices' ELSE 'ws_rtds' END AS _source,
  strftime(ts, '%Y-%m-%dT%H') AS label
FROM events WHERE event_type <> 'signup' OR user_id % 2 = 0""")
def stream_split(spark, sf):
    ev = table(spark, sf, "events")
    et = F.col("event_type")
    channel = F.when(et.isin("click", "view") | (et == "signup"), "ws_sports").otherwise("ws_rtds")
    raw = (F.when(et.isin("click", "view"), F.format_string('{"seq":%d,"sport":"u%d"}', "event_id", "user_id"))
           .when((et == "signup") & (F.col("user_id") % 2 == 1), F.lit(" ping "))
           .when(et == "signup", F.format_string('{"seq":%d,"channel":"x"}', "event_id"))
           .when(et == "purchase", F.format_string('{"seq":%d,"channel":"crypto_prices"}', "event_id"))
           .otherwise(F.format_string('{"seq":%d,"channel":"activity"}', "event_id")))
    channel = F.when((et == "signup") & (F.col("user_id") % 2 == 0), F.lit("ws_rtds")).otherwise(channel)
    frames = ev.select(channel.alias("channel"), raw.alias("raw"), L.epoch_seconds("ts").alias("_fetched_at"))
    root = scratch_dir(spark, "stream-split")
    S.land_frames(frames.repartitionByRange("_fetched_at"), f"{root}/frames")
    _run(S.route_stream(spark, f"{root}/frames", f"{root}/raw", f"{root}/quarantine", f"{root}/ckpt",
                        max_files_per_trigger=1))
    return _read_seq(spark, f"{root}/raw")


@query("stream_new_ids", """
SELECT CAST(user_id AS VARCHAR) AS id, min(epoch_us(ts)) AS first_seen_us FROM events GROUP BY user_id""")
def stream_new_ids(spark, sf):
    root = scratch_dir(spark, "stream-ids")
    ev = table(spark, sf, "events")
    frames = ev.select(F.lit("ws_market").alias("channel"), F.format_string('{"user":%d,"seq":%d}', "user_id", "event_id")
                       .alias("raw"), L.epoch_seconds("ts").alias("_fetched_at"))
    cut = F.lit(dt.datetime(2024, 1, 15).replace(tzinfo=dt.timezone.utc).timestamp())
    for part in (frames.where(F.col("_fetched_at") < cut), frames.where(F.col("_fetched_at") >= cut)):
        S.land_frames(part, f"{root}/frames")
        _run(S.new_ids_stream(spark, f"{root}/frames", f"{root}/out", f"{root}/ckpt", id_path="$.user"))
    return S.read_new_ids(spark, f"{root}/out").select("id", F.unix_micros("first_seen").alias("first_seen_us"))


@query("stream_known_ids", """
SELECT CAST(user_id AS VARCHAR) AS id, min(epoch_us(ts)) AS first_seen_us FROM events WHERE user_id % 3 <> 0 GROUP BY user_id""")
def stream_known_ids(spark, sf):
    """A third of the ids lie in an id table before the stream begins; later micro-batches read their frames alone."""
    root = scratch_dir(spark, "stream-known")
    ev = table(spark, sf, "events")
    (ev.where(F.col("user_id") % 3 == 0).select(F.col("user_id").cast("string").alias("id"),
                                                F.col("ts").cast("timestamp").alias("first_seen"))
     .groupBy("id").agg(F.min("first_seen").alias("first_seen")).write.parquet(f"{root}/known"))
    frames = ev.select(F.lit("ws_market").alias("channel"), F.format_string('{"user":%d}', "user_id").alias("raw"),
                       L.epoch_seconds("ts").alias("_fetched_at"))
    for day, (first, last) in enumerate((("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-03-01"))):
        between = (F.col("_fetched_at") >= _epoch(first)) & (F.col("_fetched_at") < _epoch(last))
        part = frames.where(between)
        S.land_frames(part, f"{root}/frames")
        q = S.new_ids_stream(spark, f"{root}/frames", f"{root}/out", f"{root}/ckpt", known_path=f"{root}/known")
        _run(q)
        if day:
            assert _rows_read(q) == part.count(), "a later micro-batch read more than its frames"
    return S.read_new_ids(spark, f"{root}/out").select("id", F.unix_micros("first_seen").alias("first_seen_us"))


def _epoch(day: str) -> float:
    return dt.datetime.fromisoformat(day).replace(tzinfo=dt.timezone.utc).timestamp()


def _rows_read(q) -> int:
    """Rows that the micro-batches of a finished run took in."""
    return sum(p["numInputRows"] for p in q.recentProgress)


def _stream_hourly_sql(late: str):
    from quaylake.plans.catalog import _DETECT_FRAME_SQL, _DETECT_SQL, _ROUTE_SQL
    return f"""
SELECT strftime(ts, '%Y-%m-%dT%H') AS label, 'ws_market/' || ({_ROUTE_SQL}) AS stream,
       count(*)::BIGINT AS n, sum(CASE WHEN {late} THEN 1 ELSE 0 END)::BIGINT AS n_late
FROM (SELECT ts, event_type, {_DETECT_SQL} AS t FROM (SELECT ts, event_type, {_DETECT_FRAME_SQL} AS f FROM events))
GROUP BY ALL"""


@query("stream_hourly", _stream_hourly_sql("false"))
def stream_hourly(spark, sf):
    root = scratch_dir(spark, "stream-hourly")
    S.land_frames(_stream_frames(spark, sf), f"{root}/frames")
    _run(S.hourly_stream(spark, f"{root}/frames", f"{root}/out", f"{root}/ckpt"))
    return S.hourly_counts(spark, f"{root}/out")


@query("stream_late", _stream_hourly_sql("""event_type = 'error' AND strftime(ts, '%Y-%m-%dT%H') <
  (SELECT max(strftime(ts, '%Y-%m-%dT%H')) FROM events WHERE event_type <> 'error')"""))
def stream_late(spark, sf):
    """A second run brings rows of hours that the first one had counted: they are a later slice."""
    root = scratch_dir(spark, "stream-late")
    frames = _stream_frames(spark, sf)
    for where in (F.col("event_type") != "error", F.col("event_type") == "error"):
        S.land_frames(frames.where(where), f"{root}/frames")
        _run(S.hourly_stream(spark, f"{root}/frames", f"{root}/out", f"{root}/ckpt"))
    return S.hourly_counts(spark, f"{root}/out")


@query("closed_hours", f"""
SELECT strftime(ts, '%Y-%m-%dT%H') AS label, count(*)::BIGINT AS n FROM events WHERE {_CLOSED} GROUP BY 1""")
def closed_hours(spark, sf):
    """The view of closed windows at the fixed clock."""
    root = scratch_dir(spark, "closed-hours")
    S.land_frames(_stream_frames(spark, sf), f"{root}/frames")
    _run(S.hourly_stream(spark, f"{root}/frames", f"{root}/out", f"{root}/ckpt"))
    counts = S.hourly_counts(spark, f"{root}/out", closed_before=HOUR_NOW)
    return counts.groupBy("label").agg(F.sum("n").alias("n"))


_LATE = "event_type = 'error' AND ts < TIMESTAMP '2024-01-11'"


def _routed_sql():
    from quaylake.plans.catalog import _DETECT_FRAME_SQL, _DETECT_SQL, _ROUTE_SQL
    return f"""
SELECT event_id, ts, event_type, strftime(ts, '%Y-%m-%dT%H') AS label, 'ws_market/' || ({_ROUTE_SQL}) AS stream
FROM (SELECT *, {_DETECT_SQL} AS t FROM (SELECT *, {_DETECT_FRAME_SQL} AS f FROM events))"""


@query("stream_closed", f"""
WITH r AS ({_routed_sql()}),
run AS (SELECT *, CASE WHEN {_LATE} THEN 2 WHEN ts < TIMESTAMP '2024-01-11' THEN 1
                       WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS run FROM r),
flagged AS (SELECT *, run = 2 AND {_LATE} AND date_trunc('hour', ts) + INTERVAL 1 HOUR
                   <= (SELECT max(ts) FROM run WHERE run = 1) AS late FROM run)
SELECT label, stream, 'closed' AS kind, count(*)::BIGINT AS n FROM flagged
WHERE NOT late AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM run) GROUP BY ALL
UNION ALL SELECT label, stream, 'late', count(*)::BIGINT FROM flagged WHERE late GROUP BY ALL""")
def stream_closed(spark, sf):
    """Three runs: each hour is emitted once, as the watermark passes its end; what came after that is flagged."""
    root = scratch_dir(spark, "stream-closed")
    frames = _stream_frames(spark, sf)
    at, late = F.col("_fetched_at"), F.col("event_type") == "error"
    first, second = at < _epoch("2024-01-11"), at < _epoch("2024-01-21")
    for part in (first & ~late, (first & late) | (~first & second), ~second):
        S.land_frames(frames.where(part), f"{root}/frames")
        _run(S.hourly_stream(spark, f"{root}/frames", f"{root}/counts", f"{root}/ckpt-counts"))
        _run(S.closed_hours_stream(spark, f"{root}/counts", f"{root}/ckpt-counts", f"{root}/closed", f"{root}/ckpt-closed"))
    closed = S.read_closed_hours(spark, f"{root}/closed")
    assert closed.select("slice").distinct().count() >= 3, "hours were not emitted run by run"
    late_rows = S.read_counts(spark, f"{root}/counts").where("late").groupBy("label", "stream").agg(F.sum("n").alias("n"))
    return (closed.select("label", "stream", F.lit("closed").alias("kind"), "n")
            .unionByName(late_rows.select("label", "stream", F.lit("late").alias("kind"), "n")))


@query("stream_marks", f"""
WITH r AS ({_routed_sql()}),
half AS (SELECT *, ts < TIMESTAMP '2024-01-15' AS early FROM r)
SELECT label, stream, count(*)::BIGINT AS n,
       sum(CASE WHEN event_type = 'error' AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark THEN 1 ELSE 0 END)::BIGINT AS n_late
FROM half JOIN (SELECT early, max(ts) AS mark FROM half WHERE event_type <> 'error' GROUP BY early) USING (early) GROUP BY ALL""")
def stream_marks(spark, sf):
    """Two streams with clocks two weeks apart write one folder in turn; each row is late by its own stream's mark."""
    root = scratch_dir(spark, "stream-marks")
    frames = _stream_frames(spark, sf)
    early, late = F.col("_fetched_at") < _epoch("2024-01-15"), F.col("event_type") == "error"
    for name, part in (("b", ~early & ~late), ("a", early & ~late), ("b", ~early & late), ("a", early & late)):
        S.land_frames(frames.where(part), f"{root}/frames-{name}")
        _run(S.hourly_stream(spark, f"{root}/frames-{name}", f"{root}/out", f"{root}/ckpt-{name}"))
    return S.hourly_counts(spark, f"{root}/out")


@query("byte_frames", f"""
WITH r AS ({_routed_sql()})
SELECT event_id AS seq, CASE WHEN event_type <> 'error' THEN stream END AS stream,
       CASE WHEN event_type = 'error' THEN 'bad_utf8' END AS reason FROM r""")
def byte_frames(spark, sf):
    """Frames as bytes: UTF-8 text is routed, malformed bytes go to the quarantine, whole."""
    root = scratch_dir(spark, "byte-frames")
    whole = F.to_binary(F.col("raw"), F.lit("utf-8"))
    # a two-byte sequence whose second byte is none
    payload = F.when(F.col("event_type") == "error", F.concat(whole, F.lit(b"\xc3("))).otherwise(whole)
    S.land_frames(_stream_frames(spark, sf).withColumn("payload", payload), f"{root}/frames")
    _run(S.route_stream(spark, f"{root}/frames", f"{root}/raw", f"{root}/quarantine", f"{root}/ckpt", payload=True))
    good = _read_seq(spark, f"{root}/raw").select("seq", "stream", F.lit(None).cast("string").alias("reason"))
    if not inv.exists(spark, f"{root}/quarantine"):
        return good
    bad = spark.read.parquet(f"{root}/quarantine")
    text = F.decode(F.unbase64("raw"), "ISO-8859-1")
    return good.unionByName(bad.select(F.regexp_extract(text, r'"seq":(\d+)', 1).cast("bigint").alias("seq"),
                                       F.lit(None).cast("string").alias("stream"), "reason"))


@query("stream_ticks", _stream_route_sql())
def stream_ticks(spark, sf):
    """A stream on a clock: frames, control frames alone, nothing, and frames again; only records are written."""
    root = scratch_dir(spark, "stream-ticks")
    frames = _stream_frames(spark, sf)
    half = F.col("event_id") % 2 == 0
    controls = frames.withColumn("raw", F.lit(" PONG ")).limit(50)
    q = None
    try:
        for part in (frames.where(half), controls, None, frames.where(~half)):
            if part is not None:
                S.land_frames(part, f"{root}/frames")
            if q is None:
                q = S.route_stream(spark, f"{root}/frames", f"{root}/raw", f"{root}/quarantine", f"{root}/ckpt",
                                   available_now=False, interval="500 milliseconds")
            q.processAllAvailable()
        ticks = [p for p in q.recentProgress if p["numInputRows"]]
    finally:
        if q is not None:
            q.stop()
    slices = {p.split("/slice=")[1].split("/")[0] for p in inv.folders_of(spark, f"{root}/raw")}
    assert len(ticks) == 3 and len(slices) == 2, f"{len(ticks)} ticks with frames wrote {len(slices)} slices"
    assert not inv.exists(spark, f"{root}/quarantine"), "control frames were quarantined"
    return _read_seq(spark, f"{root}/raw")


# ---------------------------------------------------------------- reference lists (S12), progress
@query("reference_tables", """
SELECT 'tags' AS kind, n_nationkey, i AS item_no,
       '{"id":"' || (n_nationkey * 10 + i) || '","label":"' || n_name || '"}' AS item
FROM nation, range(2) t(i) WHERE n_nationkey % 2 = 0
UNION ALL SELECT 'tags', n_nationkey, 0, '{"id":"' || n_nationkey || '","label":"' || n_name || '"}'
FROM nation WHERE n_nationkey % 2 = 1
UNION ALL SELECT 'series', n_nationkey, 0, '{"id":"s' || n_nationkey || '","title":"' || n_name || '"}'
FROM nation WHERE n_nationkey % 4 <> 3
UNION ALL SELECT 'sports', n_nationkey, 0, '{"id":' || n_nationkey || ',"sport":"' || n_name || '"}'
FROM nation WHERE n_nationkey % 3 <> 0""")
def reference_tables(spark, sf):
    n = table(spark, sf, "nation")
    k = F.col("n_nationkey")
    tag = lambda i: F.format_string('{"id":"%d","label":"%s"}', k * 10 + i, F.col("n_name"))
    tags = F.when(k % 2 == 0, F.concat(F.lit("["), tag(0), F.lit(","), tag(1), F.lit("]"))) \
        .otherwise(F.format_string('{"id":"%d","label":"%s"}', k, F.col("n_name")))
    series = F.when(k % 4 != 3, F.format_string('[{"id":"s%d","title":"%s","events":[{"id":1}]}]', k, F.col("n_name"))) \
        .otherwise(F.format_string('{"id":"s%d"}', k))
    sports = F.when(k % 3 != 0, F.format_string('[{"id":%d,"sport":"%s"}]', k, F.col("n_name"))) \
        .otherwise(F.lit('{"error":"unavailable"}'))
    out = None
    for kind, body in (("tags", tags), ("series", series), ("sports", sports)):
        resp = n.select("n_nationkey", body.alias("body"))
        part = PG.reference_items(resp, kind, ["n_nationkey"]).select(
            F.lit(kind).alias("kind"), "n_nationkey", F.col("item_no").cast("bigint").alias("item_no"), "item")
        out = part if out is None else out.unionByName(part)
    return out


@query("ingest_progress", """
WITH p AS (SELECT l_orderkey // 100 AS page, count(*) AS n, min(epoch_us(l_shipdate)) / 1000000.0 AS s,
                  max(epoch_us(l_shipdate)) / 1000000.0 AS e FROM lineitem GROUP BY 1)
SELECT sum(n)::BIGINT AS items, count(*)::BIGINT AS pages, max(e) - min(s) AS elapsed,
       sum(n) / (max(e) - min(s)) AS items_per_s FROM p""")
def ingest_progress_q(spark, sf):
    from quaylake.operators.monitor import ingest_progress
    li = table(spark, sf, "lineitem")
    ts = L.epoch_seconds("l_shipdate")
    manifest = li.groupBy(F.floor(F.col("l_orderkey") / 100).alias("page")).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(1).alias("pages"), F.min(ts).alias("started_at"),
        F.max(ts).alias("finished_at"))
    return ingest_progress(manifest).select(F.col("items").cast("bigint").alias("items"),
                                            F.col("pages").cast("bigint").alias("pages"), "elapsed", "items_per_s")
