"""Landing: metadata, labels, tagging and the tolerant scan."""

from pyspark.sql import functions as F

from quaylake.operators.land import land_jsonl, metadata_json, resolve_source, tag_key, wrap_non_object
from quaylake.sources.tables import scan_jsonl
from quaylake.specs import SPECS


def test_metadata_added(spark, scratch):
    df = spark.createDataFrame([("abc", "Does the ferry run?")], "id string, question string")
    land_jsonl(df, f"{scratch}/raw", "gamma/markets", fetched_at=1772800000.5)
    out = spark.read.json(f"{scratch}/raw/gamma/markets")
    r = out.first()
    assert r["_source"] == "gamma/markets" and isinstance(r["_fetched_at"], float)
    assert r["_fetched_at"] == 1772800000.5 and r["id"] == "abc" and r["question"] == "Does the ferry run?"


def test_source_override_and_fallback():
    assert resolve_source("desk-7", "s") == "desk-7"
    assert resolve_source("", "s") == "s" and resolve_source(None, "s") == "s"


def test_batch_shares_one_timestamp_and_appends(spark, scratch):
    df = spark.createDataFrame([(str(i),) for i in range(5)], "id string")
    land_jsonl(df, f"{scratch}/raw", "t", fetched_at=1772800000.0)
    land_jsonl(df.limit(2), f"{scratch}/raw", "t", fetched_at=1772800001.0)
    out = spark.read.json(f"{scratch}/raw/t")
    assert out.count() == 7
    assert out.where("_fetched_at = 1772800000.0").select("_fetched_at").distinct().count() == 1
    assert out.select("label").distinct().count() == 1


def test_hourly_and_daily_labels(spark, scratch):
    df = spark.createDataFrame([("1",)], "id string")
    land_jsonl(df, f"{scratch}/raw", "h", fetched_at=1772805600.0)
    land_jsonl(df, f"{scratch}/raw", "d", daily=True, fetched_at=1772805600.0)
    land_jsonl(df, f"{scratch}/raw", "h", fetched_at=1772809200.0)
    h = sorted(r["label"] for r in spark.read.json(f"{scratch}/raw/h").collect())
    d = [r["label"] for r in spark.read.json(f"{scratch}/raw/d").collect()]
    assert [len(x) for x in h] == [13, 13] and h[0] != h[1]
    assert [len(x) for x in d] == [10]


def test_record_keys_win_and_tagging(spark):
    df = spark.createDataFrame([('{"a":1}',), ('{"_source":"own","a":2}',)], "r string")
    lines = [r["l"] for r in df.select(metadata_json("r", F.lit(5.0), F.lit("s")).alias("l")).collect()]
    import json
    assert list(json.loads(lines[0]).items()) == [("_fetched_at", 5.0), ("_source", "s"), ("a", 1)]
    assert '"_source":"own"' in lines[1] and '"_source":"s"' not in lines[1]
    long_id = '{"asset_id":' + "7" * 77 + '}'
    kept = spark.createDataFrame([(long_id,), ("{}",)], "r string").select(metadata_json("r", F.lit(5.0), F.lit("s"))).collect()
    assert kept[0][0] == '{"_fetched_at":5.0,"_source":"s","asset_id":' + "7" * 77 + '}'
    assert kept[1][0] == '{"_fetched_at":5.0,"_source":"s"}'
    t = spark.createDataFrame([('{"token_id":"own"}',), ('{"x":1}',), ("7",)], "r string")
    got = [r["l"] for r in t.select(wrap_non_object("r", "token_id", F.lit("tid")).alias("l")).collect()]
    assert got == ['{"token_id":"own"}', '{"token_id":"tid","x":1}', '{"token_id":"tid","data":7}']
    assert t.select(tag_key(F.lit('{"x":1}'), "k", F.lit("v")).alias("l")).first()["l"] == '{"k":"v","x":1}'


def test_scan_jsonl_quarantine(spark, scratch):
    from quaylake.sources import inventory as inv
    inv.write_text_file(spark, f"{scratch}/a.jsonl", '{"id":"1","x":1}\n{"id":\n\n{"id":"2","y":true}\n')
    rows, bad = scan_jsonl(spark, f"{scratch}/a.jsonl", "id STRING", with_quarantine=True)
    assert sorted(r["id"] for r in rows.collect()) == ["1", "2"]
    assert [r["raw"] for r in bad.collect()] == ['{"id":']


def test_series_events_field_dropped(spark):
    from quaylake.operators.compact import typed_records
    df = spark.createDataFrame([('{"id":"s1","events":[{"a":1}],"new":2}',)], "raw string")
    r = typed_records(df, "raw", "gamma/series").first()
    assert r["_rec"]["id"] == "s1" and sorted(r["_extra"].keys()) == ["new"]
    assert "events" not in [f.name for f in SPECS["gamma/series"].schema.fields]


def test_cast_errors(spark):
    from quaylake.operators.compact import typed_records
    df = spark.createDataFrame([('{"id":"1","value":"x","other":null}',), ('{"id":"2","value":5}',),
                                ('{"id":"3","value":null}',)], "raw string")
    rows = typed_records(df, "raw", "s", ddl="id STRING, value BIGINT").orderBy("raw").collect()
    assert [r["_cast_errors"] for r in rows] == [["value"], [], []]
    assert [r["_rec"]["value"] for r in rows] == [None, 5, None]


SAMPLES = {
    "gamma/markets": '{"id":"1","question":"Q?","clobTokenIds":"[\\"1\\",\\"2\\"]","volume":"12.5","active":true,"closed":false,"rewardsMinSize":5,"newKey":1}',
    "gamma/events": '{"id":"e1","markets":[{"id":"1"},{"x":[1,2]}],"tags":[{"id":"t","label":"L","slug":"l"}],"openInterest":3}',
    "gamma/tags": '{"id":"t1","label":"Politics","requiresTranslation":false}',
    "gamma/series": '{"id":"s1","title":"S","events":[{"id":"e"}],"commentCount":2}',
    "gamma/sports": '{"id":7,"sport":"nba","tags":"1,2"}',
    "clob/prices": '{"token_id":"t","price":{"error":"no book"},"midpoint":"0.5"}',
    "clob/books": '{"asset_id":"a","bids":[{"price":"0.4","size":"10"}],"asks":[],"neg_risk":false}',
    "data_api/trades": '{"proxyWallet":"w","side":"BUY","asset":"a","size":1.5,"price":0.5,"timestamp":1772800000,"outcomeIndex":0}',
    "data_api/holders": '{"condition_id":"m","data":7}',
    "ws_market/book": '{"market":"m","asset_id":"a","bids":[],"asks":[{"price":"0.6","size":"1"}]}',
    "ws_market/price_change": '{"market":"m","price_changes":[{"asset_id":"a","price":"0.5","side":"BUY"}]}',
    "ws_market/last_trade_price": '{"market":"m","last_trade_price":0.42}',
    "ws_sports/events": '{"game":1}',
    "ws_rtds/activity": '{"channel":"activity","x":1}',
    "ws_rtds/crypto_prices": '{"channel":"crypto_prices","p":1}',
}


def test_every_registered_stream_parses_a_sample(spark):
    from quaylake.operators.compact import typed_records
    assert set(SAMPLES) == set(SPECS)
    for stream, line in SAMPLES.items():
        df = spark.createDataFrame([("{" + '"_fetched_at":1.0,"_source":"x",' + line[1:],)], "raw string")
        r = typed_records(df, "raw", stream).first()
        assert r["_good"] and r["_cast_errors"] == [], stream
        assert r["_rec"]["_fetched_at"] == 1.0
    r = typed_records(spark.createDataFrame([(SAMPLES["gamma/markets"],)], "raw string"), "raw", "gamma/markets").first()
    assert r["_rec"]["volume"] == "12.5" and r["_rec"]["active"] is True and list(r["_extra"].keys()) == ["newKey"]
