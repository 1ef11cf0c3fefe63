"""Scalar Column builders: labels, JSON strictness, detection, routing (reference test cases)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quaylake.functions import jsonfn as J
from quaylake.functions import labels as L


def one(spark, col, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("r")).first()["r"]


def test_hour_and_day_labels(spark):
    ts = dt.datetime(2026, 3, 1, 15, 42, 7)
    df = spark.createDataFrame([(ts,)], "t timestamp")
    row = df.select(L.hour_label("t").alias("h"), L.day_label("t").alias("d")).first()
    assert row["h"] == "2026-03-01T15" and len(row["h"]) == 13
    assert row["d"] == "2026-03-01" and len(row["d"]) == 10


def test_next_hour_crosses_month(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 31, 23, 10),)], "t timestamp")
    assert df.select(L.hour_label(L.next_hour("t")).alias("n")).first()["n"] == "2026-02-01T00"


@pytest.mark.parametrize("label,dt_,hour", [("2026-03-01T15", "2026-03-01", "15"),
                                            ("2026-03-05", "2026-03-05", "00")])
def test_label_parts(spark, label, dt_, hour):
    df = spark.createDataFrame([(label,)], "label string")
    r = df.select(L.label_dt("label").alias("d"), L.label_hour("label").alias("h")).first()
    assert (r["d"], r["h"]) == (dt_, hour)


@pytest.mark.parametrize("root,path,stream,label", [
    ("/d/raw", "/d/raw/gamma/markets/2026-03-06T14.jsonl", "gamma/markets", "2026-03-06T14"),
    ("/d/raw/", "/d/raw/gamma/markets/label=2026-03-06T14/part-0.json", "gamma/markets", "2026-03-06T14"),
    ("/d/raw", "/d/raw/channel=ws_market/route=book/label=2026-03-06T14/slice=a-3/part-0.txt", "ws_market/book", "2026-03-06T14"),
    ("file:///d/in box", "/d/in box/tags/2026-03-05.jsonl", "tags", "2026-03-05"),
    ("/d/raw/proj/raw", "/d/raw/proj/raw/tags/2026-03-05.jsonl", "tags", "2026-03-05"),
    ("/elsewhere", "/d/raw/tags/2026-03-05.jsonl", "", "2026-03-05"),
])
def test_stream_and_label_of_path(spark, root, path, stream, label):
    df = spark.createDataFrame([(path,)], "p string")
    r = df.select(L.stream_of_path("p", root).alias("s"), L.label_of_path("p").alias("l")).first()
    assert (r["s"], r["l"]) == (stream, label)


@pytest.mark.parametrize("raw,ok", [
    ('{"a":1}', True), ('[1,2]', True), ("3", True), ('{"a":1', False), ("{'a':1}", False),
    ('{"a":1} xx', False), ('{"a":1} {"b":2}', False), ('{"a":1},{"b":2}', False), ("1] [2", False), ("null", True),
    (' {"a":[1,{"b":"]"}]} ', True), ('"a","b"', False), ("pong", False), ("", False), ('{"a":1,"a":2}', True),
])
def test_strict_json(spark, raw, ok):
    assert one(spark, J.strict_json(F.col("x")), raw) is ok


# detection by key presence: (message, type, route)
@pytest.mark.parametrize("frame,etype,route", [
    ('{"type":"price_change","bids":null,"seq":7}', "book", "book"),
    ('{"seq":8,"last_trade_price":null,"asks":[1]}', "last_trade_price", "last_trade_price"),
    ('{"price_changes":0,"last_trade_price":"0.11"}', "price_change", "price_change"),
    ('{"event_type":"last_trade_price","price_changes":[{}]}', "last_trade_price", "last_trade_price"),
    ('{"event_type":"lighthouse","type":"book"}', "lighthouse", "book"),
    ('{"event_type":null,"price_changes":[]}', None, "book"),
    ('{"event_type":"x","event_type":"price_change"}', "price_change", "price_change"),
    ('{"event_type":12}', "12", "book"),
    ('{"type":"price_change","note":{"bids":[]}}', "price_change", "price_change"),
    ('{"type":"resolution"}', "resolution", "book"),
    ('{}', "unknown", "book"),
])
def test_detect_and_route(spark, frame, etype, route):
    df = spark.createDataFrame([(frame,)], "x string")
    r = df.select(J.detect_event_type("x").alias("t")).select("t", J.route_event("t").alias("r")).first()
    assert (r["t"], r["r"]) == (etype, route)


@pytest.mark.parametrize("frame,route", [
    ('{"px":3,"channel":"crypto_prices"}', "crypto_prices"), ('{"channel":"Crypto_Prices"}', "activity"),
    ('{"note":"crypto_prices"}', "activity"), ('{"channel":null}', "activity"), ('{"channel":["crypto_prices"]}', "activity"),
])
def test_route_channel(spark, frame, route):
    assert one(spark, J.route_channel("x"), frame) == route


def test_control_frame_sets(spark):
    rows = [("ws_market", "PONG"), ("ws_market", " PONG "), ("ws_market", "pong"),
            ("ws_sports", "ping"), ("ws_sports", "pong"), ("ws_sports", "PONG"), ("ws_rtds", "PONG")]
    df = spark.createDataFrame(rows, "c string, r string")
    got = [r["k"] for r in df.select(J.is_control_frame("c", "r").alias("k")).collect()]
    assert got == [True, True, False, True, True, False, False]


@pytest.mark.parametrize("text,ids", [
    ('["1","2"]', ["1", "2"]), ("bad", []), ('{"a":1}', []), (None, []), ("[1, 2]", ["1", "2"]),
])
def test_parse_id_list(spark, text, ids):
    assert one(spark, J.parse_id_list("x"), text) == ids


def _strict_python(text):
    import json

    def no_const(x):
        raise ValueError(x)
    try:
        json.loads(text, parse_constant=no_const)
        return True, ""
    except ValueError as e:  # JSONDecodeError is a ValueError
        return False, str(e)


def test_strict_json_matches_a_strict_decoder(spark):
    """Random mutations of valid documents: Spark's gate agrees with a strict
    decoder except for concatenated values (``{..} {..}``), the documented gap."""
    import json
    import random
    rnd = random.Random(11)
    docs = []
    for i in range(400):
        base = json.dumps({"a": i, "b": [1, "x", None, {"c": True}], "s": "t" * (i % 5)},
                          separators=(",", ":") if i % 2 else (", ", ": "))
        docs.append(base)
        cut = rnd.randint(0, len(base))
        docs.append(base[:cut])                                    # truncation
        pos = rnd.randint(0, len(base))
        docs.append(base[:pos] + rnd.choice(list("{}[],:\"' x0")) + base[pos:])  # one stray char
        docs.append(" " + base + " ")
        docs.append(json.dumps([i, i + 1]) if i % 3 else str(i))
    df = spark.createDataFrame([(d,) for d in docs], "x string")
    got = [r["ok"] for r in df.select(J.strict_json("x").alias("ok")).collect()]
    bad = []
    for d, g in zip(docs, got):
        ok, err = _strict_python(d)
        if ok != g and not (g and "Extra data" in err):
            bad.append((d, g, err))
    assert bad == []
