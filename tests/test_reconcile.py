"""Pages, id sets, quotes, cadence, streaks, chunks, state."""

import json

from pyspark.sql import functions as F

from quaylake.operators import discovery as D
from quaylake.operators import market as M
from quaylake.operators import monitor as MON
from quaylake.operators import state as ST
from quaylake.sources import inventory as inv
from quaylake.sources import pages as PG


def test_page_shapes(spark):
    bodies = ['[{"a":1},{"a":2}]', '{"data":[{"a":3}]}', '{"results":[{"a":4}]}', '{"items":[{"a":5}]}',
              '{"data":5}', '{"x":1}', '{"data":[{"a":6}],"results":[{"a":7}]}', '{"data":null}', '3']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "page_no int, body string")
    out = PG.unwrap_pages(df, ["page_no"]).groupBy("page_no").agg(F.collect_list("item").alias("i"))
    got = {r["page_no"]: r["i"] for r in out.collect()}
    assert got[0] == ['{"a":1}', '{"a":2}'] and got[1] == ['{"a":3}'] and got[2] == ['{"a":4}']
    assert got[3] == ['{"a":5}'] and got[4] == ['{"data":5}'] and 5 not in got
    assert got[6] == ['{"a":6}'] and got[7] == ['{"data":null}'] and 8 not in got


def _pages(spark, sizes, crawl=1):
    rows = []
    for p, n in enumerate(sizes):
        rows.append((crawl, p, json.dumps([{"i": p * 1000 + k} for k in range(n)])))
    return spark.createDataFrame(rows, "crawl_id int, page_no int, body string")


def test_no_landed_page_is_left_out(spark):
    out = PG.crawl_items(_pages(spark, [100, 100, 37, 100]), limit=100)
    assert out.count() == 337 and out.where("truncated").count() == 0
    assert {r["page_no"] for r in out.where("after_end").collect()} == {3}


def test_endless_crawls_are_flagged(spark):
    out = PG.crawl_items(_pages(spark, [3] * 12), limit=3)
    assert out.count() == 36 and out.where("truncated").count() == 36


def test_rejected_pages_keep_their_text(spark):
    bodies = ['[1]', '{"data":[]}', '{"x":' + '1' * 400 + '}', '7', '[1', '[1] [2]']
    df = spark.createDataFrame(list(enumerate(bodies)), "page_no int, body string")
    got = {r["page_no"]: (r["reason"], r["raw"]) for r in PG.rejected_pages(df, ["page_no"]).collect()}
    assert got == {2: ("no_envelope_key", bodies[2]), 3: ("not_a_page", "7"), 4: ("bad_json", "[1"),
                   5: ("bad_json", "[1] [2]")}


def test_ingest_run_keeps_its_cursor_in_the_state(spark, scratch):
    items = spark.range(0, 250).select(F.col("id").alias("item_offset"))
    first = PG.ingest_run(spark, scratch, items, limit=120)
    cursor = ST.load_state(spark, scratch)["cursor"].first()
    assert first.count() == 120 and (cursor["item_offset"], cursor["completed"]) == (120, False)
    rest = PG.ingest_run(spark, scratch, items)
    assert rest.agg(F.min("item_offset"), F.max("item_offset")).first()[:] == (120, 249)
    assert ST.load_state(spark, scratch)["cursor"].first()["completed"]
    assert PG.ingest_run(spark, scratch, items).count() == 0
    assert PG.ingest_run(spark, scratch, items, reset=True).count() == 250


def test_resumable_ingest_limit_then_resume(spark):
    items = spark.range(0, 250).select(F.col("id").alias("item_offset"))
    run1 = PG.resumable_ingest(items, cursor=0, limit=250)
    pages = [r["n"] for r in run1.groupBy("page").agg(F.count("*").alias("n")).orderBy("page").collect()]
    assert pages == [100, 100, 50]
    first = PG.resumable_ingest(items, 0, limit=120)
    cur = PG.next_cursor(first, 0).first()["cursor"]
    rest = PG.resumable_ingest(items, cur)
    assert cur == 120 and first.count() + rest.count() == 250
    assert first.unionByName(rest).select("item_offset").distinct().count() == 250


def test_new_ids_and_union(spark):
    known = spark.createDataFrame([("a",)], "id string")
    now = spark.createDataFrame([("a",), ("b",), ("c",), ("",), (None,)], "id string")
    assert sorted(r["id"] for r in D.new_ids(now, known).collect()) == ["b", "c"]
    assert D.new_ids(known, known).count() == 0
    t1 = spark.createDataFrame([("m", "a", 1.0)], "kind string, id string, first_seen double")
    t2 = spark.createDataFrame([("m", "a", 0.5), ("m", "b", 2.0)], "kind string, id string, first_seen double")
    assert sorted(tuple(r) for r in D.id_union(t1, t2).collect()) == [("m", "a", 0.5), ("m", "b", 2.0)]


def test_chunks_5_by_2(spark):
    ids = spark.createDataFrame([(x,) for x in "abcde"], "id string")
    out = sorted(tuple(r) for r in D.chunk_ids(ids, "id", 2).select("id", "chunk_no", "initial").collect())
    assert out == [("a", 0, True), ("b", 0, True), ("c", 1, False), ("d", 1, False), ("e", 2, False)]
    again = D.chunk_ids(ids, "id", 2, previously_subscribed=True)
    assert again.where("initial").count() == 0


def test_merge_quotes_last_mid_wins(spark):
    prices = spark.createDataFrame([("t1", 0.5), ("t2", 0.6), ("t3", None)], "token_id string, price double")
    mids = spark.createDataFrame([("t1", 0.4, 1), ("t1", 0.45, 2), (None, 0.9, 3)], "token_id string, mid double, seq int")
    got = {r["token_id"]: r["midpoint"] for r in M.merge_quotes(prices, mids, ["seq"]).collect()}
    assert got == {"t1": 0.45, "t2": None, "t3": None}


def test_cadence_formula(spark):
    changes = [True, False, False, False, False, True]
    log = spark.createDataFrame([("p", i, c) for i, c in enumerate(changes)], "poller string, i int, changed boolean")
    out = MON.next_interval(log, "poller", ["i"], "changed", 60, 300).orderBy("i")
    assert [r["next_interval"] for r in out.collect()] == [60, 120, 240, 300, 300, 60]


def test_failure_streak_threshold(spark):
    log = spark.createDataFrame([("c", 0, True), ("c", 1, True), ("c", 2, True), ("c", 3, False), ("c", 4, True)],
                                "conn string, i int, failed boolean")
    out = MON.failure_streak(log, "conn", ["i"], "failed", threshold=3).orderBy("i").collect()
    assert [r["streak"] for r in out] == [1, 2, 3, 0, 1]
    assert [r["fallback"] for r in out] == [False, False, True, False, False]


def test_latest_per_key_and_top_n(spark):
    df = spark.createDataFrame([("a", 1.0, 1, "x"), ("a", 2.0, 0, "y"), ("a", 2.0, 5, "z"), ("b", 1.0, 0, "w")],
                               "id string, _fetched_at double, seq int, v string")
    got = {r["id"]: r["v"] for r in M.latest_per_key(df, ["id"], ["_fetched_at"], ["seq"]).collect()}
    assert got == {"a": "z", "b": "w"}
    top = M.top_n_per_group(df, ["id"], [F.desc("seq")], 2)
    assert top.where("id = 'a'").count() == 2


def test_book_quote(spark):
    df = spark.createDataFrame([([("0.40", "10"), ("0.45", "5")], [("0.55", "3"), ("0.50", "1")])],
                               "bids array<struct<price:string,size:string>>, asks array<struct<price:string,size:string>>")
    r = M.book_quote(df).first()
    assert float(r["best_bid"]) == 0.45 and float(r["best_ask"]) == 0.50
    assert float(r["midpoint"]) == 0.475 and abs(float(r["spread"]) - 0.05) < 1e-12
    assert float(r["bid_depth"]) == 6.25


def test_state_round_trip(spark, scratch):
    empty = ST.load_state(spark, scratch)
    assert empty["ids"].count() == 0
    ids = spark.createDataFrame([("market", "m1", 1.0), ("market", "m2", 1.0), ("token", "t1", 2.0)], ST.IDS_SCHEMA)
    lf = spark.createDataFrame([("markets", 1000.0)], ST.LAST_FETCH_SCHEMA)
    cur = spark.createDataFrame([("backfill", 5000, True)], ST.CURSOR_SCHEMA)
    assert ST.save_state(spark, scratch, {"ids": ids, "last_fetch": lf, "cursor": cur})
    assert not ST.save_state(spark, scratch, {"ids": ids, "last_fetch": lf, "cursor": cur})
    st = ST.load_state(spark, scratch)
    assert sorted(tuple(r) for r in st["ids"].collect()) == sorted(tuple(r) for r in ids.collect())
    assert st["cursor"].first()["item_offset"] == 5000 and st["cursor"].first()["completed"]
    assert st["last_fetch"].where("source = 'other'").count() == 0


def test_state_corrupt_pointer_is_empty(spark, scratch):
    for i, text in enumerate(["version: 3, tables", "[1,2,3]"]):
        inv.write_text_file(spark, f"{scratch}/_CURRENT-999999999999{i}-x", text)
        assert ST.load_state(spark, scratch)["ids"].count() == 0


def test_id_sets_are_saved_as_deltas(spark, scratch, monkeypatch):
    monkeypatch.setattr(ST, "MERGE_AFTER", 3)

    def save(rows):
        df = spark.createDataFrame(rows, ST.IDS_SCHEMA)
        changed = ST.save_state(spark, scratch, {"ids": df})
        got = sorted(tuple(r) for r in ST.load_state(spark, scratch)["ids"].collect())
        assert got == sorted(set(rows))
        parts = ST.read_pointer(spark, scratch)["tables"]["ids"]["parts"]
        return changed, len(parts), spark.read.parquet(f"{scratch}/{parts[-1]}").count()

    base = [("m", f"{i}", float(i)) for i in range(50)]
    assert save(base) == (True, 1, 50)
    assert save(base[::-1]) == (False, 1, 50)
    assert save(base + [("t", "0", 7.0)]) == (True, 2, 1)
    old = ST.read_pointer(spark, scratch)
    # one goes, one changes
    assert save(base[1:-1] + [("m", "49", 1.0), ("t", "0", 7.0)]) == (True, 3, 2)
    # one comes back; the deltas are full and become a base
    assert save(base[:-1] + [("m", "49", 1.0), ("t", "0", 7.0)]) == (True, 1, 51)
    assert save([]) == (True, 2, 51)
    assert save([("m", "x", None)]) == (True, 3, 1)
    assert old["tables"]["ids"]["parts"] != ST.read_pointer(spark, scratch)["tables"]["ids"]["parts"]


def test_id_given_twice_counts_with_its_earliest_sighting(spark, scratch):
    ids = spark.createDataFrame([("m", "a", 3.0), ("m", "a", 2.0), ("m", "b", None)], ST.IDS_SCHEMA)
    assert ST.save_state(spark, scratch, {"ids": ids})
    assert sorted(tuple(r) for r in ST.load_state(spark, scratch)["ids"].collect()) == [("m", "a", 2.0), ("m", "b", None)]
    assert not ST.save_state(spark, scratch, {"ids": ids})


def test_partial_save_keeps_the_other_tables(spark, scratch):
    ids = spark.createDataFrame([("m", "a", 1.0)], ST.IDS_SCHEMA)
    cur = spark.createDataFrame([("x", 3, False)], ST.CURSOR_SCHEMA)
    ST.save_state(spark, scratch, {"ids": ids, "cursor": cur})
    assert ST.save_state(spark, scratch, {"ids": ids.withColumn("first_seen", F.lit(2.0))})
    st = ST.load_state(spark, scratch)
    assert st["cursor"].first()["item_offset"] == 3 and st["ids"].first()["first_seen"] == 2.0


def test_sliding_rate_counts_bursts_across_a_second(spark):
    # 3 requests end a second, 3 begin the one ten seconds on, within 10 s of the last of them only
    times = [1_000_900_000, 1_000_950_000, 1_000_990_000, 1_010_800_000, 1_010_960_000, 1_010_980_000]
    log = spark.createDataFrame([("g", t) for t in times], "g string, us long").select(
        "g", F.timestamp_micros("us").alias("ts"))
    got = {r["sec"]: (r["n"], r["n_window"]) for r in MON.rate_audit(log, "g", "ts").collect()}
    best = max(sum(t - 10_000_000 < x <= t for x in times) for t in times[3:])
    assert got == {1000: (3, 3), 1010: (3, best)}


def test_book_quote_skips_bad_levels(spark):
    df = spark.createDataFrame([([("x", "1"), ("0.4", "10")], [("0.5", None), ("0.6", "2")])],
                               "bids array<struct<price:string,size:string>>, asks array<struct<price:string,size:string>>")
    r = M.book_quote(df).first()
    assert float(r["best_bid"]) == 0.4 and float(r["best_ask"]) == 0.6 and r["bad_levels"] == 2
    assert float(r["bid_depth"]) == 4.0 and float(r["ask_depth"]) == 1.2


def test_best_prices_and_book_quote_skip_the_same_levels(spark):
    levels = "array<struct<price:string,size:string>>"
    df = spark.createDataFrame([("t", 1, [("9", "big"), ("0.3", "1")], [("0.1", None), ("0.7", "2")]), ("u", 1, [], None)],
                               f"asset_id string, n int, bids {levels}, asks {levels}")
    quote = {r["asset_id"]: r for r in M.book_quote(df, keep=["asset_id"]).collect()}
    for field in ("best_bid", "best_ask", "midpoint", "spread"):
        assert M.token_quote(df, "t", field, ["n"]).first()[field] == quote["t"][field]
    assert quote["u"]["best_bid"] is None and quote["u"]["bad_levels"] == 0
    assert [tuple(x) for x in M.token_quote(df, "t", "book", ["n"]).first()["bids"]] == [("9", "big"), ("0.3", "1")]


def test_latest_of_stream_takes_the_registered_key(spark):
    df = spark.createDataFrame([("a", "0.1", 1.0), ("a", "0.2", 2.0), ("b", "0.3", 1.0)],
                               "token_id string, price string, _fetched_at double")
    got = {r["token_id"]: r["price"] for r in M.latest_of_stream(df, "clob/prices").collect()}
    assert got == {"a": "0.2", "b": "0.3"}


def test_run_length_hot_key_matches_sequential(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(2000):
        key = "hot" if rnd.random() < 0.9 else f"k{rnd.randint(0, 20)}"
        rows.append((key, i, rnd.random() < 0.7))
    df = spark.createDataFrame(rows, "k string, i int, f boolean")
    got = {(r["k"], r["i"]): r["run"] for r in MON.run_length(df, "k", ["i"], "f", num_blocks=8).collect()}
    expect, runs = {}, {}
    for k, i, f in rows:
        runs[k] = runs.get(k, 0) + 1 if f else 0
        expect[(k, i)] = runs[k]
    assert got == expect


def test_state_keeps_two_versions(spark, scratch):
    ids = spark.createDataFrame([("m", "a", 1.0)], ST.IDS_SCHEMA)
    for i in range(4):
        lf = spark.createDataFrame([("s", float(i))], ST.LAST_FETCH_SCHEMA)
        assert ST.save_state(spark, scratch, {"ids": ids, "last_fetch": lf})
    versions = [d for d in inv.list_dirs(spark, scratch) if "/v=" in d]
    # the last two of the changed table, and the first, where the unchanged one still lies
    assert len(versions) == 3
    assert ST.load_state(spark, scratch)["last_fetch"].first()["last_fetch"] == 3.0


def test_lookup_by_id_and_holders_of(spark):
    snaps = spark.createDataFrame([("m1", 1.0, "a"), ("m1", 2.0, "b"), ("m2", 3.0, "c")],
                                  "id string, _fetched_at double, q string")
    assert [tuple(r) for r in M.lookup_by_id(snaps, "id", "m1", ["_fetched_at"]).collect()] == [("m1", 2.0, "b")]
    holders = spark.createDataFrame(
        [("m1", [("w1", 5.0), ("w2", 3.0)]), ("m2", [("w3", 1.0)])],
        "condition_id string, holders array<struct<proxyWallet:string,amount:double>>")
    got = [(r["holder_no"], r["proxyWallet"]) for r in M.holders_of(holders, "m1", ["condition_id"]).collect()]
    assert sorted(got) == [(0, "w1"), (1, "w2")]
