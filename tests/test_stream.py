"""Batch = stream equivalence for frame routing, recovery and list frames."""

import base64

from pyspark.sql import functions as F

from quaylake.operators.route import decode_frames, routed_lines
from quaylake.sources import inventory as inv
from quaylake.streaming import jobs as S

FRAMES = [
    ("ws_market", '[{"asset_id":"tok-9","bids":[],"asks":[]}]', 1772800000.0),
    ("ws_market", "[]", 1772800001.0),
    ("ws_market", '{"market":"pier","price_changes":[{"p":0.125}]}', 1772800002.0),
    ("ws_market", '{"market":"pier","last_trade_price":0.75}', 1772800003.0),
    ("ws_market", " PONG ", 1772800004.0),
    ("ws_market", "pong" + "!" * 500, 1772800005.0),
    ("ws_sports", "ping", 1772800006.0),
    ("ws_sports", '{"match":41}', 1772800007.0),
    ("ws_rtds", '{"channel":"crypto_prices","p":1}', 1772800008.0),
    ("ws_rtds", '{"channel":"activity"}', 1772800009.0),
    ("ws_rtds", '[{"channel":"activity"}]', 1772800010.0),
]


def batch_result(spark):
    df = spark.createDataFrame(FRAMES, S.FRAME_SCHEMA)
    return sorted((r["stream"], r["line"]) for r in routed_lines(decode_frames(df)).collect())


def test_routing_cases(spark):
    df = spark.createDataFrame(FRAMES, S.FRAME_SCHEMA)
    dec = decode_frames(df).collect()
    streams = sorted(r["stream"] for r in dec if r["stream"])
    assert streams == ["ws_market/book", "ws_market/last_trade_price", "ws_market/price_change",
                       "ws_rtds/activity", "ws_rtds/crypto_prices", "ws_sports/events"]
    reasons = sorted(r["reason"] for r in dec if r["reason"])
    assert reasons == ["bad_json", "list_not_supported"]
    lines = dict((r["stream"], r["line"]) for r in routed_lines(decode_frames(df)).collect())
    assert '"_source":"ws_sports"' in lines["ws_sports/events"]
    assert '"_source":"ws_rtds"' in lines["ws_rtds/activity"]
    assert '"_source":"ws_market/book"' in lines["ws_market/book"]


def test_stream_equals_batch_and_recovers(spark, scratch):
    frames = spark.createDataFrame(FRAMES, S.FRAME_SCHEMA)
    S.land_frames(frames.where(F.col("_fetched_at") < 1772800005.0).coalesce(1), f"{scratch}/frames")
    args = (spark, f"{scratch}/frames", f"{scratch}/raw", f"{scratch}/q", f"{scratch}/ckpt")
    S.route_stream(*args, max_files_per_trigger=1).awaitTermination()
    S.land_frames(frames.where(F.col("_fetched_at") >= 1772800005.0).coalesce(1), f"{scratch}/frames")
    S.route_stream(*args, max_files_per_trigger=1).awaitTermination()
    got = sorted((r["stream"], r["line"]) for r in S.read_routed(spark, f"{scratch}/raw").collect())
    assert got == batch_result(spark)
    q = spark.read.parquet(f"{scratch}/q")
    assert sorted(r["raw"] for r in q.collect()) == sorted([FRAMES[5][1], FRAMES[10][1]])


def test_replayed_epoch_is_idempotent(spark, scratch):
    frames = spark.createDataFrame(FRAMES, S.FRAME_SCHEMA)
    S.route_batch(frames, 7, f"{scratch}/raw", f"{scratch}/q")
    S.route_batch(frames, 7, f"{scratch}/raw", f"{scratch}/q")
    got = sorted((r["stream"], r["line"]) for r in S.read_routed(spark, f"{scratch}/raw").collect())
    assert got == batch_result(spark)


def test_two_streams_share_a_root(spark, scratch):
    frames = spark.createDataFrame(FRAMES, S.FRAME_SCHEMA)
    for name in ("a", "b"):
        S.route_batch(frames, 0, f"{scratch}/raw", f"{scratch}/q", stream=name)
    got = sorted((r["stream"], r["line"]) for r in S.read_routed(spark, f"{scratch}/raw").collect())
    assert got == sorted(batch_result(spark) * 2)
    assert S.stream_id("/x/ckpt") == S.stream_id("/x/ckpt/") != S.stream_id("/y/ckpt")


def land_ids(spark, root, ids, at):
    rows = [("ws_market", '{"user":"%s"}' % i, at + n) for n, i in enumerate(ids)]
    S.land_frames(spark.createDataFrame(rows, S.FRAME_SCHEMA).coalesce(1), f"{root}/frames")


def new_ids(spark, root, **options):
    q = S.new_ids_stream(spark, f"{root}/frames", f"{root}/out", f"{root}/ckpt", **options)
    q.awaitTermination()
    return sum(p["numInputRows"] for p in q.recentProgress)


def test_new_ids_are_never_forgotten_or_repeated(spark, scratch):
    for run in range(3):
        land_ids(spark, scratch, [i % 5 + run for i in range(20)], 1772800000.0 + run * 10**6)
        # what is known does not count among the rows read
        assert new_ids(spark, scratch) == 20
    out = S.read_new_ids(spark, f"{scratch}/out").collect()
    assert sorted(r["id"] for r in out) == ["0", "1", "2", "3", "4", "5", "6"]
    assert min(r["first_seen"] for r in out).timestamp() == 1772800000.0
    # an id's first sighting is the earliest of its micro-batch
    assert {r["id"]: r["first_seen"].timestamp() for r in out}["6"] == 1772800000.0 + 2 * 10**6 + 4


def test_ids_of_a_table_are_not_new(spark, scratch):
    known = spark.createDataFrame([("k1",), ("k2",)], "id string").withColumn("first_seen", F.timestamp_seconds(F.lit(1)))
    known.coalesce(1).write.parquet(f"{scratch}/known")
    land_ids(spark, scratch, ["k1", "a"], 1772800000.0)
    assert new_ids(spark, scratch, known_path=f"{scratch}/known") == 4
    # the table grows between the runs
    known.where("id = 'k1'").withColumn("id", F.lit("k3")).coalesce(1).write.mode("append").parquet(f"{scratch}/known")
    land_ids(spark, scratch, ["k2", "a", "b", "k3"], 1772900000.0)
    assert new_ids(spark, scratch, known_path=f"{scratch}/known") == 5
    assert sorted(r["id"] for r in S.read_new_ids(spark, f"{scratch}/out").collect()) == ["a", "b"]
    land_ids(spark, scratch, ["a"], 1773000000.0)
    new_ids(spark, scratch, known_path=f"{scratch}/known")
    assert len([n for n in inv.child_names(spark, f"{scratch}/out") if n.startswith("slice=")]) == 2


def test_late_rows_are_counted_in_a_later_slice(spark, scratch):
    def run(times):
        rows = [("ws_sports", '{"n":1}', float(t)) for t in times]
        S.land_frames(spark.createDataFrame(rows, S.FRAME_SCHEMA).coalesce(1), f"{scratch}/frames")
        S.hourly_stream(spark, f"{scratch}/frames", f"{scratch}/out", f"{scratch}/ckpt").awaitTermination()
    hour = 1772798400
    run([hour, hour + 1, hour + 3 * 3600])
    run([hour + 2, hour + 3 * 3600 + 1])
    got = sorted(tuple(r)[2:] for r in S.hourly_counts(spark, f"{scratch}/out").orderBy("label").collect())
    assert got == [(2, 0), (3, 1)]


def test_processing_time_trigger(spark, scratch):
    frames = spark.createDataFrame(FRAMES, S.FRAME_SCHEMA)
    S.land_frames(frames.coalesce(1), f"{scratch}/frames")
    q = S.route_stream(spark, f"{scratch}/frames", f"{scratch}/raw", f"{scratch}/q", f"{scratch}/ckpt",
                       available_now=False, interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r["stream"], r["line"]) for r in S.read_routed(spark, f"{scratch}/raw").collect())
    assert got == batch_result(spark)


HOUR0 = 1772798400


def hours(spark, root, times, name="x", delay_s=0):
    rows = [("ws_sports", '{"n":1}', float(HOUR0 + t)) for t in times]
    S.land_frames(spark.createDataFrame(rows, S.FRAME_SCHEMA).coalesce(1), f"{root}/frames-{name}")
    S.hourly_stream(spark, f"{root}/frames-{name}", f"{root}/counts", f"{root}/ckpt-{name}", delay_s=delay_s).awaitTermination()


def close(spark, root, name="x", delay_s=0):
    S.closed_hours_stream(spark, f"{root}/counts", f"{root}/ckpt-{name}", f"{root}/closed", f"{root}/ckpt-closed-{name}",
                          delay_s=delay_s).awaitTermination()
    out = S.read_closed_hours(spark, f"{root}/closed").collect()
    return sorted((r["label"][-2:], r["n"]) for r in out)


def late(spark, root):
    return sorted((r["label"][-2:], r["n"]) for r in S.read_counts(spark, f"{root}/counts").where("late").collect())


def test_hours_are_emitted_once_as_the_watermark_passes(spark, scratch):
    # hours 12 and 13 begin; nothing is over but 12
    hours(spark, scratch, [5, 10, 3600])
    assert close(spark, scratch) == [("12", 2)]
    # more of 13, and one row for 12, which is too late now
    hours(spark, scratch, [3700, 20])
    assert close(spark, scratch) == [("12", 2)] and late(spark, scratch) == [("12", 1)]
    # 15 begins: 13 is over
    hours(spark, scratch, [3 * 3600 + 1])
    assert close(spark, scratch) == [("12", 2), ("13", 2)]
    assert close(spark, scratch) == [("12", 2), ("13", 2)]
    total = S.hourly_counts(spark, f"{scratch}/counts").agg(F.sum("n").alias("n")).first()["n"]
    assert total == 6


def test_a_delay_keeps_hours_open(spark, scratch):
    hours(spark, scratch, [0, 3600 + 500], delay_s=600)
    assert close(spark, scratch, delay_s=600) == []
    hours(spark, scratch, [30, 3600 + 600], delay_s=600)
    assert close(spark, scratch, delay_s=600) == [("12", 2)]
    hours(spark, scratch, [31], delay_s=600)
    assert late(spark, scratch) == [("12", 1)]


def test_streams_on_one_folder_have_their_own_marks(spark, scratch):
    hours(spark, scratch, [3 * 3600], name="fast")
    hours(spark, scratch, [3600, 60], name="slow")
    assert late(spark, scratch) == []
    hours(spark, scratch, [70], name="slow")
    hours(spark, scratch, [2 * 3600], name="fast")
    assert late(spark, scratch) == [("12", 1), ("14", 1)]
    assert close(spark, scratch, "slow") == [("12", 1)]


def test_replayed_epoch_of_counts_is_published_once(spark, scratch):
    frames = spark.createDataFrame([("ws_sports", '{"n":1}', float(HOUR0))], S.FRAME_SCHEMA)
    for epoch in (0, 1, 1, 0):
        S.count_batch(frames, epoch, scratch, "s")
    assert S.hourly_counts(spark, scratch).first()["n"] == 2
    assert S.high_water(spark, scratch, "s", 2) == HOUR0 and S.high_water(spark, scratch, "s", 0) is None


def test_empty_micro_batches_write_nothing(spark, scratch):
    control = spark.createDataFrame([("ws_sports", " ping ", 1.0), ("ws_market", "[]", 2.0)], S.FRAME_SCHEMA)
    S.route_batch(control, 0, f"{scratch}/raw", f"{scratch}/q")
    S.count_batch(control, 0, f"{scratch}/counts", "s")
    assert not inv.exists(spark, f"{scratch}/raw") and not inv.exists(spark, f"{scratch}/q")
    assert [n for n in inv.child_names(spark, f"{scratch}/counts") if n.startswith("slice=")] == []
    assert S.read_counts(spark, f"{scratch}/counts").count() == 0


def test_byte_frames(spark):
    rows = [("ws_sports", b'{"match":"\xc3\xa9t\xc3\xa9"}', 1.0), ("ws_sports", b'{"match":"\xff"}', 2.0),
            ("ws_sports", b"pong", 3.0), ("ws_market", b'[{"a":1},2]', 4.0), ("ws_rtds", None, 5.0),
            ("ws_market", b"\xed\xa0\x80", 6.0)]
    got = decode_frames(spark.createDataFrame(rows, S.PAYLOAD_SCHEMA)).orderBy("_fetched_at", "elem_no").collect()
    assert [(r["_fetched_at"], r["stream"], r["reason"]) for r in got] == [
        (1.0, "ws_sports/events", None), (2.0, None, "bad_utf8"), (4.0, "ws_market/book", None), (4.0, None, "not_object"),
        (5.0, None, "bad_json"), (6.0, None, "bad_utf8")]
    assert got[0]["elem"] == '{"match":"été"}'
    assert base64.b64decode(got[1]["raw"]) == rows[1][1] and got[1]["preview"].startswith('{"match":"')


def test_a_frame_is_parsed_once(spark):
    frames = spark.createDataFrame(FRAMES, S.FRAME_SCHEMA)
    plan = routed_lines(decode_frames(frames))._jdf.queryExecution().optimizedPlan().toString()
    # one expression has the parser's input three times, which code generation computes once
    assert plan.count("parseJson(concat([") == 3 and "json_object_keys" not in plan
