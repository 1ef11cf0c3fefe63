"""Compaction by claims, merging of runs, retention.

Fixed clock: 2031-11-19T06:45:00Z, so 05 is the last closed hour of the day.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from files import set_mtime
from quaylake.operators import compact as CP
from quaylake.operators import runlog as RL
from quaylake.operators.land import land_lines
from quaylake.sources import inventory as inv
from quaylake.sources.tables import scan_table

NOW = dt.datetime(2031, 11, 19, 6, 45, tzinfo=dt.timezone.utc)
DDL = "id STRING, value BIGINT"
BERTHS = "berth STRING, draught DOUBLE"


def put(spark, root, rel, lines):
    inv.write_text_file(spark, f"{root}/raw/{rel}", "".join(line + "\n" for line in lines))


def status(report):
    return {r["path"].rsplit("/raw/", 1)[1]: r["status"] for r in report.collect()}


def test_closed_hour_compacts_and_source_goes(spark, scratch):
    put(spark, scratch, "harbour/berths/2031-11-19T05.jsonl",
        ['{"berth":"north quay","draught":9.5,"pilot":"K"}', '{"_source":"radio","berth":"mole"}',
         '{"berth":"basin 3","draught":"deep"}'])
    rep = CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW, ddl={"harbour/berths": BERTHS})
    assert status(rep) == {"harbour/berths/2031-11-19T05.jsonl": "compacted"}
    rows = scan_table(spark, f"{scratch}/table", "harbour/berths").collect()
    assert {r["berth"]: r["draught"] for r in rows} == {"north quay": 9.5, "mole": None, "basin 3": None}
    assert {(r["dt"], r["hour"]) for r in rows} == {("2031-11-19", "05")}
    assert {r["berth"]: r["_cast_errors"] for r in rows}["basin 3"] == ["draught"]
    assert not inv.list_files(spark, f"{scratch}/raw")


def test_open_labels_are_left_alone(spark, scratch):
    put(spark, scratch, "tides/2031-11-19T06.jsonl", ['{"m":2}'])
    put(spark, scratch, "pilots/2031-11-19.jsonl", ['{"m":3}'])
    put(spark, scratch, "tides/2031-11-19T07.jsonl", [])
    rep = CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW)
    assert status(rep) == {"tides/2031-11-19T06.jsonl": "current", "pilots/2031-11-19.jsonl": "current",
                           "tides/2031-11-19T07.jsonl": "future"}
    assert len(inv.list_files(spark, f"{scratch}/raw")) == 3


def test_empty_files_go_without_a_table(spark, scratch):
    put(spark, scratch, "tides/2031-11-18T22.jsonl", [])
    put(spark, scratch, "logs/label=2031-11-18T22/void.json", [])
    inv.log_files(spark.createDataFrame([(f"{scratch}/raw/logs/label=2031-11-18T22/void.json", 0, 5)],
                                        "path string, size long, mtime_ms long"), f"{scratch}/raw", "w1")
    rep = CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW)
    assert status(rep) == {"tides/2031-11-18T22.jsonl": "empty", "logs/label=2031-11-18T22/void.json": "empty"}
    assert not inv.list_files(spark, f"{scratch}/raw") and not inv.exists(spark, f"{scratch}/table/tides")
    # the log forgets what is gone
    assert inv.logged_files(spark, f"{scratch}/raw").count() == 0


def test_daily_label_goes_to_hour_00(spark, scratch):
    put(spark, scratch, "pilots/2031-11-18.jsonl", ['{"tag":"harbour"}'])
    CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW)
    r = scan_table(spark, f"{scratch}/table", "pilots").select(
        "dt", "hour", F.variant_get(F.col("_extra")["tag"], "$", "string").alias("tag")).first()
    assert (r["dt"], r["hour"], r["tag"]) == ("2031-11-18", "00", "harbour")


def test_two_streams_and_missing_dir(spark, scratch):
    rep = CP.compact(spark, f"{scratch}/nothing", f"{scratch}/table", now=NOW)
    assert rep.count() == 0
    put(spark, scratch, "a/2031-11-19T04.jsonl", ['{"id":"1"}'])
    put(spark, scratch, "b/2031-11-19T04.jsonl", ['{"id":"2"}'])
    rep = CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW)
    assert rep.where(F.col("status") == "compacted").count() == 2


def test_bad_lines_quarantined_and_stray_stem_reported(spark, scratch):
    put(spark, scratch, "s/2031-11-19T03.jsonl", ['{"id":"1","value":5}', '{"id":"2"', "", "3"])
    put(spark, scratch, "s/old.jsonl", ['{"id":"9"}'])
    rep = CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW, ddl={"s": DDL})
    st = {r["path"].rsplit("/", 1)[1]: (r["status"], r["rows"], r["corrupt"]) for r in rep.collect()}
    assert st["2031-11-19T03.jsonl"] == ("compacted", 1, 2)
    assert st["old.jsonl"][0] == "bad_label"
    q = spark.read.parquet(f"{scratch}/table/{CP.QUARANTINE_DIR}/s")
    assert sorted(r["raw"] for r in q.collect()) == ['3', '{"id":"2"']


def test_rerun_is_noop_and_late_file_adds_slice(spark, scratch):
    put(spark, scratch, "s/2031-11-19T02.jsonl", ['{"id":"1","value":1}'])
    CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW, ddl={"s": DDL})
    again = CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW, ddl={"s": DDL})
    assert again.count() == 0
    # the same label is re-created after compaction: a new slice, nothing overwritten
    put(spark, scratch, "s/2031-11-19T02.jsonl", ['{"id":"2","value":2}'])
    CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW, ddl={"s": DDL})
    t = scan_table(spark, f"{scratch}/table", "s", keep_src=True)
    assert sorted(r["id"] for r in t.collect()) == ["1", "2"]
    assert t.select("src").distinct().count() == 2


def test_files_of_an_hour_become_one(spark, scratch):
    for i in range(6):
        put(spark, scratch, f"s/label=2031-11-19T02/part-{i}.json", [f'{{"id":"{i}","value":{i}}}'])
    rep = CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW, ddl={"s": DDL})
    assert rep.where("status = 'compacted' AND rows = 1").count() == 6
    assert len(inv.list_files(spark, f"{scratch}/table/s", (".parquet",))) == 1


def interrupted(monkeypatch, name):
    """Stop a job where it would call ``CP.<name>``."""
    def stop(*args, **kwargs):
        raise KeyboardInterrupt(name)
    monkeypatch.setattr(CP, name, stop)


@pytest.mark.parametrize("step", ["_claim", "_write_rows", "_list_run", "_finish"])
def test_interrupted_run_is_finished_under_its_own_id(spark, scratch, monkeypatch, step):
    args = (spark, f"{scratch}/raw", f"{scratch}/table")
    put(spark, scratch, "s/label=2031-11-19T02/a.json", ['{"id":"1","value":1}', "x"])
    with monkeypatch.context() as m:
        interrupted(m, step)
        with pytest.raises(KeyboardInterrupt):
            CP.compact(*args, now=NOW, ddl={"s": DDL})
    run = next(iter(RL.snapshot(spark, f"{scratch}/table").runs))
    if step != "_finish":
        assert scan_table(spark, f"{scratch}/table", "s").count() == 0, "rows of an unfinished run are seen"
    put(spark, scratch, "s/label=2031-11-19T02/b.json", ['{"id":"2","value":2}'])
    put(spark, scratch, "s/label=2031-11-19T03/c.json", ['{"id":"3","value":3}'])
    CP.compact(*args, now=NOW, ddl={"s": DDL})
    t = scan_table(spark, f"{scratch}/table", "s", keep_src=True).collect()
    assert sorted(r["id"] for r in t) == ["1", "2", "3"]
    assert {r["run"] for r in t if r["id"] == "1"} == {run}
    assert spark.read.parquet(f"{scratch}/table/{CP.QUARANTINE_DIR}/s").count() == 1
    assert not inv.list_files(spark, f"{scratch}/raw") and not RL.snapshot(spark, f"{scratch}/table").runs


def test_claims_are_renames_of_folders_and_late_files_survive(spark, scratch, monkeypatch):
    for hour in ("02", "03"):
        for i in range(5):
            put(spark, scratch, f"s/label=2031-11-19T{hour}/part-{i}.json", [f'{{"id":"{hour}{i}","value":{i}}}'])
    calls = {"rename": 0, "delete": 0}
    rename, delete, claim = inv.rename, inv.delete_paths, CP._claim

    def count_rename(*args):
        calls["rename"] += 1
        return rename(*args)

    def count_delete(spark, paths, recursive=False):
        paths = list(paths)
        calls["delete"] += sum(CP.CLAIMED_DIR in p or "/s/" in p for p in paths)
        return delete(spark, paths, recursive)

    def claim_then_land(*args):
        had = claim(*args)
        put(spark, scratch, "s/label=2031-11-19T02/late.json", ['{"id":"late","value":9}'])
        return had
    monkeypatch.setattr(inv, "rename", count_rename)
    monkeypatch.setattr(inv, "delete_paths", count_delete)
    monkeypatch.setattr(CP, "_claim", claim_then_land)
    rep = CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW, ddl={"s": DDL})
    assert rep.where("status = 'compacted' AND rows = 1").count() == 10
    assert calls == {"rename": 2, "delete": 1}
    assert [p.rsplit("/", 1)[1] for p, _, _ in inv.list_files(spark, f"{scratch}/raw")] == ["late.json"]
    monkeypatch.setattr(CP, "_claim", claim)
    CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW, ddl={"s": DDL})
    assert scan_table(spark, f"{scratch}/table", "s").count() == 11


def test_report_reads_no_partition_of_earlier_runs(spark, scratch):
    put(spark, scratch, "s/2031-11-19T02.jsonl", ['{"id":"1","value":1}'])
    CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW, ddl={"s": DDL})
    # a file no reader could open
    old = [d for d in inv.folders_of(spark, f"{scratch}/table/s")][0]
    inv.write_text_file(spark, f"{old}/part-broken.parquet", "no parquet")
    put(spark, scratch, "s/2031-11-19T02.jsonl", ['{"id":"2","value":1}', "{"])
    rep = CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW, ddl={"s": DDL}).collect()
    assert [(r["rows"], r["corrupt"]) for r in rep] == [(1, 1)]


def test_labels_of_an_unfinished_batch_wait(spark, scratch):
    raw = f"{scratch}/raw"
    for label, batch in (("2031-11-19T02", "b1"), ("2031-11-19T03", "b2")):
        lines = spark.createDataFrame([(label, f'{{"id":"{batch}","value":1}}')], "label string, value string")
        land_lines(lines, raw, "s", batch=batch)
    # b2 as it is before its end
    inv.rename(spark, f"{raw}/{inv.LANDED_DIR}/done/s/b2", f"{raw}/{inv.LANDED_DIR}/open/s/b2")
    rep = CP.compact(spark, raw, f"{scratch}/table", now=NOW, ddl={"s": DDL})
    assert sorted(r["status"] for r in rep.collect()) == ["compacted", "landing"]
    land_lines(lines, raw, "s", batch="b2")
    land_lines(lines, raw, "s", batch="b2")
    CP.compact(spark, raw, f"{scratch}/table", now=NOW, ddl={"s": DDL})
    land_lines(lines, raw, "s", batch="b2")
    CP.compact(spark, raw, f"{scratch}/table", now=NOW, ddl={"s": DDL})
    assert sorted(r["id"] for r in scan_table(spark, f"{scratch}/table", "s").collect()) == ["b1", "b2"]


# ---------------------------------------------------------------- merging
def three_runs(spark, root, hours=("02", "03")):
    for i in range(3):
        for hour in hours:
            put(spark, root, f"s/2031-11-19T{hour}.jsonl", [f'{{"id":"{hour}-{i}-{k}","value":{k},"x":[{i}]}}' for k in range(4)])
        CP.compact(spark, f"{root}/raw", f"{root}/table", now=NOW, ddl={"s": DDL})


def ids(spark, root):
    return sorted(r["id"] for r in scan_table(spark, f"{root}/table", "s").collect())


def test_merge_leaves_one_file_an_hour_and_readers_see_rows_once(spark, scratch, monkeypatch):
    three_runs(spark, scratch)
    table, want = f"{scratch}/table", [f"{h}-{i}-{k}" for h in ("02", "03") for i in range(3) for k in range(4)]
    before = scan_table(spark, table, "s", keep_src=True).select("id", "src", "_extra").collect()
    seen = []
    set_state = RL.set_state

    def look(spark, root, run, state, **more):
        seen.append(ids(spark, scratch))
        out = set_state(spark, root, run, state, **more)
        seen.append(ids(spark, scratch))
        return out
    monkeypatch.setattr(RL, "set_state", look)
    assert CP.merge_hours(spark, table, "s").count() == 6
    assert CP.vacuum(spark, table) == 6
    assert len(seen) == 6 and all(s == want for s in seen)
    assert len(inv.list_files(spark, f"{table}/s", (".parquet",))) == 2
    after = scan_table(spark, table, "s", keep_src=True).select("id", "src", "_extra").collect()
    assert sorted((r["id"], r["src"], str(r["_extra"])) for r in after) == \
        sorted((r["id"], r["src"], str(r["_extra"])) for r in before)
    assert CP.merge_hours(spark, table, "s").count() == 0 and not RL.snapshot(spark, table).runs


def test_merge_chooses_by_size(spark):
    sizes = spark.createDataFrame(
        [("d1", "00", "a", 1, 900), ("d1", "00", "b", 2, 30), ("d1", "00", "c", 1, 40),   # a is large enough
         ("d1", "01", "a", 1, 60), ("d1", "01", "b", 1, 60),                             # two files either way
         ("d1", "02", "a", 1, 10),                                                       # alone
         ("d2", "00", "a", 40, 400), ("d2", "01", "a", 1, 99), ("d2", "01", "b", 1, 1)],
        "dt string, hour string, run string, files long, bytes long")
    got = {(r["dt"], r["hour"], r["run"]): r["n_out"] for r in CP.merge_plan(sizes, 100).collect()}
    assert got == {("d1", "00", "b"): 1, ("d1", "00", "c"): 1, ("d2", "00", "a"): 4, ("d2", "01", "a"): 1, ("d2", "01", "b"): 1}
    assert {k[0] for k in CP.merge_plan(sizes, 100, before="d2").select("dt").collect()} == {"d1"}


def test_merge_cuts_a_large_hour_into_files_of_the_target(spark, scratch):
    for run in range(2):
        put(spark, scratch, "s/2031-11-19T02.jsonl", [f'{{"id":"{run}-{k}","value":{k}}}' for k in range(3000)])
        CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW, ddl={"s": DDL})
    total = CP.partition_sizes(spark, f"{scratch}/table", "s").agg(F.sum("bytes").alias("b")).first()["b"]
    # the two files are below the target and together above it: no file would be saved
    assert CP.merge_hours(spark, f"{scratch}/table", "s", target_bytes=total * 2 // 3).count() == 0
    assert CP.merge_hours(spark, f"{scratch}/table", "s", target_bytes=total * 2).count() == 2
    assert len(ids(spark, scratch)) == len(set(ids(spark, scratch))) == 6000


@pytest.mark.parametrize("resume", ["merge", "compact"])
def test_interrupted_merge_is_finished(spark, scratch, monkeypatch, resume):
    three_runs(spark, scratch, ("02",))
    table, want = f"{scratch}/table", ids(spark, scratch)
    set_state = RL.set_state

    def stop_at_commit(spark, root, run, state, **more):
        if state == RL.COMMITTED:
            raise KeyboardInterrupt
        return set_state(spark, root, run, state, **more)
    with monkeypatch.context() as m:
        m.setattr(RL, "set_state", stop_at_commit)
        with pytest.raises(KeyboardInterrupt):
            CP.merge_hours(spark, table, "s")
    assert ids(spark, scratch) == want
    if resume == "merge":
        CP.merge_hours(spark, table, "s")
    else:
        CP.compact(spark, f"{scratch}/raw", table, now=NOW, ddl={"s": DDL})
    assert ids(spark, scratch) == want
    CP.vacuum(spark, table)
    assert ids(spark, scratch) == want and len(inv.list_files(spark, f"{table}/s", (".parquet",))) == 1


def test_run_log_survives_a_version_that_is_being_written(spark, scratch):
    RL.set_state(spark, scratch, "r1", RL.RECORDED, kind="compact")
    inv.write_text_file(spark, f"{scratch}/{RL.LOG_DIR}/{2:012d}.json", '{"version": 2, "ru')
    assert list(RL.snapshot(spark, scratch).runs) == ["r1"]
    at = RL.set_state(spark, scratch, "r2", RL.RECORDED, kind="merge")
    assert at.version == 3 and sorted(RL.snapshot(spark, scratch).runs) == ["r1", "r2"]
    for i in range(15):
        RL.set_state(spark, scratch, "r1", RL.COMMITTED, n=i)
    assert len(inv.child_names(spark, f"{scratch}/{RL.LOG_DIR}")) <= RL.KEEP_VERSIONS + 2
    RL.set_state(spark, scratch, "r1", None)
    assert list(RL.snapshot(spark, scratch).runs) == ["r2"]


def test_kept_sources_go_with_the_raw_retention(spark, scratch):
    args = (spark, f"{scratch}/raw", f"{scratch}/table")
    put(spark, scratch, "s/label=2031-11-19T02/a.json", ['{"id":"1","value":1}'])
    CP.compact(*args, now=NOW, ddl={"s": DDL}, delete_sources=False)
    assert CP.compact(*args, now=NOW, ddl={"s": DDL}).count() == 0
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=30)
    assert CP.purge_raw(*args, now=later, keep_hours=48) == 0 and inv.child_names(spark, f"{scratch}/raw/{CP.CLAIMED_DIR}")
    assert CP.purge_raw(*args, now=later, keep_hours=24) == 1 and not inv.child_names(spark, f"{scratch}/raw/{CP.CLAIMED_DIR}")
    assert scan_table(spark, f"{scratch}/table", "s").count() == 1


def test_forced_purge_takes_whole_labels(spark, scratch):
    now_ms = int(dt.datetime.now(dt.timezone.utc).timestamp() * 1000)
    for name, age in (("label=2031-11-19T02/a", 90), ("label=2031-11-19T02/b", 80), ("label=2031-11-19T03/a", 90),
                      ("label=2031-11-19T03/b", 1)):
        put(spark, scratch, f"s/{name}.json", ["{}"])
        set_mtime(spark, f"{scratch}/raw/s/{name}.json", now_ms - age * 3600 * 1000)
    assert CP.purge_raw(spark, f"{scratch}/raw", f"{scratch}/table", keep_hours=48, force=True) == 1
    assert {f.rsplit("/", 1)[1] for f in inv.folders_of(spark, f"{scratch}/raw")} == {"label=2031-11-19T03"}


def test_blank_file_and_odd_roots(spark, scratch):
    put(spark, f"{scratch}/a b", "s/2031-11-19T02.jsonl", ["", "  "])
    put(spark, f"{scratch}/a b", "raw/s/2031-11-19T01.jsonl", ['{"id":"1","value":1}'])
    rep = CP.compact(spark, f"{scratch}/a b/raw", f"{scratch}/table", now=NOW, ddl={"s": DDL, "raw/s": DDL})
    assert {(r["stream"], r["rows"]) for r in rep.collect()} == {("s", 0), ("raw/s", 1)}
    assert not inv.list_files(spark, f"{scratch}/a b/raw")


def test_changed_type_of_an_undeclared_key(spark, scratch):
    for value in ("1", '"x"'):
        put(spark, scratch, "loose/2031-11-19T02.jsonl", [f'{{"v":{value}}}'])
        CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW)
    got = scan_table(spark, f"{scratch}/table", "loose").select(F.to_json(F.col("_extra")["v"]).alias("v")).collect()
    assert sorted(r["v"] for r in got) == ['"x"', "1"]


def test_raw_retention(spark, scratch):
    put(spark, scratch, "test/stale.jsonl", ['{"id":"1"}'])
    put(spark, scratch, "test/fresh.jsonl", ['{"id":"2"}'])
    now_ms = int(dt.datetime.now(dt.timezone.utc).timestamp() * 1000)
    set_mtime(spark, f"{scratch}/raw/test/stale.jsonl", now_ms - 48 * 3600 * 1000)
    gone = CP.purge_raw(spark, f"{scratch}/raw", f"{scratch}/table", keep_hours=24, force=True)
    assert gone == 1 and not inv.exists(spark, f"{scratch}/raw/test/stale.jsonl")
    assert inv.exists(spark, f"{scratch}/raw/test/fresh.jsonl")


def test_uncompacted_expired_file_kept_without_force(spark, scratch):
    put(spark, scratch, "test/stale.jsonl", ['{"id":"1"}'])
    now_ms = int(dt.datetime.now(dt.timezone.utc).timestamp() * 1000)
    set_mtime(spark, f"{scratch}/raw/test/stale.jsonl", now_ms - 72 * 3600 * 1000)
    assert CP.purge_raw(spark, f"{scratch}/raw", f"{scratch}/table", keep_hours=48) == 0


def test_table_retention_by_dt(spark, scratch):
    put(spark, scratch, "s/2030-01-01T01.jsonl", ['{"id":"1","value":1}'])
    put(spark, scratch, "s/2031-03-01T01.jsonl", ['{"id":"2","value":2}'])
    CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW, ddl={"s": DDL})
    gone = CP.purge_table(spark, f"{scratch}/table", "s", now=NOW, keep_days=365)
    assert gone == 1
    assert [r["id"] for r in scan_table(spark, f"{scratch}/table", "s").collect()] == ["2"]


def test_table_retention_by_mtime(spark, scratch):
    put(spark, scratch, "s/2031-03-01T01.jsonl", ['{"id":"1","value":1}'])
    put(spark, scratch, "s/2031-03-01T02.jsonl", ['{"id":"2","value":2}'])
    CP.compact(spark, f"{scratch}/raw", f"{scratch}/table", now=NOW, ddl={"s": DDL})
    files = [p for p, _, _ in inv.list_files(spark, f"{scratch}/table/s", (".parquet",))]
    old = [p for p in files if "hour=01" in p]
    now_ms = int(dt.datetime.now(dt.timezone.utc).timestamp() * 1000)
    for p in old:
        set_mtime(spark, p, now_ms - 400 * 86400 * 1000)
    gone = CP.purge_table(spark, f"{scratch}/table", "s", keep_days=365, by="mtime")
    assert gone == len(old) == 1
    assert [r["id"] for r in scan_table(spark, f"{scratch}/table", "s").collect()] == ["2"]


def test_scan_of_uncompacted_stream_is_empty(spark, scratch):
    t = scan_table(spark, f"{scratch}/table", "clob/prices")
    assert t.count() == 0
    assert t.columns[:3] == ["_fetched_at", "_source", "token_id"] and t.columns[-2:] == ["dt", "hour"]
