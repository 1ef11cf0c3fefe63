"""Plan assertions: no Python UDFs, pruned scans, partial aggregates, bounded top-n."""

import pytest

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["detect_route", "quarantine_frames", "unwrap_pages", "cut_pages", "parse_ids",
                                  "book_quote", "typed_cast", "tag_and_wrap", "merge_quotes", "next_interval"])
def test_no_python_udf(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_latest_per_key_partial_aggregate(spark):
    p = plan(E.queries()["latest_per_key"](spark, SF))
    assert "partial_max_by" in p


def test_top_n_uses_group_limit(spark):
    p = plan(E.queries()["top_holders"](spark, SF))
    assert "WindowGroupLimit" in p


def test_scan_pruning(spark):
    df = E.queries()["open_only"](spark, SF)
    p = plan(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in p


def test_dt_partition_filter(spark):
    df = E.queries()["scan_dt"](spark, SF)
    p = plan(df)
    assert "PartitionFilters: [isnotnull(dt" in p and "2024-01-15" in p


def test_rate_audit_preaggregates(spark):
    p = plan(E.queries()["rate_audit"](spark, SF))
    assert p.index("partial_count") > 0


def test_no_single_partition_window_over_data(spark):
    """The global index behind chunking: the only single-partition exchange is
    over the per-partition count table (one row per partition), never the ids."""
    p = plan(E.queries()["chunk_ids"](spark, SF))
    lines = p.splitlines()
    singles = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(singles) == 1
    below = "\n".join(lines[singles[0]:singles[0] + 4])
    assert "HashAggregate(keys=[_pid" in below


def test_run_length_has_no_key_only_window_over_rows(spark):
    """Cadence windows are partitioned by (key, block) over the rows; key-only
    windows appear only over the per-block summary."""
    p = plan(E.queries()["next_interval"](spark, SF))
    assert "hashpartitioning(user_id#" in p
    for line in p.splitlines():
        if "Window [" in line and "windowspecdefinition(user_id" in line and "_blk" not in line.split("windowspecdefinition(")[1].split(",")[1]:
            assert "_s#" in line or "_g#" in line or "_we0" in line


def test_worklist_join_is_left_to_the_optimizer(spark):
    from quaylake.operators.market import restrict_to_worklist
    df = restrict_to_worklist(spark.range(100).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k"), "k")
    assert "broadcast" not in df._jdf.queryExecution().analyzed().toString().lower()


def test_index_and_runs_do_not_need_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        from pyspark.sql import functions as F
        from quaylake.operators.discovery import global_index
        from quaylake.operators.monitor import run_length
        df = spark.range(0, 50_000).withColumn("v", F.xxhash64("id"))
        wrong = global_index(df, ["v"]).orderBy("v").collect()
        assert [r["idx"] for r in wrong] == list(range(50_000))
        runs = run_length(df.withColumn("k", F.lit(1)).withColumn("f", F.lit(True)), "k", ["id"], "f")
        assert runs.agg(F.max("run")).first()[0] == 50_000
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_a_text_is_parsed_once_in_a_filter_too(spark):
    from pyspark.sql import functions as F
    from quaylake.functions import jsonfn as J
    from quaylake.operators.compact import parse_raw
    from quaylake.session import scratch_dir
    path = scratch_dir(spark, "lines")
    lines = ['{"a": 1}', '{"a": 1} {"b": 2}', '{"a": 1', ' \t\x0b [1]', '"x"', ' \t ', '', '{"a":1}\t']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    bad = parse_raw(spark, [path], "feed/x", "a BIGINT").where(~F.col("_good")).select("path", F.lit(1))
    # the pass over bad lines filters; its condition must not repeat the parse
    condition = [line for line in plan(bad).splitlines() if "Filter" in line and "FileScan" not in line]
    assert max(line.count("parseJson(") for line in condition) <= 1 and all(
        "regexp_replace" not in line for line in condition)
    good = parse_raw(spark, [path], "feed/x", "a BIGINT").where("_good").select("_rec.a")
    assert [r["a"] for r in good.collect()] == [1, 1] and bad.count() == 4
    shapes = spark.createDataFrame([(x,) for x in [*lines, None]], "v string").select(J.json_shape("v").alias("s"))
    assert [r["s"] for r in shapes.collect()] == ["object"] * 3 + ["array", "scalar", "empty", "empty", "object", "scalar"]


def test_a_large_label_is_written_by_several_tasks(spark):
    """Compressed sizes say little of what a task sorts: 8 MB of them are one task's share."""
    from pyspark.sql import functions as F
    from quaylake.operators.land import land_lines
    from quaylake.session import apply_conf, scratch_dir
    apply_conf(spark)
    raw = scratch_dir(spark, "large-label")
    land_lines(spark.range(0, 500_000, 1, 8).select(F.lit("2024-01-02T03").alias("label"),
                                                    F.sha2(F.col("id").cast("string"), 256).alias("value")), raw, "feed/x")
    files = spark.read.text(f"{raw}/feed/x").select(F.col("_metadata.file_path").alias("p")).distinct().count()
    assert files > 1
