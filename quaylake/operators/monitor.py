"""Feed monitoring.

Logs of polls, connections and requests are tables. Cadence and streaks are run
lengths computed by a blocked scan that splits hot keys across tasks; the rate
audit works within the seconds of a group. The only per-key windows run over
small per-block tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quaylake.session import write_shared


def last_fetch(log: DataFrame, source: str = "_source", ts: str = "_fetched_at") -> DataFrame:
    """Latest successful fetch per source (A2)."""
    return log.groupBy(source).agg(F.max(ts).alias("last_fetch"))


def health(ids: DataFrame, kind: str = "kind") -> DataFrame:
    """Counts per id kind (A3)."""
    return ids.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))


def fallback_flags(streaks: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Per connection the latest ``streak`` and whether it has fallen back (A3 with W2's output)."""
    last = F.struct(*[F.col(c) for c in order])
    return streaks.groupBy(key).agg(F.max_by("streak", last).alias("streak"),
                                    F.max_by("fallback", last).alias("fallback"))


def stream_volume(df: DataFrame, cols: tuple[str, ...] = ("stream", "dt", "hour")) -> DataFrame:
    """Records per stream-hour."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def snapshot_count(df: DataFrame) -> DataFrame:
    """Rows and column count of a scan."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("n_columns", F.lit(len(df.columns)))


def run_length(log: DataFrame, key: str, order: list[str], flag: Column | str,
               num_blocks: int | None = None, col: str = "run") -> DataFrame:
    """Length of the current run of consecutive ``flag`` rows per key, ending at
    each row (0 where ``flag`` is false). ``order`` must be a total order.

    Skew-safe blocked scan: rows are range-partitioned on (key, order), so a key
    holding a third of all rows is cut into many contiguous blocks of similar
    size. Each block computes its local runs; a small per-block table (one row
    per key and block) carries the trailing run of earlier blocks into the next
    one. No task ever sorts a whole key.
    """
    spark = log.sparkSession
    n = num_blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    f = F.col(flag) if isinstance(flag, str) else flag
    blocked = (log.withColumn("_flag", F.coalesce(f, F.lit(False)))
               .repartitionByRange(n, key, *order)
               .withColumn("_blk", F.spark_partition_id()))
    # the block of a row is data from here on: both uses below see the same blocks
    blocked = write_shared(blocked, "run-length")
    w = Window.partitionBy(key, "_blk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    blocked = blocked.withColumn("_rst", F.sum((~F.col("_flag")).cast("int")).over(w))
    w2 = Window.partitionBy(key, "_blk", "_rst").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    blocked = blocked.withColumn("_lrun", F.sum(F.col("_flag").cast("int")).over(w2))
    # per block: did it reset, and how long is its trailing run
    blocks = blocked.groupBy(key, "_blk").agg(
        F.max("_rst").alias("_resets"),
        F.max_by("_lrun", F.struct(*[F.col(c) for c in order])).alias("_tail"))
    wb = Window.partitionBy(key).orderBy("_blk")
    blocks = blocks.withColumn("_g", F.sum((F.col("_resets") > 0).cast("int")).over(
        wb.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = blocks.withColumn("_s", F.sum("_tail").over(
        Window.partitionBy(key, "_g").orderBy("_blk").rowsBetween(Window.unboundedPreceding, 0)))
    blocks = blocks.withColumn("_carry", F.coalesce(F.lag("_s").over(wb), F.lit(0))).select(
        F.col(key).alias("_bkey"), F.col("_blk").alias("_bblk"), "_carry")
    # every (key, block) of ``blocked`` has exactly one summary row
    cond = F.col(key).eqNullSafe(F.col("_bkey")) & (F.col("_blk") == F.col("_bblk"))
    out = blocked.join(blocks, cond, "inner").drop("_bkey", "_bblk")
    run = F.col("_lrun") + F.when(F.col("_rst") == 0, F.col("_carry")).otherwise(F.lit(0))
    return out.withColumn(col, run.cast("bigint")).drop("_flag", "_blk", "_rst", "_lrun", "_carry")


def next_interval(log: DataFrame, key: str, order: list[str], changed: Column | str,
                  min_s: float, max_s: float) -> DataFrame:
    """Adaptive cadence as a log analytic.

    After a poll that changed something the next wait is ``min``; otherwise the
    previous wait doubles, capped at ``max`` (the first wait is ``min``):
    with k = unchanged polls since the last change, ``least(min * 2^k, max)``.
    k is a run length (skew-safe blocked scan).
    """
    ch = F.col(changed) if isinstance(changed, str) else changed
    out = run_length(log, key, order, ~F.coalesce(ch, F.lit(False)), col="unchanged_run")
    interval = F.least(F.lit(float(min_s)) * F.pow(F.lit(2.0), F.col("unchanged_run").cast("double")),
                       F.lit(float(max_s)))
    return out.withColumn("next_interval", interval)


def cadence_report(log: DataFrame, key: str, order: list[str], ts: Column | str, changed: Column | str) -> DataFrame:
    """What the poll log shows of each poller's cadence (W1): polls, changes, longest run of polls that changed
    nothing, and the mean wait between polls in seconds (null for a single poll).

    Run lengths come from the blocked scan; the rest is one aggregate with a partial step.
    """
    ch = F.coalesce(F.col(changed) if isinstance(changed, str) else changed, F.lit(False))
    at = F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts)
    runs = run_length(log.withColumn("_changed", ch).withColumn("_at", at), key, order, ~F.col("_changed"), col="_quiet")
    return (runs.groupBy(key).agg(
        F.count(F.lit(1)).alias("polls"), F.count_if("_changed").alias("changes"), F.max("_quiet").alias("longest_quiet"),
        (F.max("_at") - F.min("_at")).alias("_span"))
        .select(key, "polls", "changes", "longest_quiet",
                F.when(F.col("polls") > 1, F.col("_span") / 1_000_000 / (F.col("polls") - 1)).alias("mean_wait")))


def failure_streak(log: DataFrame, key: str, order: list[str], failed: Column | str,
                   threshold: int = 5) -> DataFrame:
    """Consecutive failures per key; a success resets; flag at ``>= threshold``."""
    out = run_length(log, key, order, failed, col="streak")
    return out.withColumn("fallback", F.col("streak") >= F.lit(threshold))


def rate_audit(log: DataFrame, group: str, ts: str, limits: DataFrame | None = None,
               window_s: int = 10) -> DataFrame:
    """Most requests of a group in any ``window_s`` seconds that end in each second.

    The window slides on microseconds: it holds the requests in (t - window, t]
    for a request at t. Whole seconds inside it come from counts per (group,
    second); at both ends the requests of one second are ranked by time. So rows
    meet only within a group's second, and a hot group is spread over its seconds.
    Output per (group, sec) with requests: n, n_window and, with a
    ``limits(group, rps)`` table, ``over = n_window > rps * window_s``.
    """
    span = window_s * 1_000_000
    times = (log.groupBy(F.col(group).alias("grp"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"))
             .agg(F.count(F.lit(1)).alias("c")).withColumn("sec", F.floor(F.col("t") / 1_000_000).cast("bigint")))
    per_sec = times.groupBy("grp", "sec").agg(F.sum("c").alias("n"))
    inner = (per_sec.select("grp", F.explode(F.sequence(F.col("sec") + 1, F.col("sec") + (window_s - 1))).alias("sec"), "n")
             .groupBy("grp", "sec").agg(F.sum("n").alias("inner_n"))) if window_s > 1 else None
    # each time looks at its own second and at the second in which its window begins
    looks = (times.select("grp", "sec", F.col("t").alias("at"), "c", F.lit(True).alias("own"), "t")
             .unionByName(times.select("grp", (F.col("sec") - window_s).alias("sec"), (F.col("t") - span).alias("at"),
                                       F.lit(0).cast("bigint").alias("c"), F.lit(False).alias("own"), "t")))
    upto = Window.partitionBy("grp", "sec").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("grp", "sec")
    looks = looks.withColumn("part", F.when(F.col("own"), F.sum("c").over(upto))
                             .otherwise(F.sum("c").over(whole) - F.sum("c").over(upto)))
    ends = looks.groupBy("grp", "t").agg(F.sum("part").alias("part")) \
        .withColumn("sec", F.floor(F.col("t") / 1_000_000).cast("bigint"))
    top = ends.groupBy("grp", "sec").agg(F.max("part").alias("part"))
    out = per_sec.join(top, ["grp", "sec"])
    if inner is not None:
        out = out.join(inner, ["grp", "sec"], "left")
    extra = F.coalesce("inner_n", F.lit(0)) if inner is not None else F.lit(0)
    out = out.select("grp", "sec", "n", (F.col("part") + extra).alias("n_window"))
    if limits is not None:
        lim = limits.select(F.col(limits.columns[0]).alias("grp"), F.col(limits.columns[1]).alias("rps"))
        out = out.join(lim, "grp", "left").withColumn("over", F.col("n_window") > F.col("rps") * F.lit(window_s))
    return out.withColumnRenamed("grp", group)


def staleness(last: DataFrame, intervals: DataFrame, now_s: float, source: str = "_source") -> DataFrame:
    """Sources whose last fetch is older than their max interval.

    ``intervals(source, max_interval)`` is a configuration table (one row per
    poller); adaptive execution broadcasts it when it is small.
    """
    return (last.join(intervals, source, "left")
                .withColumn("age", F.lit(float(now_s)) - F.col("last_fetch"))
                .withColumn("stale", F.col("age") > F.col("max_interval")))


def ingest_progress(manifest: DataFrame, rows: str = "rows", pages: str = "pages",
                    start: str = "started_at", end: str = "finished_at") -> DataFrame:
    """Items, pages, elapsed seconds and items/s over an ingest manifest."""
    agg = manifest.agg(F.sum(rows).alias("items"), F.sum(pages).alias("pages"),
                       (F.max(end) - F.min(start)).alias("elapsed"))
    return agg.withColumn("items_per_s", F.when(F.col("elapsed") > 0, F.col("items") / F.col("elapsed")))
