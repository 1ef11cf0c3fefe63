"""Exactly-once compaction of closed raw labels into partitioned zstd Parquet, merging and retention.

Plan per compaction run (K4-K8, K10, A5, F5, F6, F8, T3):
  1. list the raw root down to its labels, classify them and write that table as
     the run's record; the run enters the log (``runlog``) as hidden;
  2. claim: every closed label is taken with one rename of its folder (or of its
     flat file) to ``_claimed/<run>/``. What lands under that label later makes a
     new folder and belongs to a later run;
  3. per stream, read the claimed folders and write good rows to
     ``<table>/<stream>/dt=/hour=/run=``, one file group per stream-hour, bad
     lines to the quarantine; list the files with their counts;
  4. commit the run in the log; only then the claimed folder goes, with one
     recursive delete, or waits for the raw retention.
A run that was recorded but not committed is finished under its own id, from the
folders it claimed, so its partitions are replaced instead of doubled.

Every run adds a ``run=`` folder to the hours it touches. ``merge_hours`` rewrites
the small ones of an hour into files of a target size as a run of its own that
replaces them; ``vacuum`` deletes what committed merges replaced. The driver
holds one row per label or partition folder, never one per file.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.functions import jsonfn as J
from quaylake.functions import labels as L
from quaylake.operators import runlog as RL
from quaylake.operators.land import open_batches
from quaylake.session import apply_conf, observed
from quaylake.sources import inventory as inv
from quaylake.specs import spec_for

RUNS_DIR = RL.RUNS_DIR
QUARANTINE_DIR = "_quarantine"
CLAIMED_DIR = "_claimed"
SCHEMA_FILE = "_schema.json"

ENTRIES_SCHEMA = ("path STRING, claimed STRING, is_dir BOOLEAN, size BIGINT, mtime_ms BIGINT, stream STRING, "
                  "label STRING, status STRING")
REPORT_SCHEMA = ("path STRING, stream STRING, label STRING, size BIGINT, mtime_ms BIGINT, status STRING, rows BIGINT, "
                 "corrupt BIGINT, src STRING")
TARGET_BYTES = 128 << 20
# calls to the file system at a time, one for each label
FILE_CALLS = 16
# output folders belong to one run and hidden until it commits, so tasks may move their files themselves
COMMITTER = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def _now(now) -> dt.datetime:
    if now is None:
        return dt.datetime.now(dt.timezone.utc)
    if isinstance(now, (int, float)):
        return dt.datetime.fromtimestamp(now, dt.timezone.utc)
    return now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)


def slice_id(path, size, mtime_ms):
    """Id of one raw file version (hex of xxhash64)."""
    return F.lower(F.hex(F.xxhash64(path, size.cast("bigint"), mtime_ms.cast("bigint"))))


def classify(inventory: DataFrame, now, landing: DataFrame | None = None) -> DataFrame:
    """Status per raw file or label against a fixed ``now`` (F5, F6, ``label < now``).

    ``landing`` are the (stream, label) that an unfinished batch is writing. Folders
    have no size and are never empty here.
    """
    n = _now(now)
    hour_now, day_now = n.strftime("%Y-%m-%dT%H"), n.strftime("%Y-%m-%d")
    lab = F.col("label")
    is_hourly = lab.contains("T")
    folder = F.col("is_dir") if "is_dir" in inventory.columns else F.lit(False)
    status = (F.when(~L.valid_label(lab), "bad_label")
              .when((lab == hour_now) | (lab == day_now), "current")
              .when(is_hourly & (lab > hour_now), "future")
              .when(~is_hourly & (lab > day_now), "future")
              .when(~folder & (F.col("size") == 0), "empty")
              .otherwise("eligible"))
    out = inventory.withColumn("status", status)
    if landing is not None:
        open_ = landing.select("stream", "label", F.lit(True).alias("_open")).distinct()
        out = (out.join(open_, ["stream", "label"], "left")
               .withColumn("status", F.when(F.col("_open") & (F.col("status") == "eligible"), "landing")
                           .otherwise(F.col("status"))).drop("_open"))
    return out


def expired(inventory: DataFrame, now, keep_seconds: float) -> DataFrame:
    """Files whose mtime is strictly before ``now - keep`` (F8)."""
    cutoff_ms = int((_now(now).timestamp() - keep_seconds) * 1000)
    return inventory.where(F.col("mtime_ms") < F.lit(cutoff_ms))


def typed_records(df, raw: str, stream: str, ddl: str | None = None, schema=None):
    """JSON-text records -> ``_good`` flag, typed ``_rec`` struct, ``_extra``
    (unknown top-level keys as ``map<string,variant>``; dropped fields never
    parsed) and ``_cast_errors`` (declared fields present with a non-null value
    that does not fit the declared type; the typed value is null) (P17)."""
    spec = spec_for(stream, ddl)
    known = spec.known_keys if schema is None else [f.name for f in schema.fields] + list(spec.drop_fields)
    schema = schema or spec.schema
    # one variant parse per line, reused by the strictness check, _extra and _cast_errors
    out = df.withColumn("_v", J.parse_once(raw))
    good = J.strict_json(raw, F.col("_v")) & (J.json_shape(raw) == "object")
    extra = F.map_filter(F.try_variant_get(F.col("_v"), "$", "map<string,variant>"),
                         lambda k, v: ~F.array_contains(F.array(*[F.lit(x) for x in known]), k))
    out = out.withColumn("_good", good).withColumn("_rec", F.from_json(raw, schema)) \
        .withColumn("_extra", F.when(F.col("_good"), extra))

    def failed(name):
        val = F.variant_get(F.col("_v"), f"$['{name}']", "variant")
        # most fields fit, and then the text's value is not looked up
        return F.when(F.col("_rec")[name].isNull() & val.isNotNull() & ~F.is_variant_null(val), F.lit(name))
    errors = F.array_compact(F.array(*[failed(f.name) for f in schema.fields])) if schema.fields \
        else F.array().cast("array<string>")
    return out.withColumn("_cast_errors", errors).drop("_v")


def apply_schema(df: DataFrame, raw: str, stream: str, ddl: str | None = None) -> DataFrame:
    """Good records of a stream as its typed table: declared fields, ``_extra``, ``_cast_errors``."""
    rec = typed_records(df, raw, stream, ddl).where("_good")
    return rec.select("_rec.*", "_extra", "_cast_errors")


def parse_raw(spark: SparkSession, paths: list[str], stream: str, ddl: str | None = None) -> DataFrame:
    """Read raw JSONL folders or files of one stream into typed rows + ``_extra`` + a good/bad flag.

    Lines are read as text so strictness, quarantine and unknown keys are under
    our control; blank lines are skipped. A stream without a declaration has the
    metadata columns only and keeps every other key in ``_extra``, so a key may
    change its type from run to run.
    """
    text = spark.read.option("recursiveFileLookup", "true").text(paths).select(
        inv.metadata_path().alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.unix_millis(F.col("_metadata.file_modification_time")).alias("mtime_ms"),
        F.col("value").alias("raw"))
    text = typed_records(text.where(J.from_first("raw") != ""), "raw", stream, ddl) \
        .withColumn("_label", L.label_of_path("path"))
    label = F.col("_label")
    return text.select(
        "path", F.when(~F.col("_good"), F.col("raw")).alias("raw"), "_good", "_rec", "_extra", "_cast_errors",
        F.lit(stream).alias("stream"), L.label_dt(label).alias("dt"), L.label_hour(label).alias("hour"),
        slice_id(F.col("path"), F.col("size"), F.col("mtime_ms")).alias("src"))


def _keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Record the table's columns next to it; columns of earlier runs stay."""
    import json
    known = stream_schema(spark, path)
    names = {f.name for f in known.fields} if known else set()
    merged = T.StructType((known.fields if known else []) + [f for f in schema.fields if f.name not in names])
    if known != merged:
        inv.write_text_file(spark, f"{path}/{SCHEMA_FILE}", json.dumps(merged.jsonValue()))


def stream_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Columns recorded for a compacted stream (without dt, hour and run), or None."""
    import json
    text = inv.read_text_file(spark, f"{path}/{SCHEMA_FILE}")
    return T.StructType.fromJson(json.loads(text)) if text else None


def _entries(spark: SparkSession, table_root: str, run: str) -> DataFrame:
    return spark.read.schema(ENTRIES_SCHEMA).parquet(RL.run_path(table_root, run, "entries"))


def _claim(spark: SparkSession, table_root: str, run: str, again: bool = False) -> list[dict]:
    """Take the labels of a recorded run, each with one rename; returns the entries it has.

    ``again``: what an interrupted attempt took stays, and a folder that came back
    since is left for a later run. A label that another hand took is not had.
    """
    wanted = _entries(spark, table_root, run).where(F.col("status").isin("eligible", "empty")).collect()
    for parent in sorted({r["claimed"].rsplit("/", 1)[0] for r in wanted}):
        inv.mkdirs(spark, parent)

    def take(r) -> bool:
        return (again and inv.exists(spark, r["claimed"])) or inv.rename(spark, r["path"], r["claimed"])
    with ThreadPoolExecutor(FILE_CALLS) as pool:
        taken = list(pool.map(take, wanted))
    return [r.asDict() for r, t in zip(wanted, taken, strict=True) if t]


def _hour(label: str) -> tuple[str, str]:
    """(dt, hour) of a label, as the columns of the table have them."""
    return label[:10], label[11:] if "T" in label else "00"


def _write_rows(rows: DataFrame, target: str, codec: str, again: bool) -> None:
    """Append partitions of a run that is hidden; ``again`` replaces what an interrupted attempt left."""
    writer = rows.hint("rebalance", "dt", "hour").write.option("compression", codec).partitionBy("dt", "hour", "run")
    if again:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(target)
    else:
        writer.mode("append").options(**COMMITTER).parquet(target)


def _write_run(spark: SparkSession, raw_root: str, table_root: str, run: str, ddl: dict[str, str], codec: str,
               again: bool = False) -> None:
    """Claim and write the labels of a recorded run, stream by stream, list its files and commit it."""
    had = _claim(spark, table_root, run, again)
    by_stream: dict[str, list[dict]] = {}
    for e in had:
        if e["status"] == "eligible":
            by_stream.setdefault(e["stream"], []).append(e)
    counted = spark.createDataFrame([], "src STRING, rows BIGINT, corrupt BIGINT")
    for stream, entries in sorted(by_stream.items()):
        paths = sorted(e["claimed"] for e in entries)
        parsed = parse_raw(spark, paths, stream, ddl.get(stream)).withColumn("run", F.lit(run))
        seen = Observation()
        rec_fields = parsed.select("_rec.*").columns
        good = (parsed.observe(seen, F.count_if(~F.col("_good")).alias("bad")).where("_good")
                .select(*[F.col("_rec")[c].alias(c) for c in rec_fields], "_extra", "_cast_errors", "src",
                        "dt", "hour", "run"))
        target = f"{table_root}/{stream}"
        _write_rows(good, target, codec, again)
        _keep_schema(spark, target, good.drop("dt", "hour", "run").schema)
        written = [(target, 1, 0)]
        if observed(seen, "bad", parsed.where(~F.col("_good")).count):
            bad = parsed.where(~F.col("_good")).select(
                "stream", "path", F.lit("bad_json_or_not_object").alias("reason"),
                J.preview("raw").alias("preview"), "raw", "src", "dt", "hour", "run")
            _write_rows(bad, f"{table_root}/{QUARANTINE_DIR}/{stream}", codec, again)
            written.append((f"{table_root}/{QUARANTINE_DIR}/{stream}", 0, 1))
        hours = sorted({_hour(e["label"]) for e in entries})
        for base, rows, corrupt in written:
            # this run's own partitions, by name
            parts = [f"{base}/dt={d}/hour={h}/run={run}" for d, h in hours]
            with ThreadPoolExecutor(FILE_CALLS) as pool:
                there = list(pool.map(lambda p: inv.exists(spark, p), parts))
            parts = [p for p, t in zip(parts, there, strict=True) if t]
            if parts:
                t = spark.read.schema("src STRING").parquet(*parts)
                counted = counted.unionByName(t.select("src", F.lit(rows).cast("bigint").alias("rows"),
                                                       F.lit(corrupt).cast("bigint").alias("corrupt")))
    newest = _list_run(spark, raw_root, table_root, run, had, counted)
    RL.set_state(spark, table_root, run, RL.COMMITTED, newest_ms=newest)


def _list_run(spark: SparkSession, raw_root: str, table_root: str, run: str, had: list[dict], counted: DataFrame) -> int:
    """Write the run's files with what became of them, and the labels it left alone; returns the newest mtime."""
    claimed_root = f"{raw_root}/{CLAIMED_DIR}/{run}"
    files = (inv.scan_listing(spark, sorted(e["claimed"] for e in had if e["is_dir"] or e["size"] > 0))
             .withColumn("src", slice_id(F.col("path"), F.col("size"), F.col("mtime_ms")))
             .withColumn("stream", L.stream_of_path("path", claimed_root)).withColumn("label", L.label_of_path("path"))
             .withColumn("path", F.concat(F.lit(raw_root), F.substring("path", F.lit(len(claimed_root) + 1), F.length("path")))))
    counts = counted.groupBy("src").agg(F.sum("rows").alias("rows"), F.sum("corrupt").alias("corrupt"))
    zero = F.lit(0).cast("bigint")
    columns = [c.split()[0] for c in REPORT_SCHEMA.split(", ")]
    done = (files.join(counts, "src", "left").withColumn("status", F.lit("compacted"))
            .withColumn("rows", F.coalesce("rows", zero)).withColumn("corrupt", F.coalesce("corrupt", zero)))
    taken = _entries(spark, table_root, run)
    # zero-byte files of claimed folders are known from the landing log
    logged = inv.logged_files(spark, raw_root).where(F.col("size") == 0)
    folder = taken.where(F.col("is_dir") & (F.col("status") == "eligible")).select(
        F.col("path").alias("folder"), "stream", "label")
    empty = (logged.withColumn("folder", F.regexp_extract("path", r"^(.*/label=[^/]+)/", 1))
             .join(folder, "folder").withColumn("status", F.lit("empty")))
    others = taken.where(F.col("status") != "eligible")
    listed = done.select(*columns)
    for more in (empty, others):
        listed = listed.unionByName(more.withColumn("rows", zero).withColumn("corrupt", zero).withColumn(
            "src", slice_id(F.col("path"), F.col("size"), F.col("mtime_ms"))).select(*columns))
    path = RL.run_path(table_root, run, "files")
    listed.write.mode("overwrite").parquet(path)
    newest = spark.read.schema(REPORT_SCHEMA).parquet(path).where(F.col("status") == "compacted")
    return newest.agg(F.max("mtime_ms").alias("m")).first()["m"] or 0


def run_files(spark: SparkSession, table_root: str, runs: list[str] | None = None) -> DataFrame:
    """The files that runs found, with status and counts: of the given runs, or of all that were ever made."""
    if runs is None:
        path = f"{table_root.rstrip('/')}/{RUNS_DIR}"
        listed = inv.list_dirs(spark, path) if inv.exists(spark, path) else []
        runs = [r for r in (d.rstrip("/").rsplit("/", 1)[-1] for d in listed)
                if inv.exists(spark, RL.run_path(table_root, r, "files/_SUCCESS"))]
    paths = [RL.run_path(table_root, r, "files") for r in runs]
    return spark.read.schema(REPORT_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], REPORT_SCHEMA)


def _clear_run(spark: SparkSession, table_root: str, run: str, raw_root: str) -> None:
    """Delete the claimed sources of a committed run with one call and take it out of the log."""
    taken = _entries(spark, table_root, run).where(F.col("status").isin("eligible", "empty"))
    claimed_ms = RL.snapshot(spark, table_root).runs[run]["recorded_ms"]
    inv.trim_log(spark, raw_root, taken.select("path", F.lit(claimed_ms).alias("before_ms")))
    inv.delete_paths(spark, [f"{raw_root}/{CLAIMED_DIR}/{run}/"])
    RL.set_state(spark, table_root, run, None)


def _resume(spark: SparkSession, table_root: str, ddl: dict[str, str], codec: str) -> None:
    """Finish what earlier jobs left: recorded runs are written again, committed ones cleared."""
    for run, e in sorted(RL.snapshot(spark, table_root).runs.items()):
        if e["kind"] == "compact":
            if e["state"] == RL.RECORDED:
                _write_run(spark, e["raw"], table_root, run, ddl, codec, again=True)
            if e["state"] != RL.KEPT:
                _finish(spark, table_root, run, e)
        elif e["state"] == RL.RECORDED:
            _write_merge(spark, table_root, run, e["stream"], codec, again=True)


def _finish(spark: SparkSession, table_root: str, run: str, entry: dict) -> None:
    if entry["keep"]:
        RL.set_state(spark, table_root, run, RL.KEPT)
    else:
        _clear_run(spark, table_root, run, entry["raw"])


def _landing(spark: SparkSession, raw_root: str) -> DataFrame:
    """(stream, label) that hold slices of batches whose landing has not ended."""
    rows = []
    for stream, batch in open_batches(spark, raw_root):
        base = f"{raw_root}/{stream}"
        for d in inv.list_dirs(spark, base):
            if inv.exists(spark, f"{d}/slice={batch}"):
                rows.append((stream, d.rstrip("/").rsplit("/label=", 1)[-1]))
    return spark.createDataFrame(rows, "stream STRING, label STRING")


def compact(spark: SparkSession, raw_root: str, table_root: str, now=None,
            streams: list[str] | None = None, ddl: dict[str, str] | None = None,
            codec: str = "zstd", delete_sources: bool = True) -> DataFrame:
    """Compact all closed labels; returns the report of this run (A5).

    The report has one row per file of the compacted labels, and one per label that
    was left alone. Without ``delete_sources`` the claimed raw files stay under
    ``_claimed`` until ``purge_raw`` finds them old enough.
    """
    apply_conf(spark)
    raw_root, table_root = inv.qualified(spark, raw_root), table_root.rstrip("/")
    ddl = ddl or {}
    _resume(spark, table_root, ddl, codec)
    listed = classify(inv.label_entries(spark, raw_root), now, _landing(spark, raw_root))
    if streams is not None:
        listed = listed.where(F.col("stream").isin(streams))
    run = uuid.uuid4().hex[:12]
    claimed = F.concat(F.lit(f"{raw_root}/{CLAIMED_DIR}/{run}"), F.substring("path", F.lit(len(raw_root) + 1), F.length("path")))
    (listed.withColumn("claimed", claimed).select(*[c.split()[0] for c in ENTRIES_SCHEMA.split(", ")])
     .coalesce(1).write.parquet(RL.run_path(table_root, run, "entries")))
    entry = {"kind": "compact", "raw": raw_root, "keep": not delete_sources,
             "recorded_ms": int(dt.datetime.now(dt.timezone.utc).timestamp() * 1000)}
    RL.set_state(spark, table_root, run, RL.RECORDED, **entry)
    _write_run(spark, raw_root, table_root, run, ddl, codec)
    _finish(spark, table_root, run, entry)
    return run_files(spark, table_root, [run])


# ---------------------------------------------------------------- merging of runs
def partition_sizes(spark: SparkSession, table_root: str, stream: str) -> DataFrame:
    """(dt, hour, run, files, bytes) of the partitions of a stream that count."""
    base = f"{table_root.rstrip('/')}/{stream}"
    parts = r"/dt=([^/]+)/hour=([^/]+)/run=([^/]+)/[^/]+\.parquet$"
    listed = inv.scan_listing(spark, [base]) if inv.exists(spark, base) else spark.createDataFrame([], inv.INVENTORY_SCHEMA)
    sizes = (listed.where(F.col("path").rlike(parts))
             .groupBy(*[F.regexp_extract("path", parts, i + 1).alias(c) for i, c in enumerate(("dt", "hour", "run"))])
             .agg(F.count("*").alias("files"), F.sum("size").alias("bytes")))
    return RL.visible(sizes, table_root, stream)


def merge_plan(sizes: DataFrame, target_bytes: int = TARGET_BYTES, before: str | None = None) -> DataFrame:
    """(dt, hour, run, bytes, files, n_out): the partitions to rewrite and into how many files their hour goes.

    Partitions whose files reach the target are left alone. The others of an hour are
    taken together when that leaves fewer files. ``before`` (dt) leaves newer days.
    """
    small = sizes.where(F.col("bytes") / F.col("files") < target_bytes)
    if before is not None:
        small = small.where(F.col("dt") < before)
    hour = small.groupBy("dt", "hour").agg(F.sum("bytes").alias("all_bytes"), F.sum("files").alias("all_files"))
    fits = (hour.withColumn("n_out", F.greatest(F.lit(1), F.ceil(F.col("all_bytes") / target_bytes)).cast("int"))
            .where(F.col("all_files") > F.col("n_out")))
    return small.join(fits.select("dt", "hour", "n_out"), ["dt", "hour"])


def merge_hours(spark: SparkSession, table_root: str, stream: str, target_bytes: int = TARGET_BYTES,
                before: str | None = None, codec: str = "zstd") -> DataFrame:
    """Rewrite the small partitions of every hour of a stream as one run that replaces them (K4).

    Returns what was replaced (dt, hour, run, bytes, files, n_out). Readers see the
    old partitions until the merge commits and the new ones from then on; the old
    folders stay until ``vacuum``, or the next merge. A merge that was interrupted is finished by the
    next call or by ``compact``.
    """
    apply_conf(spark)
    table_root = table_root.rstrip("/")
    _resume(spark, table_root, {}, codec)
    vacuum(spark, table_root)
    run = uuid.uuid4().hex[:12]
    path = RL.run_path(table_root, run, "replaces")
    plan = merge_plan(partition_sizes(spark, table_root, stream), target_bytes, before)
    plan.withColumn("stream", F.lit(stream)).coalesce(1).write.parquet(path)
    plan = spark.read.parquet(path)
    if plan.isEmpty():
        nothing = spark.createDataFrame([], plan.drop("stream").schema)
        inv.delete_paths(spark, [f"{path.rsplit('/', 1)[0]}/"])
        return nothing
    RL.set_state(spark, table_root, run, RL.RECORDED, kind="merge", stream=stream)
    _write_merge(spark, table_root, run, stream, codec)
    return plan.drop("stream")


def _write_merge(spark: SparkSession, table_root: str, run: str, stream: str, codec: str, again: bool = False) -> None:
    base = f"{table_root}/{stream}"
    plan = spark.read.parquet(RL.run_path(table_root, run, "replaces"))
    folders = sorted(f"{base}/dt={r['dt']}/hour={r['hour']}/run={r['run']}" for r in plan.collect())
    fields = [*stream_schema(spark, base).fields, *[T.StructField(c, T.StringType()) for c in ("dt", "hour", "run")]]
    rows = spark.read.schema(T.StructType(fields)).option("basePath", base).parquet(*folders)
    n_out = plan.groupBy("dt", "hour").agg(F.max("n_out").alias("_n_out"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows go to the files of their hour by their place in the old ones, alike in every attempt
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    dealt = rows.withColumn("_place", place).join(n_out, ["dt", "hour"]) \
        .withColumn("_file", F.pmod("_place", "_n_out"))
    out = (dealt.withColumn("run", F.lit(run)).repartition(parts, "dt", "hour", "_file").drop("_n_out", "_file", "_place")
           .write.option("compression", codec).partitionBy("dt", "hour", "run"))
    if again:
        out.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(base)
    else:
        out.mode("append").options(**COMMITTER).parquet(base)
    RL.set_state(spark, table_root, run, RL.COMMITTED)


def vacuum(spark: SparkSession, table_root: str) -> int:
    """Delete the partition folders that committed merges replaced; returns how many.

    Call it when no reader that began before the merge is left.
    """
    n = 0
    for run in RL.snapshot(spark, table_root).of_state(RL.COMMITTED, "merge"):
        plan = spark.read.schema(RL.REPLACES_SCHEMA).parquet(RL.run_path(table_root, run, "replaces"))
        n += inv.delete_paths(spark, (f"{table_root.rstrip('/')}/{r['stream']}/dt={r['dt']}/hour={r['hour']}/run={r['run']}/"
                                      for r in plan.toLocalIterator()))
        RL.set_state(spark, table_root, run, None)
    return n


# ---------------------------------------------------------------- retention
def purge_raw(spark: SparkSession, raw_root: str, table_root: str, now=None,
              keep_hours: float = 48, force: bool = False) -> int:
    """Delete raw data older than the retention (K7); returns how many folders or flat files.

    The claimed folder of a compacted run goes, with one delete, when its newest file
    is older. Unlike the original, expired labels that were never compacted are
    kept unless ``force`` (their rows would otherwise be lost): then a label goes
    when its newest file is older. Empty flat files go in either case.
    """
    raw_root = inv.qualified(spark, raw_root)
    cutoff = int((_now(now).timestamp() - keep_hours * 3600) * 1000)
    n = 0
    for run, e in RL.snapshot(spark, table_root).runs.items():
        if e["kind"] == "compact" and e["state"] == RL.KEPT and e["raw"] == raw_root and e["newest_ms"] < cutoff:
            _clear_run(spark, table_root, run, raw_root)
            n += 1
    entries = inv.label_entries(spark, raw_root)
    flat = entries.where(~F.col("is_dir"))
    old = expired(flat if force else flat.where(F.col("size") == 0), now, keep_hours * 3600).select("path")
    if force:
        in_folder = inv.file_listing(spark, raw_root).withColumn("path", F.regexp_extract("path", r"^(.*/label=[^/]+)/", 1))
        newest = in_folder.where(F.col("path") != "").groupBy("path").agg(F.max("mtime_ms").alias("mtime_ms"))
        old = old.unionByName(expired(newest, now, keep_hours * 3600).select(F.concat("path", F.lit("/")).alias("path")))
    return n + inv.delete_paths(spark, (r["path"] for r in old.toLocalIterator()))


def purge_table(spark: SparkSession, table_root: str, stream: str, now=None,
                keep_days: int = 365, by: str = "dt") -> int:
    """Drop expired compacted data (K8); returns how many folders or files.

    ``by="dt"`` (default) drops whole ``dt=`` partitions older than the
    retention by data date; ``by="mtime"`` deletes files whose modification
    time is older than the retention, as the original collector does.
    """
    base = f"{table_root.rstrip('/')}/{stream}"
    if by == "mtime":
        listing = inv.file_listing(spark, base).where(~F.col("path").endswith(SCHEMA_FILE))
        old = expired(listing, now, keep_days * 86400.0)
        return inv.delete_paths(spark, (r["path"] for r in old.select("path").toLocalIterator()))
    cutoff = (_now(now) - dt.timedelta(days=keep_days)).strftime("%Y-%m-%d")
    names = ((d, d.rstrip("/").rsplit("/", 1)[-1]) for d in inv.list_dirs(spark, base))
    return inv.delete_paths(spark, [d for d, n in names if n.startswith("dt=") and n[3:] < cutoff], recursive=True)
