"""Structured Streaming jobs around the shared transforms.

* Source: landed frame envelopes ``{channel, raw, _fetched_at}`` as JSON-line
  files, or with ``payload`` bytes as Parquet files (or any source with those
  columns). Admission is bounded by ``maxFilesPerTrigger`` (durable back-pressure
  instead of a lossy in-memory queue, R5). Only closed, atomically published
  files may enter the watched folder: the file source never re-reads a file.
* Routing: the same ``decode_frames`` transform as batch (R1-R4); a micro-batch
  writes routed lines, and quarantine rows if it has any, with dynamic partition
  overwrite on a ``slice`` partition (stream and epoch), so a replayed
  micro-batch rewrites its own slice instead of appending duplicates and other
  streams on the same folders are left alone.
* Hourly volume: partial counts per micro-batch; rows of hours that the stream's
  own high-water mark had closed are flagged as late (R6, R8).
* Closed hours: a windowed aggregate with watermark over those counts, in append
  mode: every hour of a stream comes out once, when it is over (R7).
* New ids: keyed state in the state store, with the ids known before as a second
  source of the stream (R9).
* Recovery and cadence: checkpoints in the shared folder (R10), ``availableNow``
  or processing-time triggers (R11). A micro-batch without a record writes nothing
  (F9).

Slices that other streams read are published with one rename and never written
again, so a replayed micro-batch does not come twice downstream.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quaylake.functions import labels as L
from quaylake.operators.land import non_empty_batch
from quaylake.operators.route import decode_frames, quarantine_rows, routed_lines
from quaylake.session import apply_conf, observed
from quaylake.sources import inventory as inv
from quaylake.sources.inventory import exists, metadata_path

FRAME_SCHEMA = "channel STRING, raw STRING, _fetched_at DOUBLE"
PAYLOAD_SCHEMA = "channel STRING, payload BINARY, _fetched_at DOUBLE"


def land_frames(frames: DataFrame, path: str) -> None:
    """Publish a batch of frame envelopes as new files (test/replay helper): JSON lines, or Parquet with payloads."""
    if "payload" in frames.columns:
        frames.select("channel", "payload", "_fetched_at").write.mode("append").parquet(path)
    else:
        frames.select("channel", "raw", "_fetched_at").write.mode("append").json(path)


def frames_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                  payload: bool = False) -> DataFrame:
    """Frames landed as text, or with ``payload`` as bytes."""
    apply_conf(spark)
    reader = spark.readStream.schema(PAYLOAD_SCHEMA if payload else FRAME_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path) if payload else reader.json(path)


def _trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval or "60 seconds")


def stream_id(checkpoint: str) -> str:
    """Stable short name of a stream: its checkpoint's path decides, so a restart keeps it."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:10]


def _slice(stream: str, epoch_id: int) -> str:
    """Name of what one epoch of one stream wrote: a replay rewrites it, nothing else touches it."""
    return f"{stream}-{int(epoch_id):010d}"


def publish_slice(rows: DataFrame, out_path: str, name: str) -> bool:
    """Write ``rows`` as ``slice=<name>`` with one rename; a slice that is there is left as it is.

    ``rows`` are computed once in either case, so the keyed state of a replayed
    micro-batch is made again. An empty result publishes nothing (F9). Returns
    whether the slice is there now.
    """
    spark, final = rows.sparkSession, f"{out_path}/slice={name}"
    if exists(spark, final):
        rows.write.format("noop").mode("overwrite").save()
        return True
    pending = f"{out_path}/_pending/{name}"
    rows.write.mode("overwrite").parquet(pending)
    if not non_empty_batch(spark.read.schema(rows.schema).parquet(pending)):
        inv.delete_paths(spark, [f"{pending}/"])
        return False
    return inv.rename(spark, pending, final)


def read_slices(spark: SparkSession, out_path: str, schema: str, pattern: str = "*") -> DataFrame:
    """All published slices, or those whose name fits ``pattern``; none is an empty table."""
    if not any(n.startswith("slice=") for n in inv.child_names(spark, out_path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", out_path).parquet(f"{out_path}/slice={pattern}")


def route_batch(batch: DataFrame, epoch_id: int, raw_root: str, quarantine_path: str, stream: str = "batch") -> None:
    """One micro-batch (or one batch job): routed lines and quarantine rows, idempotent per epoch (K3).

    Both writes carry ``slice``, the stream's id and the epoch, as a partition, so
    several streams may land in the same folders.
    """
    decoded = decode_frames(batch)
    if not non_empty_batch(decoded):
        return
    seen = Observation()
    lines = _with_hour_label(routed_lines(decoded.observe(seen, F.count_if(F.col("reason").isNotNull()).alias("bad"))))
    lines = (lines.withColumn("slice", F.lit(_slice(stream, epoch_id)))
             .select("channel", "route", "label", "slice", "line"))
    (lines.hint("rebalance", "channel", "route", "label").write.mode("overwrite")
          .option("partitionOverwriteMode", "dynamic")
          .partitionBy("channel", "route", "label", "slice").text(raw_root))
    if observed(seen, "bad", decoded.where(F.col("reason").isNotNull()).count):
        q = quarantine_rows(decoded).withColumn("slice", F.lit(_slice(stream, epoch_id)))
        (q.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("slice").parquet(quarantine_path))


def _with_hour_label(df: DataFrame) -> DataFrame:
    """Hourly rotation label of routed lines, from their arrival time."""
    return df.withColumn("label", L.hour_label(L.from_epoch_seconds("_fetched_at")))


def route_stream(spark: SparkSession, frames_path: str, raw_root: str, quarantine_path: str,
                 checkpoint: str, max_files_per_trigger: int | None = None,
                 available_now: bool = True, interval: str | None = None, payload: bool = False):
    """Start the routing stream; returns the StreamingQuery. ``payload``: the frames are bytes."""
    name = stream_id(checkpoint)
    src = frames_source(spark, frames_path, max_files_per_trigger, payload)
    writer = (src.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda b, e: route_batch(b, e, raw_root, quarantine_path, name)))
    return _trigger(writer, available_now, interval).start()


def read_routed(spark: SparkSession, raw_root: str) -> DataFrame:
    """Routed raw lines read back with stream and label from their paths."""
    t = spark.read.option("recursiveFileLookup", "true").text(raw_root)
    p = metadata_path()
    return t.select(L.stream_of_path(p, raw_root).alias("stream"), L.label_of_path(p).alias("label"),
                    F.col("value").alias("line"))


def _marks(spark: SparkSession, out_path: str, stream: str) -> str:
    return f"{out_path}/_marks/{stream}"


def high_water(spark: SparkSession, out_path: str, stream: str, before: int) -> float | None:
    """Newest arrival (epoch seconds) that a stream's epochs before this one brought, from its newest mark."""
    root = _marks(spark, out_path, stream)
    for name in sorted(inv.child_names(spark, root), reverse=True):
        if name.endswith(".json") and int(name.split(".")[0]) < before:
            return json.loads(inv.read_text_file(spark, f"{root}/{name}"))["newest"]
    return None


def _keep_mark(spark: SparkSession, out_path: str, stream: str, epoch_id: int, newest: float | None) -> None:
    """Record the mark after an epoch; the two before it stay, for a replay."""
    root = _marks(spark, out_path, stream)
    inv.write_text_file(spark, f"{root}/{epoch_id:010d}.json", json.dumps({"newest": newest}))
    old = sorted(n for n in inv.child_names(spark, root) if n.endswith(".json"))[:-3]
    inv.delete_paths(spark, [f"{root}/{n}" for n in old])


HOUR = 3600


def count_batch(batch: DataFrame, epoch_id: int, out_path: str, stream: str, delay_s: float = 0) -> None:
    """Message counts of one micro-batch per hour and route, published as a slice of their own.

    ``late`` marks hours that had ended ``delay_s`` before the newest arrival of this
    stream's earlier epochs: its own high-water mark, kept beside the slices, not
    that of another stream on the folder. Late rows are counted like others.
    """
    spark = batch.sparkSession
    name = _slice(stream, epoch_id)
    mark = high_water(spark, out_path, stream, epoch_id)
    hour_end = (F.floor(F.col("newest") / HOUR) + 1) * HOUR
    counts = (_with_hour_label(decode_frames(batch).where(F.col("reason").isNull()))
              .groupBy("label", "stream").agg(F.count(F.lit(1)).alias("n"), F.max("_fetched_at").alias("newest"))
              .withColumn("late", hour_end <= F.lit(mark - delay_s) if mark is not None else F.lit(False)))
    newest = mark
    if publish_slice(counts, out_path, name):
        seen = read_slices(spark, out_path, COUNTS_SCHEMA, name).agg(F.max("newest").alias("m")).first()["m"]
        newest = seen if mark is None else max(mark, seen)
    _keep_mark(spark, out_path, stream, epoch_id, newest)


COUNTS_SCHEMA = "label STRING, stream STRING, n BIGINT, newest DOUBLE, late BOOLEAN, slice STRING"


def read_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """All slices written by ``hourly_stream``."""
    return read_slices(spark, out_path, COUNTS_SCHEMA)


def hourly_counts(spark: SparkSession, out_path: str, closed_before: str | None = None) -> DataFrame:
    """Messages per hour and route over all slices, and how many of them came late.

    ``closed_before`` keeps the hours before that label. Open hours are only left
    out of that view; ``closed_hours_stream`` emits hours as they close.
    """
    out = read_counts(spark, out_path)
    if closed_before is not None:
        out = out.where(F.col("label") < closed_before)
    return out.groupBy("label", "stream").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("late"), F.col("n")).otherwise(0)).alias("n_late"))


def hourly_stream(spark: SparkSession, frames_path: str, out_path: str, checkpoint: str,
                  max_files_per_trigger: int | None = None, available_now: bool = True, delay_s: float = 0):
    """Per-hour, per-route message counts on arrival time.

    Every micro-batch adds its partial counts, so no row is too late to be counted;
    ``delay_s`` is how long after its end an hour still takes rows as on time.
    """
    src = frames_source(spark, frames_path, max_files_per_trigger)
    name = stream_id(checkpoint)
    writer = (src.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda b, e: count_batch(b, e, out_path, name, delay_s)))
    return _trigger(writer, available_now, None).start()


CLOSED_SCHEMA = "label STRING, stream STRING, n BIGINT, slice STRING"


def closed_hours_stream(spark: SparkSession, counts_path: str, counts_checkpoint: str, out_path: str, checkpoint: str,
                        delay_s: float = 0, available_now: bool = True, interval: str | None = None):
    """Hours of one ``hourly_stream`` that are over, each with its count of rows on time, emitted once.

    A windowed aggregate in append mode: an hour waits in the state store until the
    watermark, the newest arrival less ``delay_s``, passes its end. Its input are the
    slices of the stream that ``counts_checkpoint`` belongs to, without the rows flagged
    as late. Slices come whole, so the watermark here is never ahead of the mark
    that decided what is late, with the same ``delay_s`` in both: every row is in an
    emitted hour, in an open one or flagged as late.
    """
    apply_conf(spark)
    source, name = stream_id(counts_checkpoint), stream_id(checkpoint)
    counts = (spark.readStream.schema(COUNTS_SCHEMA).option("basePath", counts_path)
              .parquet(f"{counts_path}/slice={source}-*"))
    hours = (counts.where(~F.col("late")).withColumn("ts", L.from_epoch_seconds("newest"))
             .withWatermark("ts", f"{int(delay_s * 1000)} milliseconds")
             .groupBy(F.window("ts", "1 hour").alias("hour"), "stream").agg(F.sum("n").alias("n"))
             .select(L.hour_label(F.col("hour.start")).alias("label"), "stream", "n"))
    writer = (hours.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
              .foreachBatch(lambda b, e: publish_slice(b, out_path, _slice(name, e))))
    return _trigger(writer, available_now, interval).start()


def read_closed_hours(spark: SparkSession, out_path: str) -> DataFrame:
    return read_slices(spark, out_path, CLOSED_SCHEMA)


IDS_SCHEMA = "id STRING, first_seen TIMESTAMP, slice STRING"


def ids_batch(touched: DataFrame, epoch_id: int, out_path: str, stream: str) -> None:
    """Ids whose state began in this micro-batch and that no table knew, published as a slice."""
    new = touched.where((F.col("first_batch") == F.col("last_batch")) & ~F.col("known"))
    publish_slice(new.select("id", "first_seen"), out_path, _slice(stream, epoch_id))


def new_ids_stream(spark: SparkSession, frames_path: str, out_path: str, checkpoint: str,
                   id_path: str = "$.user", max_files_per_trigger: int | None = None, available_now: bool = True,
                   known_path: str | None = None):
    """First sighting of each id, with the earliest arrival of its micro-batch.

    What was seen is keyed state in the state store: a micro-batch reads its own
    frames and the state of the ids in them, however many are known. The Parquet id
    table ``known_path`` (id, first_seen) is a second source: the first micro-batch
    takes all of it, later ones what was added, and ids in it are not new.
    """
    src = frames_source(spark, frames_path, max_files_per_trigger)
    name = stream_id(checkpoint)
    ids = src.select(F.get_json_object("raw", id_path).alias("id"),
                     L.from_epoch_seconds("_fetched_at").alias("first_seen"),
                     F.lit(False).alias("known")).where(F.col("id").isNotNull())
    if known_path:
        known = spark.readStream.schema("id STRING, first_seen TIMESTAMP").parquet(known_path)
        ids = ids.unionByName(known.select("id", "first_seen", F.lit(True).alias("known")).where(F.col("id").isNotNull()))
    # one time per micro-batch, the same when it is replayed
    touched = (ids.withColumn("batch", F.current_timestamp()).groupBy("id")
               .agg(F.min("first_seen").alias("first_seen"), F.min("batch").alias("first_batch"),
                    F.max("batch").alias("last_batch"), F.max("known").alias("known")))
    writer = (touched.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
              .foreachBatch(lambda b, e: ids_batch(b, e, out_path, name)))
    return _trigger(writer, available_now, None).start()


def read_new_ids(spark: SparkSession, out_path: str) -> DataFrame:
    return read_slices(spark, out_path, IDS_SCHEMA)
