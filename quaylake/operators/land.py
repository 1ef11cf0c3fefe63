"""Landing (P1-P3, K1-K3): capture metadata, rotation labels, append-only JSONL.

Layout: ``<raw_root>/<stream>/label=<label>/part-*.json`` for typed batches and
``<raw_root>/<channel>/route=<key>/label=<label>/part-*.txt`` for routed message
frames (one pass over the feed writes every routed stream). Readers accept both,
plus the flat ``<stream>/<label>.jsonl`` files of the original collector.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.functions import labels as L
from quaylake.functions import jsonfn as J
from quaylake.sources import inventory as inv

META_COLS = ("_fetched_at", "_source")


def resolve_source(source: str | None, stream: str) -> str:
    """Explicit source wins; ``None`` or ``""`` falls back to the stream name."""
    return source if source else stream


def stamp_batch(fetched_at: float | None = None) -> Column:
    """One timestamp shared by the whole batch, taken once on the driver."""
    return F.lit(float(time.time() if fetched_at is None else fetched_at))


def stamp_each(ts: Column | str) -> Column:
    """Per-record arrival time, e.g. a message timestamp column."""
    return L.epoch_seconds(ts)


def with_metadata(df: DataFrame, stream: str, source: str | None = None,
                  fetched_at: Column | float | None = None) -> DataFrame:
    """Prepend ``_fetched_at`` and ``_source``; a record's own values win."""
    cols = df.columns
    if "_fetched_at" in cols:
        fa = F.col("_fetched_at")
    elif isinstance(fetched_at, Column):
        fa = fetched_at
    else:
        fa = stamp_batch(fetched_at)
    src = F.col("_source") if "_source" in cols else F.lit(resolve_source(source, stream))
    rest = [c for c in cols if c not in META_COLS]
    return df.select(fa.cast("double").alias("_fetched_at"), src.cast("string").alias("_source"), *rest)


def with_label(df: DataFrame, daily: bool = False, col: str = "label") -> DataFrame:
    """Rotation label derived from ``_fetched_at`` (so a record can never sit in
    the wrong hour, unlike a label taken after the timestamp)."""
    return df.withColumn(col, L.rotation_label(L.from_epoch_seconds("_fetched_at"), daily))


def json_lines(df: DataFrame, stream: str, daily: bool = False, source: str | None = None,
               fetched_at: Column | float | None = None) -> DataFrame:
    """Records -> ``(label, value)`` JSON lines with metadata first; null fields kept
    as ``null`` so key presence survives landing."""
    out = with_label(with_metadata(df, stream, source, fetched_at), daily)
    body = [c for c in out.columns if c != "label"]
    return out.select("label", F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("value"))


def non_empty_batch(df: DataFrame) -> bool:
    """True when the batch has a record (F9): callers write nothing, not even a folder, otherwise.

    Stops at the first record it finds.
    """
    return not df.isEmpty()


def _batch_mark(raw_root: str, state: str, stream: str, batch: str) -> str:
    return f"{raw_root}/{inv.LANDED_DIR}/{state}/{stream.replace('/', '%2F')}/{batch}"


def open_batches(spark: SparkSession, raw_root: str) -> list[tuple[str, str]]:
    """(stream, batch) of the batches whose landing has begun and not ended."""
    root = f"{raw_root.rstrip('/')}/{inv.LANDED_DIR}/open"
    return [(s.replace("%2F", "/"), b) for s in inv.child_names(spark, root) for b in inv.child_names(spark, f"{root}/{s}")]


def land_lines(lines: DataFrame, raw_root: str, stream: str, batch: str | None = None) -> str:
    """Append ``(label, value)`` lines under ``<raw_root>/<stream>/label=<label>/`` (K1, K2).

    One Spark job = one atomic batch. The write is rebalanced on the label so a
    hot hour is split across tasks by AQE instead of landing in one task, and
    small batches are coalesced into few files.

    With a ``batch`` id the batch lands once however often it is sent: a write log
    under ``_landed`` is asked first, and an attempt that was cut short is replaced,
    because its lines lie in ``slice=<batch>`` folders of their own. Compaction
    leaves labels alone that an unfinished batch has written to.
    """
    raw_root = raw_root.rstrip("/")
    path = f"{raw_root}/{stream}"
    rows = lines.select("label", "value")
    if batch is None:
        rows.hint("rebalance", "label").write.mode("append").partitionBy("label").text(path)
        return path
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
        raise ValueError(f"batch id {batch!r} is not a plain name")
    spark = lines.sparkSession
    done, begun = (_batch_mark(raw_root, state, stream, batch) for state in ("done", "open"))
    if not inv.exists(spark, done):
        inv.write_text_file(spark, begun, "")
        (rows.withColumn("slice", F.lit(batch)).hint("rebalance", "label").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("label", "slice").text(path))
        inv.write_text_file(spark, done, "")
    inv.delete_paths(spark, [begun])
    return path


def land_jsonl(df: DataFrame, raw_root: str, stream: str, daily: bool = False,
               source: str | None = None, fetched_at: Column | float | None = None, batch: str | None = None) -> str:
    """Append records as JSON lines under their rotation label (K1, K2); ``batch`` as in ``land_lines``."""
    return land_lines(json_lines(df, stream, daily, source, fetched_at), raw_root, stream, batch)


def with_defaults_json(record: Column | str, defaults: list[tuple[str, Column]], parsed: Column | None = None) -> Column:
    """``{**defaults, **record}`` on JSON text: keys come first, the record's own values win.

    The defaults are spliced into the record's text, so what the feed sent (digits
    of long numbers, repeated keys) stays as it was. ``parsed`` is the record as a
    VARIANT where an earlier projection has it; the text is then not parsed again.
    """
    rec = J.stripped(record)
    if parsed is None:
        own = J.object_keys(rec)
        parts = [F.when(~F.array_contains(own, k), _json_entry(k, c)) for k, c in defaults]
    else:
        parts = [F.when(~J.has_field(parsed, k), _json_entry(k, c)) for k, c in defaults]
    head = F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != "")), ",")
    body = F.substring(rec, F.lit(2), F.length(rec))
    return (F.when(head == "", rec)
            .when(rec.rlike(r"^\{\s*\}$"), F.concat(F.lit("{"), head, F.lit("}")))
            .otherwise(F.concat(F.lit("{"), head, F.lit(","), F.ltrim(body))))


def _json_entry(key: str, value: Column) -> Column:
    """``"key":value`` as JSON text; empty for a null value."""
    text = F.to_json(F.struct(value.alias(key)))
    return F.substring(text, F.lit(2), F.length(text) - 2)


def metadata_json(record: Column | str, fetched_at: Column, source: Column, parsed: Column | None = None) -> Column:
    """JSON text ``{"_fetched_at":…, "_source":…, **record}``: the record's own keys win."""
    return with_defaults_json(record, [("_fetched_at", fetched_at.cast("double")),
                                       ("_source", source.cast("string"))], parsed)


def tag_key(record: Column | str, key: str, value: Column) -> Column:
    """``{key: value, **payload}``: the id is added, the payload's own value wins (P10)."""
    return with_defaults_json(record, [(key, value)])


def wrap_non_object(record: Column | str, key: str, value: Column, data_key: str = "data") -> Column:
    """Object entries are tagged (P10); anything else becomes ``{key: value, "data": entry}``."""
    r = J._c(record)
    wrapped = F.concat(F.lit("{"), _json_entry(key, value), F.lit(f',"{data_key}":'), J.stripped(r), F.lit("}"))
    return F.when(J.json_shape(r) == "object", tag_key(r, key, value)).otherwise(wrapped)
