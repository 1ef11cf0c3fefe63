"""Message-frame decoding and routing.

One ``DataFrame -> DataFrame`` transform used unchanged by batch jobs and by
``readStream`` queries. Input columns: ``channel`` (``ws_market`` /
``ws_sports`` / ``ws_rtds``), ``raw`` (frame text), ``_fetched_at`` (arrival,
Unix seconds). Control frames vanish; every other frame yields routed rows or a
quarantine row with a reason, never both and never silently nothing (an empty
list message is the one case that legitimately yields no row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.functions import jsonfn as J
from quaylake.operators.land import metadata_json
from quaylake.specs import CHANNELS, SPECS


def _stream_map():
    return F.create_map(*[F.lit(x) for c in CHANNELS.values() for route, stream in c.streams.items()
                          for x in (f"{c.name}|{route}", stream)])


def _source_map():
    return F.create_map(*[F.lit(x) for c in CHANNELS.values() for stream in c.streams.values()
                          for x in (stream, SPECS[stream].source)])


def with_text(frames: DataFrame) -> DataFrame:
    """Frames whose ``payload`` bytes are their UTF-8 text.

    ``raw`` is the text, null where the bytes are malformed; ``_bytes`` then holds
    all of them as base64. A frame may come with ``raw`` instead of a payload.
    """
    text = F.col("payload").cast("string")
    valid = F.is_valid_utf8(text)
    own = F.col("raw") if "raw" in frames.columns else F.lit(None).cast("string")
    return (frames.withColumn("raw", F.coalesce(own, F.when(valid, text)))
            .withColumn("_bytes", F.when(F.col("payload").isNotNull() & own.isNull() & ~valid, F.base64("payload")))
            .withColumn("_shown", F.when(F.col("_bytes").isNotNull(), F.make_valid_utf8(text))).drop("payload"))


def decode_frames(frames: DataFrame) -> DataFrame:
    """Frames -> one row per message entry with ``route`` or ``reason``.

    Input: channel, ``raw`` text or ``payload`` bytes (or both, one of them null in a
    row), _fetched_at. Output: channel, frame_no (if present), elem_no, elem (JSON
    text), parsed (VARIANT), event_type, route, stream, reason, _fetched_at; ``raw``
    (the whole frame, malformed bytes as base64) and ``preview`` for rejected
    entries. A frame is parsed once; the entries of a list come parsed with it.
    """
    if "payload" in frames.columns:
        frames = with_text(frames)
    else:
        frames = frames.withColumn("_bytes", F.lit(None).cast("string")).withColumn("_shown", F.lit(None).cast("string"))
    keep = [c for c in frames.columns if c not in ("channel", "raw", "_fetched_at", "_bytes", "_shown")]
    pre = frames.where(~J.is_control_frame("channel", "raw")).withColumn("_t", J.stripped("raw"))
    pre = pre.withColumn("_shape", J.json_shape("raw", F.col("_t"))).withColumn("_v", J.parse_one("raw"))
    ch, raw, shape, valid = F.col("channel"), F.col("raw"), F.col("_shape"), F.col("_v").isNotNull()
    is_list_msg = (ch == "ws_market") & valid & (shape == "array")
    entries = F.when(is_list_msg, J.array_entries(raw)) \
        .otherwise(F.array(F.struct(raw.alias("text"), F.col("_v").alias("v"))))
    reason = (F.when(F.col("_bytes").isNotNull(), "bad_utf8").when(~valid, "bad_json")
              .when(is_list_msg, F.lit(None))
              .when(shape != "object", F.when(shape == "array", "list_not_supported")
                    .otherwise("not_object")))
    staged = pre.select(*keep, "channel", "_fetched_at", F.coalesce(raw, "_bytes").alias("_raw"),
                        F.coalesce("_shown", raw).alias("_shown"), is_list_msg.alias("_is_list"), reason.alias("_reason"),
                        F.posexplode(entries).alias("elem_no", "_entry"))
    e, v = F.col("_entry.text"), F.col("_entry.v")
    elem_obj = F.when(F.col("_is_list"), J.json_shape(e) == "object").otherwise(F.lit(True))
    ev_type = F.when(F.col("_is_list") | F.col("_reason").isNotNull(), F.lit(None)) \
        .otherwise(J.detect_event_type(e, v))
    route = (F.when(F.col("_reason").isNotNull(), F.lit(None))
             .when(F.col("_is_list") & ~elem_obj, F.lit(None))
             .when(F.col("_is_list"), F.lit("book"))
             .when(F.col("channel") == "ws_market", J.route_event(ev_type))
             .when(F.col("channel") == "ws_sports", F.lit("events"))
             .when(F.col("channel") == "ws_rtds", J.route_channel(e, v)))
    reason2 = F.coalesce(F.col("_reason"),
                         F.when(F.col("_is_list") & ~elem_obj, F.lit("not_object")),
                         F.when(route.isNull(), F.lit("unknown_channel")))
    out = staged.select(*keep, "channel", "elem_no", F.when(reason2.isNull(), e).alias("elem"),
                        F.when(reason2.isNull(), v).alias("parsed"), ev_type.alias("event_type"), route.alias("route"),
                        reason2.alias("reason"),
                        F.when(reason2.isNotNull(), J.preview("_shown")).alias("preview"),
                        F.when(reason2.isNotNull(), F.col("_raw")).alias("raw"),
                        "_fetched_at")
    stream = F.try_element_at(_stream_map(), F.concat_ws("|", F.col("channel"), F.col("route")))
    return out.withColumn("stream", F.when(F.col("reason").isNull(), stream))


def routed_lines(decoded: DataFrame) -> DataFrame:
    """Good rows as landed JSON lines with metadata prepended (the record's keys win)."""
    good = decoded.where(F.col("reason").isNull())
    src = F.try_element_at(_source_map(), F.col("stream"))
    return good.select("channel", "route", "stream", "_fetched_at",
                       metadata_json("elem", F.col("_fetched_at"), src, F.col("parsed")).alias("line"))


def quarantine_rows(decoded: DataFrame) -> DataFrame:
    """Rejected frames with their whole text; ``preview`` is only there to look at."""
    return decoded.where(F.col("reason").isNotNull()).select(
        "channel", "reason", "preview", "raw", "_fetched_at")
