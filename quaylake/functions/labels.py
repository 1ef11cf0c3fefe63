"""Time labels and path parts (Column builders, all JVM-side).

Fixed formats that must equal the reference's file naming:
  hour label ``yyyy-MM-dd'T'HH``  (e.g. ``2026-03-01T15``)
  day label  ``yyyy-MM-dd``       (e.g. ``2026-03-01``)
  a label without ``T`` is a daily file and compacts to hour ``00``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_FMT = "yyyy-MM-dd'T'HH"
DAY_FMT = "yyyy-MM-dd"
LABEL_RE = r"^\d{4}-\d{2}-\d{2}(T\d{2})?$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_timestamp(ts: Column | str) -> Column:
    """Event-time column as a zone-aware TIMESTAMP (test tables hold TIMESTAMP_NTZ)."""
    return _c(ts).cast("timestamp")


def epoch_seconds(ts: Column | str) -> Column:
    """Unix seconds as DOUBLE, the type of ``_fetched_at``."""
    return F.unix_micros(as_timestamp(ts)) / F.lit(1_000_000.0)


def from_epoch_seconds(fetched_at: Column | str) -> Column:
    return F.timestamp_seconds(_c(fetched_at))


def hour_label(ts: Column | str) -> Column:
    return F.date_format(as_timestamp(ts), HOUR_FMT)


def day_label(ts: Column | str) -> Column:
    return F.date_format(as_timestamp(ts), DAY_FMT)


def rotation_label(ts: Column | str, daily: bool = False) -> Column:
    return day_label(ts) if daily else hour_label(ts)


def hour_boundary(ts: Column | str) -> Column:
    return F.date_trunc("hour", as_timestamp(ts))


def day_boundary(ts: Column | str) -> Column:
    return F.date_trunc("day", as_timestamp(ts))


def next_hour(ts: Column | str) -> Column:
    """Start of the next hour; correct across day and month ends."""
    return hour_boundary(ts) + F.expr("INTERVAL 1 HOUR")


def label_dt(label: Column | str) -> Column:
    return F.substring(_c(label), 1, 10)


def label_hour(label: Column | str) -> Column:
    """Text after the ``T`` for hourly labels, ``"00"`` for daily labels."""
    lab = _c(label)
    return F.when(lab.contains("T"), lab.substr(F.lit(12), F.length(lab))).otherwise(F.lit("00"))


def valid_label(label: Column | str) -> Column:
    return _c(label).rlike(LABEL_RE)


def stream_of_path(path: Column | str, raw_root: str) -> Column:
    """Stream name = the part between ``raw_root`` and ``/label=…`` (or the file name).

    Routed frames live under ``channel=<c>/route=<key>/label=…`` -> ``<c>/<key>``.
    A path outside ``raw_root`` has the stream ``""``.
    """
    root = re.sub(r"^file:/+", "/", raw_root).rstrip("/") + "/"
    p = F.regexp_replace(_c(path), r"^file:/+", "/")
    inside = F.when(F.startswith(p, F.lit(root)), F.substring(p, F.lit(len(root) + 1), F.length(p))).otherwise(F.lit(""))
    in_label_dir = F.regexp_replace(
        F.regexp_extract(inside, r"^(.+?)/label=[^/]+/", 1), r"(channel|route)=", "")
    flat = F.regexp_extract(inside, r"^(.+)/[^/]+$", 1)
    return F.when(in_label_dir != "", in_label_dir).otherwise(flat)


def label_of_path(path: Column | str) -> Column:
    """Label from a ``label=`` directory, else the file stem (``2026-03-01T15.jsonl``)."""
    p = _c(path)
    from_dir = F.regexp_extract(p, r"/label=([^/]+)/", 1)
    stem = F.regexp_extract(p, r"/([^/]+?)(\.[^./]*)?$", 1)
    return F.when(from_dir != "", from_dir).otherwise(stem)
