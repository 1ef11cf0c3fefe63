"""Collector state as versioned tables (K9).

State = id sets ``(kind, id, first_seen)``, last fetch per source and an ingest
cursor. Each save writes what changed to a new version directory, then publishes
a new small pointer file that names the place of every table,
``_CURRENT-<millis>-<version>`` (created, never overwritten); a reader follows the
newest pointer, so it sees either the old or the new version and never a missing
one. Older pointers and versions are pruned after. Missing, unreadable or
malformed state loads as empty tables of the right schema. Saving unchanged state
is a no-op.

The id sets are a log: the pointer names a base and the deltas since, each with
the ids that came, changed or went. A save writes its delta alone; after
``MERGE_AFTER`` deltas the next save writes a new base instead.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.sources import inventory as inv

IDS_SCHEMA = "kind STRING, id STRING, first_seen DOUBLE"
LAST_FETCH_SCHEMA = "source STRING, last_fetch DOUBLE"
CURSOR_SCHEMA = "name STRING, item_offset BIGINT, completed BOOLEAN"
DELTA_SCHEMA = IDS_SCHEMA + ", removed BOOLEAN"
POINTER = "_CURRENT"
MERGE_AFTER = 8


def _pointers(spark: SparkSession, root: str) -> list[str]:
    fs, jpath = inv._fs(spark, root)
    if not fs.exists(jpath):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(jpath)]
    return sorted(n for n in names if n.startswith(POINTER))


def read_pointer(spark: SparkSession, root: str) -> dict | None:
    names = _pointers(spark, root)
    if not names:
        return None
    text = inv.read_text_file(spark, f"{root}/{names[-1]}")
    if text is None:
        return None
    try:
        obj = json.loads(text)
    except ValueError:
        return None
    fits = isinstance(obj, dict) and isinstance(obj.get("tables"), dict) and all(
        isinstance(t, dict) and isinstance(t.get("parts"), list) for t in obj["tables"].values())
    return obj if fits else None


SCHEMAS = {"ids": IDS_SCHEMA, "last_fetch": LAST_FETCH_SCHEMA, "cursor": CURSOR_SCHEMA}


def _ids(spark: SparkSession, root: str, entry: dict | None) -> DataFrame:
    """The id sets that a pointer's entry names: its parts in order, a later one wins."""
    paths = [f"{root}/{p}" for p in (entry or {}).get("parts", [])]
    if not all(inv.exists(spark, p) for p in paths):
        paths = []
    parts = [spark.read.schema(DELTA_SCHEMA).parquet(p).withColumn("part", F.lit(i)) for i, p in enumerate(paths)]
    if not parts:
        return spark.createDataFrame([], IDS_SCHEMA)
    log = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:
        last = F.max_by(F.struct("first_seen", "removed"), "part")
        log = log.groupBy("kind", "id").agg(last.alias("x")).select("kind", "id", "x.first_seen", "x.removed")
    return log.where(~F.coalesce("removed", F.lit(False))).select("kind", "id", "first_seen")


def id_changes(known: DataFrame, given: DataFrame) -> DataFrame:
    """What turns ``known`` into ``given``: new and changed ids, and removed ones (kind, id, first_seen, removed).

    An id that is given twice counts with its earliest sighting.
    """
    rows = given.select("kind", "id", "first_seen", F.lit(True).alias("new")).unionByName(
        known.select("kind", "id", "first_seen", F.lit(False).alias("new")))
    both = rows.groupBy("kind", "id").agg(
        F.bool_or("new").alias("in_new"), F.bool_or(~F.col("new")).alias("in_old"),
        F.min(F.when(F.col("new"), F.col("first_seen"))).alias("first_seen"),
        F.min(F.when(~F.col("new"), F.col("first_seen"))).alias("was"))
    changed = ~F.col("in_old") | ~F.col("in_new") | ~F.col("first_seen").eqNullSafe(F.col("was"))
    return both.where(changed).select("kind", "id", "first_seen", (~F.col("in_new")).alias("removed"))


def load_state(spark: SparkSession, root: str, pointer: dict | None = None) -> dict[str, DataFrame]:
    """The newest state, or that of a pointer read before; a table that is missing there is empty."""
    root = root.rstrip("/")
    tables = (pointer or read_pointer(spark, root) or {}).get("tables", {})
    out = {"ids": _ids(spark, root, tables.get("ids"))}
    for name in ("last_fetch", "cursor"):
        path = f"{root}/{tables[name]['parts'][0]}" if name in tables else None
        out[name] = (spark.read.schema(SCHEMAS[name]).parquet(path) if path and inv.exists(spark, path)
                     else spark.createDataFrame([], SCHEMAS[name]))
    return out


def _fingerprint(df: DataFrame) -> str:
    """Order-insensitive content hash, computed by Spark (no rows leave the executors)."""
    h = df.select(F.xxhash64(*[F.col(c) for c in df.columns]).alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
    return f"{h['n']}:{h['s']}"


def _save_ids(spark: SparkSession, root: str, version: str, entry: dict | None, given: DataFrame) -> dict | None:
    """Write the changes of the id sets, or a new base; None when there are none."""
    parts, path = (entry or {}).get("parts", []), f"{version}/ids"
    id_changes(_ids(spark, root, entry), given).write.mode("overwrite").parquet(f"{root}/{path}")
    delta = spark.read.schema(DELTA_SCHEMA).parquet(f"{root}/{path}")
    if entry is not None and delta.isEmpty():
        return None
    if len(parts) < MERGE_AFTER:
        return {"parts": [*parts, path]}
    base = f"{version}/ids-base"
    merged = _ids(spark, root, {"parts": [*parts, path]})
    merged.withColumn("removed", F.lit(False)).write.mode("overwrite").parquet(f"{root}/{base}")
    return {"parts": [base]}


def save_state(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> bool:
    """Write what changed in the given tables as a new version and publish it; False when nothing did.

    Of ``ids``, which is given whole, only new, changed and removed ids are written.
    Other tables are one row per source or name and are written whole; their inputs
    are computed once, the fingerprint is taken from the written files. Tables that
    are not given, or did not change, stay where the previous version has them.
    """
    root = root.rstrip("/")
    ptr = read_pointer(spark, root) or {"tables": {}}
    version = f"v={uuid.uuid4().hex[:12]}"
    current = dict(ptr["tables"])
    for name, df in tables.items():
        if name == "ids":
            entry = _save_ids(spark, root, version, current.get(name), df)
            if entry is not None:
                current[name] = entry
            continue
        path = f"{version}/{name}"
        df.write.mode("overwrite").parquet(f"{root}/{path}")
        mark = _fingerprint(spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{path}"))
        if current.get(name, {}).get("fingerprint") != mark:
            current[name] = {"parts": [path], "fingerprint": mark}
    if current == ptr["tables"]:
        inv.delete_paths(spark, [f"{root}/{version}/"])
        return False
    name = f"{POINTER}-{int(time.time() * 1000):013d}-{version[2:]}"
    inv.write_text_file(spark, f"{root}/{name}", json.dumps({"version": version[2:], "tables": current}))
    # a reader may still be on the previous version: keep what either names
    keep = {p.split("/")[0] for t in [*current.values(), *ptr["tables"].values()] for p in t["parts"]}
    dirs = ((d, d.rstrip("/").rsplit("/", 1)[-1]) for d in inv.list_dirs(spark, root))
    old = [d for d, n in dirs if n.startswith("v=") and n not in keep]
    old += [f"{root}/{p}" for p in _pointers(spark, root) if p != name]
    inv.delete_paths(spark, old, recursive=True)
    return True
