"""Log of the runs in flight over a compacted table.

A run writes its rows under ``run=<id>`` partitions. Which of them a reader may
see is decided by one small file, the newest ``_runs/log/<version>.json``: it
names the runs that are not finished, and only those, so its size and the cost
of reading it do not grow with the history of the table.

* ``recorded``: the run may be writing; its partitions are hidden.
* ``committed``: its partitions count. If it is a merge, the partitions that it
  replaces no longer do, whether or not they were deleted yet.
* ``kept``: as committed, its raw sources wait for the raw retention.

A run leaves the log when nothing is left to do for it. Versions are created and
never overwritten; a version that does not parse is still being written, and a
reader takes the one before. One maintenance job works on a table at a time;
readers need no lock.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.sources import inventory as inv

RUNS_DIR = "_runs"
LOG_DIR = f"{RUNS_DIR}/log"
RECORDED, COMMITTED, KEPT = "recorded", "committed", "kept"
REPLACES_SCHEMA = "stream STRING, dt STRING, hour STRING, run STRING"
KEEP_VERSIONS = 10


@dataclass(frozen=True)
class Snapshot:
    """The runs in flight at one version: run id to its entry (kind, state and what the kind needs)."""

    version: int = 0
    runs: dict[str, dict] = field(default_factory=dict)

    def of_state(self, state: str, kind: str | None = None) -> list[str]:
        return sorted(r for r, e in self.runs.items() if e["state"] == state and kind in (None, e["kind"]))


def run_path(table_root: str, run: str, name: str) -> str:
    return f"{table_root.rstrip('/')}/{RUNS_DIR}/{run}/{name}"


def _versions(spark: SparkSession, table_root: str) -> list[str]:
    return sorted(n for n in inv.child_names(spark, f"{table_root.rstrip('/')}/{LOG_DIR}") if n.endswith(".json"))


def snapshot(spark: SparkSession, table_root: str) -> Snapshot:
    """The newest version that is complete."""
    root = f"{table_root.rstrip('/')}/{LOG_DIR}"
    for name in reversed(_versions(spark, table_root)):
        text = inv.read_text_file(spark, f"{root}/{name}")
        try:
            found = json.loads(text or "")
        except ValueError:
            continue
        return Snapshot(found["version"], found["runs"])
    return Snapshot()


def update(spark: SparkSession, table_root: str, change: Callable[[dict[str, dict]], None]) -> Snapshot:
    """Publish the newest version with ``change`` applied to its runs.

    When another writer was faster the change is applied to that version instead.
    """
    root = f"{table_root.rstrip('/')}/{LOG_DIR}"
    while True:
        now = snapshot(spark, table_root)
        runs = {r: dict(e) for r, e in now.runs.items()}
        change(runs)
        names = _versions(spark, table_root)
        version = max([now.version, *(int(n.split(".")[0]) for n in names[-1:])]) + 1
        try:
            inv.write_text_file(spark, f"{root}/{version:012d}.json",
                                json.dumps({"version": version, "runs": runs}), overwrite=False)
        except Py4JJavaError as e:
            if "AlreadyExists" not in str(e.java_exception):
                raise
            continue
        inv.delete_paths(spark, [f"{root}/{n}" for n in names[:-KEEP_VERSIONS]])
        return Snapshot(version, runs)


def set_state(spark: SparkSession, table_root: str, run: str, state: str | None, **more) -> Snapshot:
    """Put the run into ``state``; None takes it out of the log."""
    def change(runs):
        if state is None:
            runs.pop(run, None)
        else:
            runs[run] = {**runs.get(run, {}), **more, "state": state}
    return update(spark, table_root, change)


def replaced(spark: SparkSession, table_root: str, at: Snapshot) -> DataFrame | None:
    """(stream, dt, hour, run) of the partitions that committed merges replace, or None if there is no such merge."""
    paths = [run_path(table_root, r, "replaces") for r in at.of_state(COMMITTED, "merge")]
    return spark.read.schema(REPLACES_SCHEMA).parquet(*paths) if paths else None


def visible(df: DataFrame, table_root: str, stream: str, at: Snapshot | None = None) -> DataFrame:
    """The rows of a stream's table that count at one version; ``df`` has dt, hour and run.

    Unfinished runs are left out by a partition filter. The anti-join is only there
    between the commit of a merge and the removal of what it replaced.
    """
    spark = df.sparkSession
    at = at or snapshot(spark, table_root)
    hidden = at.of_state(RECORDED)
    if hidden:
        df = df.where(~F.col("run").isin(hidden))
    gone = replaced(spark, table_root, at)
    if gone is not None:
        df = df.join(gone.where(F.col("stream") == stream).select("dt", "hour", "run"), ["dt", "hour", "run"], "left_anti")
    return df
