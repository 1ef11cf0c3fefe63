"""Session settings and the shared scratch location.

Every job in the package expects the same handful of SQL settings: UTC session
time (hour/day labels are UTC), Parquet partition columns kept as strings
(``dt``/``hour`` must stay ``"2026-03-01"`` / ``"07"``), dynamic partition
overwrite (compaction rewrites only the slices it owns), case-sensitive column
resolution (feeds carry keys that differ only in case) and AQE.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # writes partitioned by label and hour cost per output file: small batches keep
    # their parallelism instead of being coalesced into one writer task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k",
    # sizes of shuffled data are those of compressed columns of keys and of variants, which take
    # twenty times as much in a task that sorts them
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # folders are listed in a few tasks, not in one task each
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    # keyed state of streams lies on disk, and a checkpoint costs what changed, not what is known
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # feeds may repeat a key; like the collector's decoder, accept it (last wins)
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options the operators rely on (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[8]", app: str = "quaylake",
                  shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's own settings via ``extra``."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**RUNTIME_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_conf(spark)


def shared_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and stream checkpoints.

    Reads the cluster's ``spark.checkpoint.dir``. Without it only a session on
    one machine (master ``local``) may choose a local folder; elsewhere the
    executors could not see it, so that is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        import tempfile
        root = tempfile.mkdtemp(prefix="quaylake-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared root for one run of a job."""
    return f"{shared_root(spark)}/quaylake/{name}-{uuid.uuid4().hex[:12]}"


def observed(seen, name: str, otherwise):
    """A metric of a finished write, or ``otherwise()`` when adaptive execution found the input empty
    and dropped the observed part of the plan."""
    try:
        return seen.get[name]
    except Py4JJavaError:
        return otherwise()


def write_shared(df, name: str):
    """Write ``df`` once under the shared root and read it back.

    For results that several later steps must see identically, such as a
    partition id: nothing depends on whether the optimizer reuses an exchange.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
