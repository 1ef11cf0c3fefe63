"""File-system listing (S5) and deletes through the Hadoop FileSystem API.

Works for any Hadoop-compatible store (local, HDFS, object stores). Listing is
metadata only: one row per landed file, never file contents.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.functions import labels as L

INVENTORY_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("size", T.LongType(), False),
    T.StructField("mtime_ms", T.LongType(), False),
])
ENTRY_SCHEMA = "path STRING, is_dir BOOLEAN, size BIGINT, mtime_ms BIGINT"
# under a raw root: what batches wrote, and which of them are finished
LANDED_DIR = "_landed"


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm


def _fs(spark: SparkSession, path: str):
    jvm = _jvm(spark)
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jpath.getFileSystem(conf), jpath


def norm_path(path: Column | str) -> Column:
    """Comparable path text: ``file:///x``, ``file:/x`` and ``/x`` all become ``/x``."""
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(c, r"^file:/+", "/")


def norm_path_py(path: str) -> str:
    import re
    return re.sub(r"^file:/+", "/", path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as listings name it, with its file system unless that is the local one."""
    fs, jpath = _fs(spark, path)
    return norm_path_py(fs.makeQualified(jpath).toString()).rstrip("/")


def _hidden(path: str, root: str) -> bool:
    """True when the file, or a folder between it and ``root``, is a marker or not for readers."""
    inside = path[len(root):] if path.startswith(root) else path.rsplit("/", 1)[-1]
    return any(part.startswith((".", "_")) for part in inside.split("/"))


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def list_files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ()) -> list[tuple[str, int, int]]:
    """Recursive listing (path, size, mtime ms), hidden and marker files skipped.

    Zero-length files are included (a ``binaryFile`` read would hide them).
    """
    fs, jpath = _fs(spark, root)
    if not fs.exists(jpath):
        return []
    out, base = [], qualified(spark, root)
    it = fs.listFiles(jpath, True)
    while it.hasNext():
        st = it.next()
        path = norm_path_py(st.getPath().toString())
        if not _hidden(path, base) and (not suffixes or path.endswith(suffixes)):
            out.append((path, int(st.getLen()), int(st.getModificationTime())))
    return out


def metadata_path() -> Column:
    """Plain path of a row's file: the metadata column holds it as an encoded URI."""
    uri = F.col("_metadata.file_path")
    # a column of every row: decoded only where something is encoded
    return norm_path(F.when(uri.contains("%"), F.url_decode(F.regexp_replace(uri, r"\+", "%2B"))).otherwise(uri))


def has_data(spark: SparkSession, root: str) -> bool:
    """True when a data file lies under ``root``."""
    fs, jpath = _fs(spark, root)
    it, base = fs.listFiles(jpath, True), qualified(spark, root)
    while it.hasNext():
        if not _hidden(norm_path_py(it.next().getPath().toString()), base):
            return True
    return False


def scan_listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, size, mtime_ms) of the non-empty files under ``paths``: a ``binaryFile`` scan that reads no contents."""
    if not paths:
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return scan.select(norm_path("path").alias("path"), F.col("length").alias("size"),
                       F.unix_millis("modificationTime").alias("mtime_ms"))


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, mtime_ms) of every data file under ``root``, listed by Spark.

    Non-empty files come from a column-pruned ``binaryFile`` scan (file contents
    are never read; listing is parallel for large trees). That source skips
    zero-length files, so those come from the landing log kept under ``root``.
    """
    if not exists(spark, root):
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    found = scan_listing(spark, [root]) if has_data(spark, root) else spark.createDataFrame([], INVENTORY_SCHEMA)
    empty = logged_files(spark, root).where(F.col("size") == 0).join(found.select("path"), "path", "left_anti")
    return found.unionByName(empty.select(*found.columns))


def log_files(files: DataFrame, raw_root: str, batch: str) -> None:
    """Add (path, size, mtime_ms) of the files that ``batch`` wrote to the landing log; again replaces its entry."""
    (files.select(norm_path("path").alias("path"), F.col("size").cast("long"), F.col("mtime_ms").cast("long"))
     .write.mode("overwrite").parquet(f"{raw_root.rstrip('/')}/{LANDED_DIR}/files/batch={batch}"))


def trim_log(spark: SparkSession, raw_root: str, gone: DataFrame) -> None:
    """Rewrite the landing log without the files of the label entries ``gone`` (path, before_ms) written up to then.

    What is left is about files that still wait for compaction, so the log does not
    grow with the history. Interrupted halfway it names some files twice, which
    ``logged_files`` reads as once.
    """
    path = f"{raw_root.rstrip('/')}/{LANDED_DIR}/files"
    batches = list_dirs(spark, path)
    if not batches:
        return
    log = logged_files(spark, raw_root).withColumn("entry", F.regexp_extract("path", r"^(.*/label=[^/]+)/", 1))
    log = log.withColumn("entry", F.when(F.col("entry") != "", F.col("entry")).otherwise(F.col("path")))
    left = log.alias("f").join(gone.alias("g"), F.expr("f.entry = g.path AND f.mtime_ms <= g.before_ms"), "left_anti")
    log_files(left.select("path", "size", "mtime_ms"), raw_root, f"trim-{uuid.uuid4().hex[:12]}")
    delete_paths(spark, [f"{b}/" for b in batches])


def logged_files(spark: SparkSession, raw_root: str) -> DataFrame:
    """Files in the landing log, each once as it was last written. Files that compaction removed are still named."""
    path = f"{raw_root.rstrip('/')}/{LANDED_DIR}/files"
    if not exists(spark, path):
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    log = spark.read.schema(INVENTORY_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    last = F.max_by(F.struct("size", "mtime_ms"), F.struct("mtime_ms", "size"))
    return log.groupBy("path").agg(last.alias("x")).select("path", "x.size", "x.mtime_ms")


def raw_inventory(spark: SparkSession, raw_root: str) -> DataFrame:
    """Landed raw files with stream, label and validity, ordered by path."""
    df = file_listing(spark, raw_root)
    return (df.withColumn("stream", L.stream_of_path("path", raw_root))
              .withColumn("label", L.label_of_path("path"))
              .withColumn("mtime", F.timestamp_millis("mtime_ms"))
              .withColumn("valid_label", L.valid_label("label"))
              .orderBy("path"))


def label_entries(spark: SparkSession, raw_root: str) -> DataFrame:
    """One row per label of a stream: its ``label=`` folder, or its flat file (path, is_dir, size, mtime_ms, stream, label).

    The walk stops at the label folders, so the driver makes one listing per stream
    folder and holds one row per label, whatever the number of files in them.
    """
    fs, jpath = _fs(spark, raw_root)
    rows, todo = [], [jpath] if fs.exists(jpath) else []
    while todo:
        for st in fs.listStatus(todo.pop()):
            p = st.getPath()
            name, is_dir = p.getName(), st.isDirectory()
            if name.startswith((".", "_")):
                continue
            if is_dir and not name.startswith("label="):
                todo.append(p)
            else:
                rows.append((norm_path_py(p.toString()), is_dir, 0 if is_dir else int(st.getLen()),
                             int(st.getModificationTime())))
    df = spark.createDataFrame(rows, ENTRY_SCHEMA)
    inside = F.when(F.col("is_dir"), F.concat("path", F.lit("/"))).otherwise(F.col("path"))
    return (df.withColumn("stream", L.stream_of_path(inside, raw_root)).withColumn("label", L.label_of_path(inside)))


def delete_paths(spark: SparkSession, paths: Iterable[str], recursive: bool = False) -> int:
    """Delete files (and directories given with a trailing ``/``), one at a time as they come."""
    n = 0
    fs = None
    for p in paths:
        if fs is None:
            fs, _ = _fs(spark, p)
        is_dir = p.endswith("/")
        if fs.delete(_jvm(spark).org.apache.hadoop.fs.Path(p.rstrip("/")), recursive or is_dir):
            n += 1
    return n


def write_text_file(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """Small driver-side file write (state pointers, fixtures)."""
    fs, jpath = _fs(spark, path)
    out = fs.create(jpath, overwrite)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text_file(spark: SparkSession, path: str) -> str | None:
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return None
    jvm = _jvm(spark)
    stream = fs.open(jpath)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, jsrc = _fs(spark, src)
    _, jdst = _fs(spark, dst)
    return bool(fs.rename(jsrc, jdst))


def list_dirs(spark: SparkSession, root: str) -> list[str]:
    fs, jpath = _fs(spark, root)
    if not fs.exists(jpath):
        return []
    return [norm_path_py(st.getPath().toString()) for st in fs.listStatus(jpath) if st.isDirectory()]


def folders_of(spark: SparkSession, root: str) -> set[str]:
    """Folders under ``root`` that hold a data file."""
    return {p.rsplit("/", 1)[0] for p, _, _ in list_files(spark, root)}


def child_names(spark: SparkSession, root: str) -> list[str]:
    """Names of what lies directly under ``root``."""
    fs, jpath = _fs(spark, root)
    return [st.getPath().getName() for st in fs.listStatus(jpath)] if fs.exists(jpath) else []


def mkdirs(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.mkdirs(jpath))
