"""Scans of landed and compacted data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from quaylake.functions import jsonfn as J
from quaylake.session import apply_conf
from quaylake.sources import inventory as inv


def scan_jsonl(spark: SparkSession, paths: list[str] | str, schema: StructType,
               with_quarantine: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Error-tolerant NDJSON read with an explicit schema.

    Good lines become typed rows; lines that are not one strict JSON object go
    to the second DataFrame when ``with_quarantine`` (raw text + file path).
    """
    text = spark.read.text(paths).select(
        inv.metadata_path().alias("path"), F.col("value").alias("raw"))
    text = text.where(J.from_first("raw") != "")
    good = J.strict_json("raw") & (J.json_shape("raw") == "object")
    rows = text.where(good).select(F.from_json("raw", schema).alias("r")).select("r.*")
    if not with_quarantine:
        return rows
    bad = text.where(~good).select("path", J.preview("raw").alias("preview"), "raw")
    return rows, bad


def scan_table(spark: SparkSession, table_root: str, stream: str, keep_src: bool = False) -> DataFrame:
    """Compacted stream table with string ``dt`` / ``hour`` partition columns.

    The columns are those recorded at compaction, never inferred: files written
    before a column was declared give nulls for it. Every row is seen once, at the
    newest version of the run log: not the rows of a run that still writes, and of a
    merge and what it replaced only the one side. ``keep_src`` adds the source file
    id and the run.
    """
    from quaylake.operators.compact import stream_schema
    from quaylake.operators.runlog import visible
    from quaylake.specs import spec_for
    apply_conf(spark)
    path = f"{table_root.rstrip('/')}/{stream}"
    schema = stream_schema(spark, path)
    if schema is None:
        # nothing compacted yet: the declared columns
        schema = T.StructType([*spec_for(stream).schema.fields,
                               T.StructField("_extra", T.MapType(T.StringType(), T.VariantType())),
                               T.StructField("_cast_errors", T.ArrayType(T.StringType())),
                               T.StructField("src", T.StringType())])
    parts = [T.StructField(c, T.StringType()) for c in ("dt", "hour", "run")]
    schema = T.StructType([*schema.fields, *parts])
    df = (visible(spark.read.option("basePath", path).schema(schema).parquet(path), table_root, stream)
          if inv.exists(spark, path) else spark.createDataFrame([], schema)).select(*schema.names)
    return df if keep_src else df.drop("src", "run")


def scan_dt(spark: SparkSession, table_root: str, stream: str, day: str) -> DataFrame:
    """One date partition; the predicate reaches the scan as a PartitionFilter."""
    return scan_table(spark, table_root, stream).where(F.col("dt") == F.lit(day))


def scan_hour_files(spark: SparkSession, root: str, stream: str, schema: StructType | str | None = None) -> DataFrame:
    """Reader for the original layout ``<stream>/dt=…/hour=HH.parquet`` (S3), where
    ``hour`` is a file name, or a folder of files with such a name.

    The columns are ``schema`` or those declared for the stream, never inferred from
    one of the files; ``dt`` stays a partition column, so predicates on it prune.
    """
    from quaylake.specs import spec_for
    apply_conf(spark)
    path = f"{root.rstrip('/')}/{stream}"
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    fields = (schema or spec_for(stream).schema).fields
    days = [f"{path}/{d}" for d in inv.child_names(spark, path) if d.startswith("dt=")]
    columns = T.StructType([*fields, T.StructField("dt", T.StringType()), T.StructField("hour", T.StringType())])
    if not days:
        return spark.createDataFrame([], columns)
    # a folder hour=HH.parquet is a partition too, a file is not: its name has the hour in both cases
    df = spark.read.option("basePath", path).schema(columns).parquet(path)
    hour = F.regexp_extract(inv.metadata_path(), r"/hour=(\d\d)[^/]*(?:/[^/]*)?$", 1)
    return df.withColumn("hour", hour)
