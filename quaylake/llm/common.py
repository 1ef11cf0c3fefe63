"""Helpers shared by the text operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.session import scratch_dir

# the six ASCII white-space characters that separate words
SPACE_CLASS = r"[\x20\x09-\x0D]"
NON_SPACE_CLASS = r"[^\x20\x09-\x0D]"
WORD_PATTERN = NON_SPACE_CLASS + "+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
FOLDS = 5
# a batch passes through several copies on both sides of the Python worker; the default is 64 MB
BATCH_BYTES = "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the cluster's shared folder and read it back.

    Cuts the lineage with a plain table that every executor can read, so a lost
    executor costs only the tasks that were running on it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """True for the rows that no model may learn from: crc32(doc_id as text) mod folds = 0."""
    key = F.coalesce(doc_id.cast("string"), F.lit(""))
    return (F.crc32(key.cast("binary")) % F.lit(folds)) == 0


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """One label per document: rows repeated for a doc_id agree on the smallest non-null value."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull())
            .groupBy("doc_id").agg(F.min(name).cast("int").alias("label")))


def vocabulary_path(name: str) -> str:
    """Place of a public tokenizer file; the folder is a parameter of the environment's package."""
    import public_tokenizers
    path = public_tokenizers.path(name)
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    return path


def hashed_sample(ids: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` rows (doc_id, label) of each label value 0 and 1, by a hash of the id.

    Bounded by ``2 * per_class`` rows of two numbers, so it may be broadcast.
    """
    picked = [ids.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
              for label in (0, 1)]
    return picked[0].unionByName(picked[1]).select("doc_id", "label")


def training_ids(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, label) of all documents labelled 0 or 1 outside the held-out fold."""
    return one_label(labels, name).where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))


def training_rows(docs: DataFrame, labels: DataFrame, name: str, per_class: int) -> DataFrame:
    """(doc_id, text, label) of a bounded labelled sample outside the held-out fold."""
    ids = training_ids(labels, name)
    return docs.select("doc_id", "text").join(F.broadcast(hashed_sample(ids, per_class)), "doc_id")


def sigmoid(x):
    import numpy as np
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def share_code(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library from where the driver has it, and bound the batches they get.

    Where the library is installed on the workers, or shipped with ``--py-files``,
    the import path changes nothing.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def keep_rows(docs: DataFrame, decide, text: str = "text") -> DataFrame:
    """The rows whose text ``decide`` accepts, with all their columns, in one pass without a shuffle.

    ``decide()`` is called once per task and returns a function from a list of
    texts (None for null) to a list of booleans.
    """
    position = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa
        accept = decide()
        for batch in batches:
            mask = pa.array(accept(batch.column(position).to_pylist()), pa.bool_())
            yield batch.filter(mask)

    return docs.mapInArrow(run, docs.schema)
