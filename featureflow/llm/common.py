"""Shared helpers: words, scratch tables in the shared folder, table reading."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.session import checkpoint_dir

# A word is a run of anything but ASCII space and tab..carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD_BYTES = rb"[^\x20\x09-\x0D]+"


BATCH_ROWS = 2000


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Where executors have it elsewhere (``--py-files``, an image), the extra path
    does nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)
    # whole texts travel in the batches: fewer rows in each keep a worker's memory small
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a replicated table instead of executor-local blocks,
    so a lost executor costs a re-read and never a recomputation.
    """
    spark = df.sparkSession
    workers_import(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows of a table of keys and numbers that may be broadcast: some 20 MB.
BROADCAST_ROWS = 200_000


def sized(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a stored table, marked for broadcast if it has at most ``limit`` rows.

    Beyond that it is joined by a shuffle, which adaptive execution splits where
    a key is hot.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def crc_bucket(id_col: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id falls in bucket 0."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(buckets)), F.lit(0)).cast("int")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
