"""File sources (S10): metadata and freshness without reading the bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions.freshness import http_date


def file_freshness(spark: SparkSession, path: str) -> DataFrame:
    """``(path, bytes, last_modified)``; the content column is pruned, so nothing is read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path"), F.col("length").alias("bytes"),
                        http_date(F.col("modificationTime")).alias("last_modified"))


def without_text(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    """``(_doc, value)`` with a null value for every file that has no row in ``docs``; scans pass empty files by.

    The names are those of the listing that Spark's driver holds for a scan.
    """
    names = spark.createDataFrame([(n,) for n in spark.read.text(path).inputFiles()], "_doc string")
    # the listing and the scan write one address in two ways: "file:/a b" and "file:///a%20b"
    same = lambda c: F.regexp_replace(F.coalesce(F.try_url_decode(F.regexp_replace(c, "[+]", "%2B")), c), "^([^:/]+):/+", "$1:/")
    seen = docs.select(same(F.col("_doc")).alias("_seen"))
    return names.join(seen, same(F.col("_doc")) == F.col("_seen"), "left_anti").withColumn("value", F.lit(None).cast("string"))
