"""One huge file read by many tasks, where a record may cross any byte range.

Spark's text source splits a file at a separator the format has often (``}`` or
a line break). What a byte range means depends on the ranges before it: whether
it begins inside a quoted text, how deep it is nested. So files are read twice:

1. every range tells, for each way it may be entered, how it is left, one
   narrow row a range; running windows per file turn these into the entry state
   and first byte of every range;
2. every range, knowing its state, emits its records. A record that crosses
   ranges leaves a piece in each; only such pieces are shuffled and joined.

Any path that Spark reads will do. Both passes must see the same ranges: a task
that meets a range the first pass did not see fails with the setting to fix.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featureflow.session import checkpoint_dir, workers_import

# Entry states (one narrow row a range) that may be broadcast: some 60 MB.
MOST_RANGES = 400_000
COMPRESSED = (".gz", ".gzip", ".bz2", ".zst", ".zstd", ".lz4", ".snappy", ".deflate")

PIECES = "_doc string, _ord long, piece binary, continued boolean, ended boolean, head boolean, final boolean, shell boolean"


def tokens(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``_doc, _range, _size, value``: what stands between separators, in the order of the file within a task."""
    workers_import(spark)
    return spark.read.option("lineSep", sep).text(path).select(
        F.col("_metadata.file_path").alias("_doc"), F.col("_metadata.file_block_start").alias("_range"),
        F.col("_metadata.file_size").alias("_size"), F.col("value").cast("binary").alias("value"))


def refuse_compressed(spark: SparkSession, path: str) -> None:
    bad = [n for n in spark.read.text(path).inputFiles() if n.lower().endswith(COMPRESSED)]
    if bad:
        raise ValueError(f"{bad[0]} is compressed and cannot be split")


def surveyed(toks: DataFrame, survey, schema: str) -> DataFrame:
    """The first pass, run now and kept in the shared folder: one narrow row a range."""
    path = f"{checkpoint_dir(toks.sparkSession).rstrip('/')}/featureflow-ranges/{uuid.uuid4().hex}"
    # narrow rows, brought together so that there are few files
    toks.mapInArrow(survey, schema).repartition("_doc").write.parquet(path)
    return toks.sparkSession.read.schema(schema).parquet(path)


def runs(batches: Iterator, sep: bytes) -> Iterator[tuple[dict, bytes, bool, bool]]:
    """``(other columns, bytes, first, last)``: the text of each range in bounded parts, separators put back."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        docs = batch.column("_doc").dictionary_encode().indices.to_numpy()
        starts = batch.column("_range").to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(docs) != 0) | (np.diff(starts) != 0)) + 1).tolist(), len(docs)]
        for lo, hi in zip(cuts, cuts[1:]):
            row = {n: batch.column(n)[lo].as_py() for n in batch.schema.names if n != "value"}
            text = sep.join(batch.column("value").slice(lo, hi - lo).to_pylist()) + sep
            fresh = held is None or (held[0]["_doc"], held[0]["_range"]) != (row["_doc"], row["_range"])
            if held:
                yield (*held, fresh)
            held = (row, text, fresh)
    if held:
        yield (*held, True)


def first_bytes(ranges: DataFrame) -> DataFrame:
    """Adds ``start``, the range's first byte, and ``cut``: the file does not end with a separator.

    The reader skips a byte order mark, so it is not counted.
    """
    before = Window.partitionBy("_doc").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_doc")
    total = F.sum("bytes").over(whole)
    return ranges.select("*", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"),
                         ((F.col("_range") == F.max("_range").over(whole)) & (total - F.col("_size")).isin(1, -2)).alias("cut"))


def with_states(toks: DataFrame, states: DataFrame) -> DataFrame:
    """Every token with the entry state of its range, still in the order of the file within a task.

    States are broadcast up to ``MOST_RANGES`` of them; beyond, whole ranges are shuffled and sorted.
    """
    keys = ["_doc", "_range"]
    toks = toks.drop("_size")
    if states.limit(MOST_RANGES + 1).count() <= MOST_RANGES:
        return toks.join(F.broadcast(states), keys, "left")
    placed = toks.withColumn("_n", F.monotonically_increasing_id()).join(states, keys, "left")
    return placed.repartition(*keys).sortWithinPartitions(*keys, "_n").drop("_n")


def known(row: dict) -> dict:
    if row["start"] is None:
        raise RuntimeError("the byte ranges of a file differ between two passes: set spark.sql.files.minPartitionNum "
                           "to a fixed number, so that they do not follow the number of executors")
    return row


def in_order(text: Column, *places: str) -> Column:
    """Aggregate: the texts of a group joined in the order of their places."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*places, text.alias("t")))), lambda x: x["t"]), "")


def stitched(pieces: DataFrame) -> DataFrame:
    """``_doc, _ord, text, ended, head, final``: whole records, those in pieces joined.

    A piece that is not ``continued`` begins a record, one that is ``ended`` ends it; ``head`` and ``final`` mark
    the first and last record of their list.
    """
    whole = ~F.col("continued") & F.col("ended")
    text = F.col("piece").cast("string")
    done = pieces.where(whole).select("_doc", "_ord", text.alias("text"), "ended", "head", "final")
    # of two pieces at one place the first is the empty end of its range; a record begins where a piece is not continued; only pieces of records that cross ranges come here
    begun = Window.partitionBy("_doc").orderBy("_ord", "continued").rowsBetween(Window.unboundedPreceding, 0)
    parts = pieces.where(~whole).withColumn("_r", F.sum(F.when(F.col("continued"), 0).otherwise(1)).over(begun))
    flags = [F.max(c).alias(c) for c in ("ended", "head", "final")]
    crossing = parts.groupBy("_doc", "_r").agg(F.min("_ord").alias("_ord"), in_order(text, "_ord", "continued").alias("text"), *flags)
    return done.unionByName(crossing.drop("_r"))
