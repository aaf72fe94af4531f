"""Diff of the current run against the previous run's state.

The previous run is a state table of ``(key, hash)`` per source (keyed) or
``(hash, n)`` (unkeyed), never the old features. Keyed diffs are one full
outer join on the key after both sides are reduced to one row per key, so
hot keys are collapsed by map-side partial aggregation before any shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.functions.predicates import prop

# Fixed value: example ids kept per change bucket.
SAMPLE_LIMIT = 10

OPS = ("added", "removed", "modified", "unchanged")


def feature_key(df: DataFrame, id_property: str | None = None) -> Column:
    """The configured property as text (null = no key), else the top-level id."""
    if id_property is not None:
        if "_props" in df.columns:
            return prop(df, id_property)
        if id_property in df.columns:
            return F.col(f"`{id_property}`").cast("string")
        return F.lit(None).cast("string")
    if "_id" in df.columns:
        return F.col("_id").cast("string")
    return F.lit(None).cast("string")


def with_key(df: DataFrame, id_property: str | None = None) -> DataFrame:
    return df.withColumn("_key", feature_key(df, id_property))


def key_index(keyed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, key, hash, n)``; the last row of a key wins, by document, place in it, and hash.

    The last of these settles equal places, so the winner never depends on the
    order in which rows arrive.
    """
    return (keyed.where(F.col("_key").isNotNull())
            .groupBy(*by, F.col("_key").alias("key"))
            .agg(F.max(place(keyed))["_hash"].alias("hash"), F.count(F.lit(1)).alias("n")))


def place(df: DataFrame) -> Column:
    """A row's place in the input, with its hash as the last resort."""
    return F.struct(*[c for c in ("_doc",) if c in df.columns], "_ord", "_hash")


def duplicate_ids(keyed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Keys seen more than once, with their extra copies."""
    return (key_index(keyed, by).where(F.col("n") > 1)
            .select(*by, "key", (F.col("n") - 1).alias("extra")))


def diff_mode(keyed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Keyed iff the source is non-empty and every row has a key."""
    return keyed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count("_key").alias("with_key"),
        ((F.count(F.lit(1)) > 0) & (F.count("_key") == F.count(F.lit(1)))).alias("keyed"),
    )


def change_feed(current: DataFrame, previous: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, key, op, hash, prev_hash)`` from two key indexes (one row per key each)."""
    cur = current.select(*by, "key", F.col("hash"))
    prev = previous.select(*by, "key", F.col("hash").alias("prev_hash"))
    joined = cur.join(prev, [*by, "key"], "full_outer")
    op = (F.when(F.col("prev_hash").isNull(), F.lit("added"))
          .when(F.col("hash").isNull(), F.lit("removed"))
          .when(F.col("hash") != F.col("prev_hash"), F.lit("modified"))
          .otherwise(F.lit("unchanged")))
    return joined.select(*by, "key", op.alias("op"), "hash", "prev_hash")


def diff_counts(feed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """D3: added / removed / modified / unchanged counts (total = current keys)."""
    return feed.groupBy(*by).agg(*[F.count_if(F.col("op") == o).alias(o) for o in OPS])


def diff_samples(feed: DataFrame, by: Sequence[str] = (), limit: int = SAMPLE_LIMIT) -> DataFrame:
    """The first ``limit`` keys (sorted) of each change bucket.

    ``row_number() <= k`` lets Spark insert a per-partition group limit before
    the shuffle, so each bucket moves at most ``k`` keys per map task.
    """
    changed = feed.where(F.col("op") != "unchanged")
    w = Window.partitionBy(*by, "op").orderBy("key")
    return (changed.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)
            .select(*by, "op", "rank", "key"))


def first_run_samples(keyed: DataFrame, by: Sequence[str] = (), limit: int = SAMPLE_LIMIT) -> DataFrame:
    """On a first run the sample is the first keys in input order."""
    w = Window.partitionBy(*by).orderBy(*[c for c in ("_doc", "_ord", "_hash", "_key") if c in keyed.columns])
    return (keyed.where(F.col("_key").isNotNull()).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= limit).select(*by, F.lit("added").alias("op"), "rank", F.col("_key").alias("key")))


def hash_counts(hashed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Multiset of feature hashes as ``(*by, hash, n)`` (unkeyed state rows)."""
    return hashed.groupBy(*by, F.col("_hash").alias("hash")).agg(F.count(F.lit(1)).alias("n"))


def unkeyed_diff(current: DataFrame, previous: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Multiset diff of ``(hash, n)`` tables; modified is always 0."""
    cur = current.select(*by, "hash", F.col("n").alias("n_cur"))
    prev = previous.select(*by, "hash", F.col("n").alias("n_prev"))
    j = cur.join(prev, [*by, "hash"], "full_outer").na.fill(0, ["n_cur", "n_prev"])
    return j.groupBy(*by).agg(
        F.sum(F.greatest(F.col("n_cur") - F.col("n_prev"), F.lit(0))).cast("long").alias("added"),
        F.sum(F.greatest(F.col("n_prev") - F.col("n_cur"), F.lit(0))).cast("long").alias("removed"),
        F.lit(0).cast("long").alias("modified"),
        F.sum(F.least(F.col("n_cur"), F.col("n_prev"))).cast("long").alias("unchanged"),
    )


def describe(added: Column, removed: Column, modified: Column, total: Column,
             keyed: Column, first_run: Column) -> Column:
    """``+3 / -1 / ~12 (of 480)``, ``no change (n features)``, ``first run, n features``."""
    changed = (added > 0) | (removed > 0) | (modified > 0)
    body = F.concat(F.lit("+"), added.cast("string"), F.lit(" / -"), removed.cast("string"),
                    F.when(keyed, F.concat(F.lit(" / ~"), modified.cast("string"))).otherwise(F.lit("")))
    return (F.when(first_run, F.concat(F.lit("first run, "), total.cast("string"), F.lit(" features")))
            .when(~changed, F.concat(F.lit("no change ("), total.cast("string"), F.lit(" features)")))
            .otherwise(F.concat(body, F.lit(" (of "), total.cast("string"), F.lit(")"))))
