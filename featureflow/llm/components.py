"""Connected components of an edge list, distributed, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import stored


def _state(df: DataFrame) -> tuple:
    r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that an edge names, root being the least node reachable.

    Each round links every node to the least of its neighbourhood; it ends when
    the edges are stars, after about log(n) rounds whatever the links' shape.
    Only a count and a checksum reach the driver.
    """
    now = stored(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u <> v").distinct(), "cc")
    before = _state(now)
    while before[0]:
        now = stored(_small_star(_large_star(now)), "cc")
        state = _state(now)
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
