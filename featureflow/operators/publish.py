"""Sinks (O1-O3): GeoJSON text sequences, summaries, merged sources."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.functions import geo
from featureflow.operators.digest import collection_digest, feature_json


def feature_line(df: DataFrame) -> Column:
    """O1: one GeoJSON Feature per line (RFC 8142 text sequence body), canonical member order."""
    body = feature_json(df)
    return F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit(',"type":"Feature"}'))


def write_features(lines: DataFrame, path: str, partition_by: Sequence[str] = ("_source",)) -> None:
    """O1: write ``(partition cols..., value)`` as text, one directory per source.

    Spark's committer makes the directory appear whole or not at all; the
    manifest row written afterwards is what points readers at it.
    """
    lines.write.mode("overwrite").partitionBy(*partition_by).text(path)


def summary(hashed: DataFrame, by: str = "_source") -> DataFrame:
    """O2: count, bbox, geometry-type histogram, property names and digest per source.

    ``hashed`` carries ``geometry``, ``_hash`` and ``_names`` (the property
    names of each row, an ``array<string>``).
    """
    g = F.col("geometry")
    a, b, c, d = geo.built(geo.bbox_parts)
    kind = F.when(F.schema_of_variant(g).startswith("OBJECT"),
                  F.coalesce(F.try_variant_get(g, "$.type", "string"), F.lit("null"))).otherwise(F.lit("null"))
    base = hashed.select(by, kind.alias("t"), a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d"), "_names")
    # one pass: counts and boxes per type, then per source
    per_type = base.groupBy(by, "t").agg(F.count(F.lit(1)).alias("n"), F.min("a").alias("a"), F.min("b").alias("b"),
                                         F.max("c").alias("c"), F.max("d").alias("d"))
    shapes = per_type.groupBy(by).agg(
        F.min("a").alias("min_lon"), F.min("b").alias("min_lat"), F.max("c").alias("max_lon"), F.max("d").alias("max_lat"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "t", F.col("n").cast("string")))), ",").alias("geometry_types"))
    # equal name lists collapse before they are taken apart
    names = (base.groupBy(by, "_names").agg(F.count(F.lit(1)).alias("n")).select(by, F.explode("_names").alias("name")).distinct()
             .groupBy(by).agg(F.array_join(F.array_sort(F.collect_list("name")), ",").alias("properties")))
    digests = collection_digest(hashed, [by])
    return digests.join(shapes, by).join(names, by, "left")


def merge_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """O3: all sources' features in one frame (duplicates kept) with ``_source`` and canonical JSON."""
    out = None
    for name, df in frames.items():
        part = df.select(F.lit(name).alias("_source"), "_ord", "geometry", feature_json(df).alias("_json"))
        out = part if out is None else out.unionByName(part)
    return out
