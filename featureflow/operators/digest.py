"""Feature hashes and collection digests (H1-H5).

The collection digest is order-free and counts duplicates, like a hash of the
sorted list of feature hashes, but is built as a fixed three-level Merkle tree
so no single task ever sees the whole list:

1. collapse equal feature hashes to ``(hash, n)`` (map-side partial
   aggregation, so a hash repeated a billion times costs one row);
2. leaf digest per 6-hex-char hash prefix over its sorted ``hash:n`` entries
   (distinct SHA-256 values spread evenly over the 16.7 M prefixes);
3. middle digest per 3-hex-char prefix over at most 4,096 leaf digests;
4. root digest per source over at most 4,096 middle digests and the count.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions.canonical import json_text, object_text, variant_text
from featureflow.operators import named, property_fields

# Fixed value: the digest algorithm identifier stored next to every digest.
DIGEST_ALGORITHM = "sha256-merkle-v1"


def feature_json(df: DataFrame) -> Column:
    """H1: canonical JSON text of each feature (geometry, id if any, properties)."""
    geometry = F.coalesce(variant_text(F.col("geometry")), F.lit("null"))
    if "_props" in df.columns:
        props = F.coalesce(variant_text(F.col("_props")), F.lit("{}"))
    else:
        props = object_text({f.name: (named(f.name), f.dataType) for f in property_fields(df)})
    parts = [F.lit('{"geometry":'), geometry]
    if "_id" in df.columns:
        id_type = df.schema["_id"].dataType
        if isinstance(id_type, T.VariantType):  # parsed sources: "id" only where the item had one
            parts += [F.when(F.col("_id").isNotNull(), F.concat(F.lit(',"id":'), variant_text(F.col("_id")))).otherwise(F.lit(""))]
        else:
            parts += [F.lit(',"id":'), json_text(F.col("_id"), id_type)]
    parts += [F.lit(',"properties":'), props, F.lit("}")]
    return F.concat(*parts)


def with_feature_hash(df: DataFrame) -> DataFrame:
    """H2: add ``_hash`` = SHA-256 hex of the canonical feature JSON."""
    return df.withColumn("_hash", F.sha2(feature_json(df), 256))


def _sorted_join(entries: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_list(entries)), ",")


def collection_digest(hashed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """H3/H4: ``(*by, feature_count, content_hash)`` from a frame with ``_hash``."""
    by = list(by)
    counted = hashed.groupBy(*by, "_hash").agg(F.count(F.lit(1)).alias("n"))
    # dealt by the middle's prefix, so that leaves, nearly as many as hashes, are not exchanged once more
    dealt = counted.withColumn("b3", F.substring("_hash", 1, 3)).repartition(*by, "b3")
    leaf = (dealt.groupBy(*by, "b3", F.substring("_hash", 1, 6).alias("b6"))
            .agg(F.sha2(_sorted_join(F.concat_ws(":", "_hash", F.col("n").cast("string"))), 256).alias("d"),
                 F.sum("n").alias("n")))
    middle = (leaf.groupBy(*by, "b3")
              .agg(F.sha2(_sorted_join(F.concat_ws("=", "b6", "d")), 256).alias("d"), F.sum("n").alias("n")))
    root = middle.groupBy(*by).agg(F.sum("n").alias("feature_count"),
                                   _sorted_join(F.concat_ws("=", "b3", "d")).alias("body"))
    digest = F.sha2(F.concat_ws("|", F.lit(DIGEST_ALGORITHM), F.col("feature_count").cast("string"), F.col("body")), 256)
    return root.select(*by, "feature_count", F.concat(F.lit(DIGEST_ALGORITHM + ":"), digest).alias("content_hash"))


def empty_digest_hash() -> str:
    """Digest of an empty collection (no rows reach the aggregation)."""
    import hashlib

    body = "|".join([DIGEST_ALGORITHM, "0", ""])
    return DIGEST_ALGORITHM + ":" + hashlib.sha256(body.encode()).hexdigest()


def change_flag(current: Column, previous: Column) -> Column:
    """H5: changed unless both hashes are known and equal."""
    return ~F.coalesce(current == previous, F.lit(False))
