"""GeoJSON payloads -> feature frames.

Payloads arrive as a text column (one document per row, e.g. from
``read.text(wholetext=True)``) or as GeoJSON text sequences (one Feature
per line, the splittable form for large feeds). Documents are parsed into
VARIANT once; all shape checks are expressions on that value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions.geo import GEOMETRY_TYPES, json_type_name, let
from featureflow.sources.files import without_text

_GEOMETRY_KINDS = [t for t in GEOMETRY_TYPES]


def kind_of(v: Column) -> Column:
    k = F.variant_get(v, "$.type", "variant")
    return F.when(F.schema_of_variant(k) == "STRING", F.variant_get(k, "$", "string"))


def _repr(v: Column) -> Column:
    s = F.schema_of_variant(v)
    return (F.when(v.isNull() | (s == "VOID"), F.lit("None"))
            .when(s == "STRING", F.concat(F.lit("'"), F.variant_get(v, "$", "string"), F.lit("'")))
            .otherwise(F.to_json(v)))


def document_problem(text: Column, doc: Column | None = None) -> Column:
    """Why a GeoJSON document cannot be read, or null; ``doc`` is the text parsed, where the caller has it."""
    doc = F.try_parse_json(text) if doc is None else doc

    def check(d: Column) -> Column:
        obj = F.try_variant_get(d, "$", "map<string,variant>")
        kind = kind_of(d)
        feats = F.variant_get(d, "$.features", "variant")
        return (
            F.when(text.isNull() | (F.trim(text) == ""), F.lit("payload is empty; expected a JSON document"))
            .when(d.isNull(), F.lit("invalid JSON"))
            # only an array has a first member: told without opening all of it
            .when((kind == "FeatureCollection") & F.variant_get(d, "$.features[0]", "variant").isNotNull(), F.lit(None))
            .when(F.try_variant_get(d, "$", "array<variant>").isNotNull(), F.lit(None))
            .when(obj.isNull(), F.concat(F.lit("expected a GeoJSON object, got "), json_type_name(d)))
            .when(kind == "FeatureCollection",
                  F.when(feats.isNull() | F.is_variant_null(feats), F.lit("FeatureCollection has no 'features' member"))
                  .when(F.try_variant_get(feats, "$", "array<variant>").isNull(),
                        F.concat(F.lit("FeatureCollection 'features' must be an array, got "), json_type_name(feats))))
            .when(kind.isin("Feature", *_GEOMETRY_KINDS), F.lit(None))
            .otherwise(F.concat(F.lit("unrecognised GeoJSON: top-level 'type' is "), _repr(obj["type"]),
                                F.lit(". Expected 'FeatureCollection', 'Feature' or a geometry object.")))
        )

    return let(doc, check)


def feature_items(doc: Column) -> Column:
    """The document's feature items as ``array<variant>`` (null if unreadable)."""
    kind = kind_of(doc)
    bare_geometry = F.to_variant_object(F.struct(
        doc.alias("geometry"), F.to_variant_object(F.struct()).alias("properties"), F.lit("Feature").alias("type")))
    return (F.when(F.try_variant_get(doc, "$", "array<variant>").isNotNull(),
                   F.try_variant_get(doc, "$", "array<variant>"))
            .when(kind == "FeatureCollection", F.try_variant_get(doc, "$.features", "array<variant>"))
            .when(kind == "Feature", F.array(doc))
            .when(kind.isin(*_GEOMETRY_KINDS), F.array(bare_geometry)))


def item_problem(item: Column, index: Column) -> Column:
    """Why one feature item is not a usable Feature, or null."""
    obj = F.try_variant_get(item, "$", "map<string,variant>")
    props = obj["properties"]
    kind_v = obj["type"]
    idx = index.cast("string")
    given = F.variant_get(item, "$.properties", "variant")
    # members are looked up by name in a usable item, and only others are opened as a whole
    usable = (F.try_variant_get(item, "$.type", "string") == "Feature") & (
        given.isNull() | F.is_variant_null(given) | F.schema_of_variant(given).startswith("OBJECT"))
    return F.when(~F.coalesce(usable, F.lit(False)), (
        F.when(obj.isNull(), F.concat(F.lit("feature "), idx, F.lit(" is a "), json_type_name(item),
                                      F.lit(", expected a GeoJSON Feature object")))
        .when(~F.coalesce(kind_of(item) == "Feature", F.lit(False)),
              F.concat(F.lit("feature "), idx, F.lit(" has type "), _repr(kind_v), F.lit(", expected 'Feature'")))
        .when(props.isNotNull() & ~F.is_variant_null(props)
              & F.try_variant_get(props, "$", "map<string,variant>").isNull(),
              F.concat(F.lit("feature "), idx, F.lit(": 'properties' must be an object or null, got "),
                       json_type_name(props)))
    ))


def parse_geojson(docs: DataFrame, text_col: str = "value", doc_col: str = "_doc",
                  problem: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per feature: ``_doc, _ord, geometry, _props, _id, _problem``.

    ``_ord`` is the position in the document; ``_id`` is null when the item
    has no ``id`` member; a null ``properties`` becomes ``{}``. ``problem``
    names further reasons against a document that can be read.
    """
    # parsed once: what is wrong with a document is told from the parsed value
    parsed = docs.select(F.col(doc_col).alias("_doc"), F.col(text_col).alias("text"), F.try_parse_json(F.col(text_col)).alias("doc"))
    parsed = parsed.select("_doc", "doc", document_problem(F.col("text"), F.col("doc")).alias("why"))
    if problem:
        parsed = parsed.withColumn("why", F.coalesce("why", problem(F.col("doc"))))
    # an unreadable document is one row with its problem, so that it cannot vanish; an empty collection is no row
    items = F.when(F.col("why").isNull(), feature_items(F.col("doc"))).otherwise(F.array(F.lit(None).cast("variant")))
    rows = parsed.select("_doc", "why", F.posexplode(items).alias("_ord", "item"))
    return features(rows, F.col("_ord").cast("long"), F.coalesce("why", item_problem(F.col("item"), F.col("_ord"))))


def features(rows: DataFrame, order: Column, problem: Column) -> DataFrame:
    item = F.col("item")
    props = F.variant_get(item, "$.properties", "variant")
    return rows.select(
        "_doc",
        order.alias("_ord"),
        F.variant_get(item, "$.geometry", "variant").alias("geometry"),
        F.when(props.isNull() | F.is_variant_null(props), F.to_variant_object(F.struct())).otherwise(props).alias("_props"),
        F.variant_get(item, "$.id", "variant").alias("_id"),
        problem.alias("_problem"),
    )


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Whole GeoJSON documents (FeatureCollection, Feature, geometry or array), one per file."""
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("_doc"),
                                                        F.regexp_replace("value", "^\ufeff", "").alias("value"))
    return parse_geojson(docs.unionByName(without_text(spark, path, docs)))


def read_geojson_seq(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON text sequences: one Feature per line, split across tasks like any text file.

    The form for large feeds. ``_ord`` is the line's place: the block of its
    file and the row in it, so it does not depend on how tasks are scheduled.
    Blank lines are skipped; a line that is no JSON is a row with its problem.
    """
    place = F.col("_metadata.file_block_start") * F.lit(1 << 20) + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33))
    lines = (spark.read.text(path)
             .select(F.col("_metadata.file_path").alias("_doc"), place.alias("_ord"), "value",
                     F.try_parse_json(F.regexp_replace("value", "^\u001e", "")).alias("item"))
             .where(F.trim("value") != ""))
    return features(lines, F.col("_ord"), F.when(F.col("item").isNull(), F.lit("invalid JSON"))
                     .otherwise(item_problem(F.col("item"), F.col("_ord"))))
