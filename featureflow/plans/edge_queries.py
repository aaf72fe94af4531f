"""Registered queries for hard inputs: broken payloads, deep collections, odd text, schemaless steps, recovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions import canonical, geo
from featureflow.functions import predicates as P
from featureflow.operators.transforms import Step
from featureflow.plans import fixtures as X
from featureflow.plans.oracle import with_fixtures
from featureflow.plans.queries import _specs, query
from featureflow.plans.refresh import SourceSpec, empty_state, refresh
from featureflow.session import spread, written
from featureflow.sources import csv as CSV
from featureflow.sources import geojson as GJ

NOW = "2024-01-31 00:00:00"


# --------------------------------------------------------------------------
# Canonical text (H1)
# --------------------------------------------------------------------------

@query("canonical_json_edges", with_fixtures(
    "SELECT key, to_json(v) AS text, u AS code FROM (SELECT c_custkey AS key, c_custkey % 3 AS u, c_name || chr(CAST(CASE c_custkey % 3 "
    "WHEN 0 THEN 8232 WHEN 1 THEN 8233 ELSE 133 END AS INTEGER)) || c_mktsegment AS v FROM customer)"))
def q_canonical_json_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: strings around line and paragraph separators and next-line, whole."""
    c = X.table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 3
    odd = F.when(k == 0, F.lit("\u2028")).when(k == 1, F.lit("\u2029")).otherwise(F.lit("\u0085"))
    df = c.select(F.col("c_custkey").alias("key"), F.concat("c_name", odd, "c_mktsegment").alias("v"), k.alias("code"))
    return df.select("key", canonical.json_text(F.col("v"), df.schema["v"].dataType).alias("text"), "code")


@query("canonical_small_numbers", with_fixtures(
    "SELECT count(DISTINCT v) AS values, count(DISTINCT v) AS texts, count(*) FILTER (WHERE v <> 0) AS readable_not_zero FROM "
    "(SELECT c_acctbal * 1e-10 + c_custkey * 1e-21 AS v FROM customer)"))
def q_canonical_small_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: doubles near 1e-10 that differ beyond the 18th place keep different texts, and the texts read back."""
    c = X.table(spark, sf_dir, "customer")
    df = c.select((F.col("c_acctbal") * 1e-10 + F.col("c_custkey") * 1e-21).alias("v"))
    text = canonical.json_text(F.col("v"), df.schema["v"].dataType)
    return df.agg(F.count_distinct("v").alias("values"), F.count_distinct(text).alias("texts"),
                  F.count_if((text.cast("double") == F.col("v")) & (F.col("v") != 0)).alias("readable_not_zero"))


# --------------------------------------------------------------------------
# Steps on schemaless properties
# --------------------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return GJ.parse_geojson(X.geojson_docs(spark, sf_dir))


def _shown(f: DataFrame) -> DataFrame:
    return f.select(F.to_json("_id").cast("long").alias("id"), F.to_json("_props").alias("props"))


@query("t_filter_variant", with_fixtures(
    "SELECT event_id AS id, event_type FROM ev WHERE k > 40 AND event_type <> 'click'", "ev"))
def q_t_filter_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter on properties of parsed GeoJSON."""
    step = Step("filter", lambda df: P.gt(P.prop(df, "k", "int"), 40) & P.ne(P.prop(df, "event_type"), "click"))
    f = step.apply(_events(spark, sf_dir))
    return f.select(F.to_json("_id").cast("long").alias("id"), P.prop(f, "event_type").alias("event_type"))


@query("t_select_variant", with_fixtures("SELECT event_id AS id, '{\"k\":' || CAST(k AS VARCHAR) || '}' AS props FROM ev", "ev"))
def q_t_select_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of parsed GeoJSON; absent names are skipped."""
    return _shown(Step("select", ["k", "not_there"]).apply(_events(spark, sf_dir)))


@query("t_rename_variant", with_fixtures(
    "SELECT event_id AS id, '{\"kind\":' || to_json(event_type) || ',\"n\":' || CAST(k AS VARCHAR) || '}' AS props FROM ev", "ev"))
def q_t_rename_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renamed properties of parsed GeoJSON."""
    f = Step("select", ["k", "event_type"]).apply(_events(spark, sf_dir))
    return _shown(Step("rename", {"event_type": "kind", "k": "n"}).apply(f))


@query("p_prop_variant", with_fixtures("SELECT event_type, count(*) AS n, CAST(sum(k) AS BIGINT) AS k, CAST(0 AS BIGINT) AS absent "
                                       "FROM ev GROUP BY event_type", "ev"))
def q_p_prop_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of parsed GeoJSON by name; an absent one is null."""
    f = _events(spark, sf_dir)
    return f.groupBy(P.prop(f, "event_type").alias("event_type")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(P.prop(f, "k", "int")).alias("k"), F.count(P.prop(f, "nope")).alias("absent"))


# --------------------------------------------------------------------------
# CSV (S6, S8)
# --------------------------------------------------------------------------

@query("csv_dialect", with_fixtures(
    "SELECT key, 'a \"' || coalesce(segment, '') || '\", b' AS note, CASE WHEN key % 5 = 0 THEN NULL ELSE CAST(key AS VARCHAR) END AS n "
    "FROM stations", "stations"))
def q_csv_dialect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted cells with separators and doubled quotes."""
    s = X.stations_raw(spark, sf_dir)
    k = F.col("key")
    line = F.concat(F.lit('"a ""'), F.coalesce("segment", F.lit("")), F.lit('"", b",'), F.when(k % 5 == 0, F.lit("")).otherwise(k.cast("string")))
    return CSV.parse_lines(s.select("key", line.alias("value")), ["note", "n"], ",").select("key", "note", "n")


@query("csv_wide_rows", with_fixtures(
    "SELECT key, key % 4 IN (1, 2) AS too_many FROM stations", "stations"))
def q_csv_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with further cells, empty ones too, are flagged; separators in quotes are none."""
    s = X.stations_raw(spark, sf_dir)
    k = F.col("key")
    text = k.cast("string")
    line = (F.when(k % 4 == 0, F.concat(text, F.lit(',"x,y,z"'))).when(k % 4 == 1, F.concat(text, F.lit(",x,")))
            .when(k % 4 == 2, F.concat(text, F.lit(",x,,4"))).otherwise(F.concat(text, F.lit(",x"))))
    return CSV.parse_lines(s.select("key", line.alias("value")), ["a", "b"], ",").select("key", F.col("_too_many").alias("too_many"))


# --------------------------------------------------------------------------
# Runs (R1, O4, V3)
# --------------------------------------------------------------------------

def _cut_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = X.geojson_docs(spark, sf_dir)
    return docs.withColumn("value", F.when(
        F.col("_doc") % 10 == 3, F.substring("value", F.lit(1), F.length("value") - 9)).otherwise(F.col("value")))


def _with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.stations_raw(spark, sf_dir).withColumn("pm25", F.when(F.col("key") % 17 == 0, F.lit(float("nan"))).otherwise(F.col("pm25")))


@query("refresh_bad_payload", with_fixtures(
    "SELECT 'cut' AS source, 'failed' AS status, 5 AS error_code, CAST(count(DISTINCT chunk) AS VARCHAR) AS bad_rows, false AS published "
    "FROM ev WHERE chunk % 10 = 3 "
    "UNION ALL SELECT 'nan', 'failed', 5, CAST(count(*) AS VARCHAR), false FROM stations WHERE key % 17 = 0 "
    "UNION ALL SELECT 'good', 'ok', NULL, NULL, false", "ev", "stations"))
def q_refresh_bad_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncated documents and NaN fail their own sources; a later step hides nothing; nothing is published."""
    specs = [SourceSpec("cut", lambda s: _cut_documents(s, sf_dir), (Step("drop_invalid", True),), features=GJ.parse_geojson),
             SourceSpec("nan", lambda s: _with_nan(s, sf_dir), features=X.as_features),
             SourceSpec("good", lambda s: X.depots_raw(s, sf_dir), features=X.as_features)]
    r = refresh(spark, specs, *empty_state(spark), NOW, dry_run=True)
    planned = [o.rsplit("=", 1)[-1] for o in r.outputs]
    return r.manifest.select("source", "status", "error_code", F.split("error", " ")[0].alias("bad_rows"),
                             F.col("source").isin(planned).alias("published"))


@query("refresh_deep_collections", with_fixtures(
    "SELECT key % 7 AS levels, count(*) AS n, min(round(lon, 3)) AS west, max(round(lat, 3)) AS north FROM stations GROUP BY key % 7",
    "stations"))
def q_refresh_deep_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in collections 0 to 6 levels deep are kept, rounded and measured alike."""
    s = spread(X.stations_raw(spark, sf_dir))
    levels = (F.col("key") % 7).cast("int")
    inner = F.to_json(geo.point(F.col("lon"), F.col("lat")))
    text = F.concat(F.repeat(F.lit('{"type":"GeometryCollection","geometries":['), levels), inner, F.repeat(F.lit("]}"), levels))
    f = s.select("key", levels.cast("long").alias("levels"), F.parse_json(text).alias("geometry"))
    f = Step("drop_invalid", True).apply(written(Step("round", 3).apply(f), "rounded"))
    a, _, _, d = geo.built(geo.bbox_parts)
    return f.groupBy("levels").agg(F.count(F.lit(1)).alias("n"), F.min(a).alias("west"), F.max(d).alias("north"))


@query("refresh_empty_source", with_fixtures(
    "SELECT 'none' AS source, 'unchanged' AS status, CAST(0 AS BIGINT) AS feature_count, 'sha256-merkle-v1:' || sha256('sha256-merkle-v1|0|') "
    "AS content_hash UNION ALL SELECT 'all', 'unchanged', count(*), NULL FROM stations", "stations"))
def q_refresh_empty_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source without rows has a count, a digest and a status of its own, also on its second run."""
    specs = [SourceSpec("none", lambda s: X.stations_raw(s, sf_dir).where("key < 0"), features=X.as_features),
             SourceSpec("all", lambda s: X.stations_raw(s, sf_dir), features=X.as_features)]
    first = refresh(spark, specs, *empty_state(spark), "2024-01-30 00:00:00", dry_run=True)
    m = refresh(spark, specs, first.next_index, first.next_meta, NOW, dry_run=True).manifest
    return m.select("source", "status", "feature_count", F.when(F.col("source") == "none", F.col("content_hash")).alias("content_hash"))


@query("refresh_recovered", with_fixtures(
    "SELECT 2 AS run, 'stations' AS source, 'ok' AS status, n AS feature_count, false AS published FROM st "
    "UNION ALL SELECT 2, 'depots', 'failed', d, false FROM dp "
    "UNION ALL SELECT 3, 'stations', 'unchanged', n, true FROM st UNION ALL SELECT 3, 'depots', 'unchanged', d, false FROM dp",
    "stations", "depots", extra="st AS (SELECT count(*) AS n FROM stations WHERE status IS DISTINCT FROM 'decommissioned'), "
                                "dp AS (SELECT count(*) AS d FROM depots)"))
def q_refresh_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change that a failure elsewhere blocked is published by the next run, though nothing changed again."""
    first = refresh(spark, _specs(sf_dir, prev=True), *empty_state(spark), "2024-01-29 00:00:00", dry_run=True)
    second = refresh(spark, _specs(sf_dir, depot_min=10 ** 9), first.next_index, first.next_meta, "2024-01-30 00:00:00", dry_run=True)
    third = refresh(spark, _specs(sf_dir), second.next_index, second.next_meta, NOW, dry_run=True)
    out = None
    for n, r in ((2, second), (3, third)):
        planned = [o.rsplit("=", 1)[-1] for o in r.outputs]
        part = r.manifest.select(F.lit(n).alias("run"), "source", "status", "feature_count", F.col("source").isin(planned).alias("published"))
        out = part if out is None else out.unionByName(part)
    return out
