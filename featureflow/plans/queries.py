"""Registered queries: one per operator of the inventory.

Each query is ``(spark, sf_dir) -> DataFrame`` over the fixture views, and
most have an SQL twin (``ORACLE``) that DuckDB runs on the same parquet.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions import predicates as P
from featureflow.operators import property_fields
from featureflow.operators import diff as D
from featureflow.operators.digest import with_feature_hash
from featureflow.operators.transforms import Step, apply_steps
from featureflow.plans import fixtures as X
from featureflow.plans.oracle import station_feature_json, with_fixtures
from featureflow.session import spread

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register


# --------------------------------------------------------------------------
# The refresh slice: stations -> filter -> select -> round -> hash -> key
# --------------------------------------------------------------------------

STATION_PROPS = ["station_id", "country", "pm25", "segment"]
STATION_STEPS = [
    Step("filter", lambda: P.ne(F.col("status"), "decommissioned"), "status != 'decommissioned'"),
    Step("select", STATION_PROPS, ", ".join(STATION_PROPS)),
    Step("round", 3, "3 decimal places"),
]


def refreshed_stations(spark: SparkSession, sf_dir: str, which: str = "stations") -> DataFrame:
    """A stations fixture after the standard steps, hashed and keyed by station_id."""
    source = {"stations": X.stations_raw, "stations_prev": X.stations_prev_raw, "stations_dup": X.stations_dup_raw}[which]
    return D.with_key(with_feature_hash(apply_steps(X.as_features(spread(source(spark, sf_dir))), STATION_STEPS)), "station_id")


def station_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur = D.key_index(refreshed_stations(spark, sf_dir))
    prev = D.key_index(refreshed_stations(spark, sf_dir, "stations_prev"))
    return D.change_feed(cur, prev)


_ACTIVE = "status IS DISTINCT FROM 'decommissioned'"


def _station_index_sql(fixture: str) -> str:
    return (f"SELECT station_id AS key, arg_max(sha256({station_feature_json()}), ord) AS hash, "
            f"count(*) AS n FROM {fixture} WHERE {_ACTIVE} GROUP BY station_id")


_FEED_SQL = f"""
    cur AS ({_station_index_sql('stations')}),
    prev AS ({_station_index_sql('stations_prev')}),
    feed AS (
      SELECT coalesce(c.key, p.key) AS key,
             CASE WHEN p.key IS NULL THEN 'added' WHEN c.key IS NULL THEN 'removed'
                  WHEN c.hash <> p.hash THEN 'modified' ELSE 'unchanged' END AS op,
             c.hash AS hash, p.hash AS prev_hash
      FROM cur c FULL OUTER JOIN prev p ON c.key = p.key)"""


def _feed_query(body: str) -> str:
    return with_fixtures(body, "stations", "stations_prev", extra=_FEED_SQL)


@query("diff_counts", _feed_query(
    "SELECT count_if(op = 'added') AS added, count_if(op = 'removed') AS removed, "
    "count_if(op = 'modified') AS modified, count_if(op = 'unchanged') AS unchanged FROM feed"))
def q_diff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 on the refresh slice (the flagship query)."""
    return D.diff_counts(station_feed(spark, sf_dir))


@query("change_feed", _feed_query("SELECT key, op, hash, prev_hash FROM feed"))
def q_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key with its change class."""
    return station_feed(spark, sf_dir)


@query("feature_hash", with_fixtures(
    f"SELECT key, sha256({station_feature_json()}) AS feature_hash FROM stations WHERE {_ACTIVE}", "stations"))
def q_feature_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: feature hash per station after the standard steps."""
    df = with_feature_hash(apply_steps(X.stations(spark, sf_dir).withColumn("_key", F.col("key")), STATION_STEPS))
    return df.select(F.col("_key").alias("key"), F.col("_hash").alias("feature_hash"))


# --------------------------------------------------------------------------
# Hash and diff operators (H*, D*)
# --------------------------------------------------------------------------

from featureflow.functions.canonical import json_text  # noqa: E402
from featureflow.operators import digest as H  # noqa: E402
from featureflow.operators.digest import feature_json  # noqa: E402
import re  # noqa: E402

from featureflow.plans.oracle import num  # noqa: E402


def _digest_sql(hashes: str, by: str = "", prefix: str = "") -> str:
    """SQL twin of digest.collection_digest over ``hashes(<by,> h)``; CTE names get ``prefix``."""
    b = f"{by}, " if by else ""
    g = f"GROUP BY {by}" if by else ""
    sql = _digest_body(hashes, b, g)
    if prefix:
        for name in ("digest", "root", "mid", "leaf", "hc"):
            sql = re.sub(rf"(?<![A-Za-z_.]){name} AS \(", f"{prefix}{name} AS (", sql)
            sql = re.sub(rf"FROM {name}\b", f"FROM {prefix}{name}", sql)
    return sql


def _digest_body(hashes: str, b: str, g: str) -> str:
    return f"""
      hc AS (SELECT {b}h, count(*) AS n FROM {hashes} GROUP BY {b}h),
      leaf AS (SELECT {b}substr(h, 1, 6) AS b6,
                      sha256(string_agg(h || ':' || CAST(n AS VARCHAR), ',' ORDER BY h || ':' || CAST(n AS VARCHAR))) AS d,
                      sum(n) AS n FROM hc GROUP BY {b}substr(h, 1, 6)),
      mid AS (SELECT {b}substr(b6, 1, 3) AS b3, sha256(string_agg(b6 || '=' || d, ',' ORDER BY b6 || '=' || d)) AS d,
                     sum(n) AS n FROM leaf GROUP BY {b}substr(b6, 1, 3)),
      root AS (SELECT {b}CAST(sum(n) AS BIGINT) AS feature_count,
                      string_agg(b3 || '=' || d, ',' ORDER BY b3 || '=' || d) AS body FROM mid {g}),
      digest AS (SELECT {b}feature_count, 'sha256-merkle-v1:' ||
                        sha256('sha256-merkle-v1|' || CAST(feature_count AS VARCHAR) || '|' || body) AS content_hash
                 FROM root)"""


def _hash_sql(fixture: str) -> str:
    return f"SELECT sha256({station_feature_json()}) AS h, key, ord FROM {fixture} WHERE {_ACTIVE}"


@query("canonical_json", with_fixtures(
    f"SELECT key, {station_feature_json()} AS canonical_json FROM stations WHERE {_ACTIVE}", "stations"))
def q_canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: canonical feature JSON text."""
    df = apply_steps(X.stations(spark, sf_dir).withColumn("_key", F.col("key")), STATION_STEPS)
    return df.select(F.col("_key").alias("key"), feature_json(df).alias("canonical_json"))


@query("collection_digest", with_fixtures("SELECT feature_count, content_hash FROM digest", "stations",
                                          extra=f"hs AS ({_hash_sql('stations')}),{_digest_sql('hs')}"))
def q_collection_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: order-free digest of the refreshed stations."""
    return H.collection_digest(refreshed_stations(spark, sf_dir))


_DEPOT_JSON = (f"'{{\"geometry\":{{\"coordinates\":[' || {num('lon')} || ',' || {num('lat')} || "
               f"'],\"type\":\"Point\"}},\"properties\":{{\"capacity\":' || {num('capacity')} || "
               f"',\"country\":' || CAST(country AS VARCHAR) || ',\"depot_id\":' || to_json(depot_id) || '}}}}'")


@query("collection_hash", with_fixtures(
    "SELECT source, feature_count, content_hash FROM digest", "stations", "depots",
    extra=f"hs AS (SELECT 'stations' AS source, h FROM ({_hash_sql('stations')}) "
          f"UNION ALL SELECT 'depots', sha256({_DEPOT_JSON}) FROM depots),{_digest_sql('hs', 'source')}"))
def q_collection_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: content hash per source of a two-source run (stations, depots)."""
    st = refreshed_stations(spark, sf_dir).select(F.lit("stations").alias("_source"), "_hash")
    dp = with_feature_hash(X.depots(spark, sf_dir)).select(F.lit("depots").alias("_source"), "_hash")
    out = H.collection_digest(st.unionByName(dp), ["_source"])
    return out.withColumnRenamed("_source", "source")


@query("change_flag", with_fixtures(
    "SELECT c.feature_count, p.content_hash = c.content_hash AS same, "
    "NOT coalesce(p.content_hash = c.content_hash, false) AS changed FROM digest c, pdigest p", "stations",
    "stations_prev",
    extra=f"hs AS ({_hash_sql('stations')}),{_digest_sql('hs')}, phs AS ({_hash_sql('stations_prev')}),"
          + _digest_sql('phs').replace(" hc ", " phc ").replace("FROM hc", "FROM phc").replace(" leaf ", " pleaf ")
          .replace("FROM leaf", "FROM pleaf").replace(" mid ", " pmid ").replace("FROM mid", "FROM pmid")
          .replace(" root ", " proot ").replace("FROM root", "FROM proot").replace(" digest ", " pdigest ")))
def q_change_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: changed unless both digests are known and equal."""
    src = F.lit("stations").alias("_source")
    cur = H.collection_digest(refreshed_stations(spark, sf_dir).select(src, "_hash"), ["_source"])
    prev = H.collection_digest(refreshed_stations(spark, sf_dir, "stations_prev").select(src, "_hash"), ["_source"])
    j = cur.join(prev.select("_source", F.col("content_hash").alias("prev_hash")), "_source", "left")
    return j.select("feature_count", (F.col("prev_hash") == F.col("content_hash")).alias("same"),
                    H.change_flag(F.col("content_hash"), F.col("prev_hash")).alias("changed"))


@query("feature_key", with_fixtures(
    "SELECT key, CAST(country AS VARCHAR) AS by_country, station_id AS by_station, "
    "CAST(NULL AS VARCHAR) AS by_missing FROM stations", "stations"))
def q_feature_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diff key from a configured property (numbers stringified)."""
    df = X.stations(spark, sf_dir)
    return df.select("key", D.feature_key(df, "country").alias("by_country"),
                     D.feature_key(df, "station_id").alias("by_station"),
                     D.feature_key(df, "no_such_property").alias("by_missing"))


def _dup_index_sql() -> str:
    return (f"SELECT station_id AS key, arg_max(sha256({station_feature_json()}), ord) AS hash, count(*) AS n "
            f"FROM stations_dup WHERE {_ACTIVE} GROUP BY station_id")


@query("key_index", with_fixtures(_dup_index_sql(), "stations_dup"))
def q_key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key -> hash with the last row winning, and rows per key."""
    return D.key_index(refreshed_stations(spark, sf_dir, "stations_dup"))


@query("duplicate_ids", with_fixtures(f"SELECT key, n - 1 AS extra FROM ({_dup_index_sql()}) WHERE n > 1",
                                      "stations_dup"))
def q_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys present more than once in the current run."""
    return D.duplicate_ids(refreshed_stations(spark, sf_dir, "stations_dup"))


@query("diff_samples", _feed_query(
    "SELECT op, rank, key FROM (SELECT op, key, row_number() OVER (PARTITION BY op ORDER BY key) AS rank "
    "FROM feed WHERE op <> 'unchanged') WHERE rank <= 10"))
def q_diff_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ten sorted keys per change bucket."""
    return D.diff_samples(station_feed(spark, sf_dir))


@query("added_rows", _feed_query("SELECT c.key, c.hash FROM cur c WHERE NOT EXISTS (SELECT 1 FROM prev p WHERE p.key = c.key)"))
def q_added_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Added keys as a left anti join."""
    cur = D.key_index(refreshed_stations(spark, sf_dir))
    prev = D.key_index(refreshed_stations(spark, sf_dir, "stations_prev"))
    return cur.join(prev.select("key"), "key", "left_anti").select("key", "hash")


@query("removed_rows", _feed_query("SELECT p.key FROM prev p WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE p.key = c.key)"))
def q_removed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed keys as a left anti join the other way."""
    cur = D.key_index(refreshed_stations(spark, sf_dir))
    prev = D.key_index(refreshed_stations(spark, sf_dir, "stations_prev"))
    return prev.select("key").join(cur.select("key"), "key", "left_anti")


@query("unchanged_rows", _feed_query(
    "SELECT c.key FROM cur c WHERE EXISTS (SELECT 1 FROM prev p WHERE p.key = c.key AND p.hash = c.hash)"))
def q_unchanged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unchanged keys as a left semi join on (key, hash)."""
    cur = D.key_index(refreshed_stations(spark, sf_dir))
    prev = D.key_index(refreshed_stations(spark, sf_dir, "stations_prev"))
    return cur.join(prev.select("key", "hash"), ["key", "hash"], "left_semi").select("key")


_UNKEYED_SQL = f"""
    ch AS (SELECT h, count(*) AS n FROM ({_hash_sql('stations')}) GROUP BY h),
    ph AS (SELECT h, count(*) AS n FROM ({_hash_sql('stations_prev')}) GROUP BY h),
    j AS (SELECT coalesce(c.n, 0) AS nc, coalesce(p.n, 0) AS np FROM ch c FULL OUTER JOIN ph p ON c.h = p.h)"""


@query("diff_unkeyed", with_fixtures(
    "SELECT CAST(sum(greatest(nc - np, 0)) AS BIGINT) AS added, CAST(sum(greatest(np - nc, 0)) AS BIGINT) AS removed, "
    "CAST(0 AS BIGINT) AS modified, CAST(sum(least(nc, np)) AS BIGINT) AS unchanged FROM j",
    "stations", "stations_prev", extra=_UNKEYED_SQL))
def q_diff_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset diff of feature hashes (no key)."""
    cur = D.hash_counts(refreshed_stations(spark, sf_dir))
    prev = D.hash_counts(refreshed_stations(spark, sf_dir, "stations_prev"))
    return D.unkeyed_diff(cur, prev)


@query("added_multiset", with_fixtures(
    f"SELECT h AS hash FROM ({_hash_sql('stations_dup')}) EXCEPT ALL SELECT h FROM ({_hash_sql('stations_prev')})",
    "stations_dup", "stations_prev"))
def q_added_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 rows: hashes of the current multiset not matched in the previous one."""
    cur = refreshed_stations(spark, sf_dir, "stations_dup").select(F.col("_hash").alias("hash"))
    prev = refreshed_stations(spark, sf_dir, "stations_prev").select(F.col("_hash").alias("hash"))
    return cur.exceptAll(prev)


@query("common_multiset", with_fixtures(
    f"SELECT h AS hash FROM ({_hash_sql('stations_dup')}) INTERSECT ALL SELECT h FROM ({_hash_sql('stations')})",
    "stations_dup"))
def q_common_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 rows: hashes common to both multisets, with multiplicity."""
    cur = refreshed_stations(spark, sf_dir, "stations_dup").select(F.col("_hash").alias("hash"))
    prev = refreshed_stations(spark, sf_dir).select(F.col("_hash").alias("hash"))
    return cur.intersectAll(prev)


@query("diff_first_run", with_fixtures(
    f"SELECT count(*) AS added, CAST(0 AS BIGINT) AS removed, CAST(0 AS BIGINT) AS modified, "
    f"CAST(0 AS BIGINT) AS unchanged, count(*) AS total, true AS first_run FROM stations WHERE {_ACTIVE}", "stations"))
def q_diff_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With an empty state every feature is added."""
    keyed = refreshed_stations(spark, sf_dir).withColumn("_source", F.lit("stations"))
    cur = D.key_index(keyed, ["_source"])
    empty_state = cur.where(F.lit(False))
    counts = D.diff_counts(D.change_feed(cur, empty_state, ["_source"]), ["_source"])
    total = keyed.groupBy("_source").agg(F.count(F.lit(1)).alias("total"))
    return counts.join(total, "_source").select("added", "removed", "modified", "unchanged", "total",
                                          F.lit(True).alias("first_run"))


@query("diff_mode", with_fixtures(
    "SELECT 'station_id' AS id_property, count(*) AS total, count(station_id) AS with_key, "
    "count(*) > 0 AND count(station_id) = count(*) AS keyed FROM stations "
    "UNION ALL SELECT 'segment', count(*), count(segment), count(*) > 0 AND count(segment) = count(*) FROM stations",
    "stations"))
def q_diff_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed iff every row has a key (segment has gaps, station_id does not)."""
    df = X.stations(spark, sf_dir)
    a = D.diff_mode(D.with_key(df, "station_id")).select(F.lit("station_id").alias("id_property"), "*")
    b = D.diff_mode(D.with_key(df, "segment")).select(F.lit("segment").alias("id_property"), "*")
    return a.unionByName(b)


@query("diff_describe", _feed_query(
    "SELECT '+' || CAST(count_if(op = 'added') AS VARCHAR) || ' / -' || CAST(count_if(op = 'removed') AS VARCHAR) "
    "|| ' / ~' || CAST(count_if(op = 'modified') AS VARCHAR) || ' (of ' || "
    "CAST(count_if(op <> 'removed') AS VARCHAR) || ')' AS description FROM feed"))
def q_diff_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-line change description."""
    c = D.diff_counts(station_feed(spark, sf_dir))
    total = F.col("added") + F.col("modified") + F.col("unchanged")
    return c.select(D.describe(F.col("added"), F.col("removed"), F.col("modified"), total,
                               F.lit(True), F.lit(False)).alias("description"))


# --------------------------------------------------------------------------
# Transforms (T*) and geometry (G*)
# --------------------------------------------------------------------------

from featureflow.functions import geo  # noqa: E402
from featureflow.operators import transforms as TR  # noqa: E402
from featureflow.plans.oracle import ZONE_PROBLEM_SQL, ZONE_TYPE_SQL  # noqa: E402


def _json_out(df: DataFrame) -> DataFrame:
    return df.select(F.col("_ord").alias("ord"), feature_json(df).alias("feature_json"))


@query("t_filter", with_fixtures("SELECT key FROM stations WHERE pm25 > 1000 AND status = 'active' "
                                 "AND segment IS DISTINCT FROM 'BUILDING'", "stations"))
def q_t_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL-string and Column conditions, null-safe."""
    df = TR.t_filter(X.stations(spark, sf_dir), "pm25 > 1000 AND status = 'active'")
    return TR.t_filter(df, P.ne(F.col("segment"), "BUILDING")).select("key")


@query("t_select", with_fixtures(
    f"SELECT ord, {station_feature_json(precision=None, props=('segment', 'station_id'))} AS feature_json "
    "FROM stations", "stations"))
def q_t_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep listed properties; an absent name is skipped."""
    return _json_out(TR.t_select(X.stations(spark, sf_dir), ["segment", "station_id", "no_such_property"]))


@query("t_rename", with_fixtures(
    f"SELECT ord, {station_feature_json(precision=None, props=('key', 'station_id', 'country', 'pm25', 'segment'), rename={'pm25': 'pm', 'segment': 'status'})} "
    "AS feature_json FROM stations", "stations"))
def q_t_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename; on a name collision the later property wins."""
    return _json_out(TR.t_rename(X.stations(spark, sf_dir), {"pm25": "pm", "segment": "status"}))


_TRACK_SQL = "'T-' || CAST(user_id AS VARCHAR) || '-' || CAST(chunk AS VARCHAR)"


@query("t_round", with_fixtures(
    f"SELECT {_TRACK_SQL} AS track_id, '{{\"coordinates\":[' || string_agg('[' || {num('round(lon, 2)')} || ',' || "
    f"{num('round(lat, 2)')} || ']', ',' ORDER BY event_id) || '],\"type\":\"LineString\"}}' AS geometry "
    "FROM tracks GROUP BY user_id, chunk", "tracks"))
def q_t_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: coordinates rounded to 2 places (tracks), canonical text."""
    df = TR.t_round(X.tracks(spark, sf_dir), 2)
    return df.select("track_id", F.to_json("geometry").alias("geometry"))


@query("t_drop_invalid", with_fixtures("SELECT key FROM zones WHERE fault = 0", "zones"))
def q_t_drop_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: only structurally sound zones survive."""
    return TR.t_drop_invalid(X.zone_features(spark, sf_dir)).select("key")


@query("t_drop_reasons", with_fixtures(
    f"""SELECT count(*) AS rejected,
          string_agg('feature ' || CAST(idx AS VARCHAR) || ': ' || problem, '; ' ORDER BY ord)
          FILTER (WHERE rk <= 3) || CASE WHEN count(*) > 3 THEN ' (+' || CAST(count(*) - 3 AS VARCHAR) || ' more)'
          ELSE '' END AS detail
        FROM (SELECT ord, problem, idx, row_number() OVER (ORDER BY ord) AS rk FROM
              (SELECT ord, {ZONE_PROBLEM_SQL} AS problem, row_number() OVER (ORDER BY ord) - 1 AS idx FROM zones)
              WHERE problem IS NOT NULL)""", "zones"))
def q_t_drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 report: reject count and the first three reasons with their positions."""
    return TR.drop_reasons(X.zone_features(spark, sf_dir))


@query("t_report", with_fixtures(
    """SELECT * FROM (
         SELECT 1 AS step_no, 'filter' AS step, 'status != ''decommissioned''' AS detail, count(*) AS features_in,
                count_if(status IS DISTINCT FROM 'decommissioned') AS features_out FROM stations
         UNION ALL SELECT 2, 'select', 'station_id, country, pm25, segment',
                count_if(status IS DISTINCT FROM 'decommissioned'), count_if(status IS DISTINCT FROM 'decommissioned')
                FROM stations
         UNION ALL SELECT 3, 'round', '3 decimal places', count_if(status IS DISTINCT FROM 'decommissioned'),
                count_if(status IS DISTINCT FROM 'decommissioned') FROM stations)
       , LATERAL (SELECT CAST(greatest(0, features_in - features_out) AS BIGINT) AS removed)""", "stations"))
def q_t_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in/out per step from one aggregation pass."""
    return TR.step_counts(X.stations(spark, sf_dir), STATION_STEPS)


@query("t_chain", with_fixtures(
    f"SELECT ord, {station_feature_json(precision=2, props=('station_id', 'pm25', 'country'), rename={'pm25': 'pm'})} "
    "AS feature_json FROM stations WHERE pm25 > 0", "stations"))
def q_t_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter -> rename -> select -> round, in order."""
    steps = [Step("filter", "pm25 > 0"), Step("rename", {"pm25": "pm"}), Step("select", ["station_id", "pm", "country"]),
             Step("round", 2)]
    return _json_out(apply_steps(X.stations(spark, sf_dir), steps))


@query("geometry_problem", with_fixtures(f"SELECT key, {ZONE_PROBLEM_SQL} AS problem FROM zones", "zones"))
def q_geometry_problem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: first structural problem of each zone geometry."""
    return X.zone_features(spark, sf_dir).select("key", geo.built(geo.geometry_problem).alias("problem"))


@query("geometry_types", with_fixtures(
    f"SELECT {ZONE_TYPE_SQL} AS geometry_type, count(*) AS n, count_if(fault = 0) AS n_valid "
    "FROM zones GROUP BY 1", "zones"))
def q_geometry_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geometry type histogram with the valid count."""
    g = F.col("geometry")
    kind = F.when(F.schema_of_variant(g).startswith("OBJECT"),
                  F.coalesce(F.try_variant_get(g, "$.type", "string"), F.lit("null"))).otherwise(F.lit("null"))
    df = X.zone_features(spark, sf_dir).select(kind.alias("geometry_type"),
                                               geo.geometry_problem(g).isNull().alias("valid"))
    return df.groupBy("geometry_type").agg(F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("n_valid"))


@query("positions", with_fixtures(f"SELECT {_TRACK_SQL} AS track_id, lon, lat FROM tracks", "tracks"))
def q_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every position of every track."""
    df = X.tracks(spark, sf_dir).select("track_id", F.explode(geo.positions(F.col("geometry"))).alias("p"))
    return df.select("track_id", F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat"))


@query("bbox", with_fixtures(
    "SELECT user_id, min(lon) AS min_lon, min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat "
    "FROM tracks GROUP BY user_id", "tracks"))
def q_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounding box per user over all their tracks (per-row min/max, then partial aggregation)."""
    df = X.tracks(spark, sf_dir)
    a, b, c, d = geo.built(geo.bbox_parts)
    return (df.select("user_id", a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d"))
            .groupBy("user_id").agg(F.min("a").alias("min_lon"), F.min("b").alias("min_lat"),
                                    F.max("c").alias("max_lon"), F.max("d").alias("max_lat")))


# --------------------------------------------------------------------------
# Filter predicates with the reference language's null rules (P*)
# --------------------------------------------------------------------------

from pyspark.sql import types as T  # noqa: E402

_S, _D, _B = T.StringType(), T.DoubleType(), T.BooleanType()


def _pred(name: str, sql_cols: str, build):
    """Register ``SELECT key, <cols> FROM stations`` in both engines."""

    @query(name, with_fixtures(f"SELECT key, {sql_cols} FROM stations", "stations"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = X.stations(spark, sf_dir)
        return df.select("key", *[c.alias(n) for n, c in build(df).items()])

    run.__doc__ = f"{name}: predicate helper over every station."
    return run


_pred("p_missing_property", "false AS result, true AS result_not",
      lambda df: {"result": P.gt(P.prop(df, "altitude"), 10), "result_not": ~P.gt(P.prop(df, "altitude"), 10)})
_pred("p_eq", "segment IS NOT DISTINCT FROM 'BUILDING' AS result, segment IS NULL AS eq_null",
      lambda df: {"result": P.eq(F.col("segment"), "BUILDING"), "eq_null": P.eq(F.col("segment"), None)})
_pred("p_ne", "segment IS DISTINCT FROM 'BUILDING' AS result",
      lambda df: {"result": P.ne(F.col("segment"), "BUILDING")})
_pred("p_order", "coalesce(segment > 'FURNITURE', false) AS gt, NOT coalesce(segment > 'FURNITURE', false) AS not_gt, "
      "pm25 <= 100 AS le",
      lambda df: {"gt": P.gt(F.col("segment"), "FURNITURE"), "not_gt": ~P.gt(F.col("segment"), "FURNITURE"),
                  "le": P.le(F.col("pm25"), 100)})
_pred("p_chain", "1000 < pm25 AND pm25 <= 5000 AS result",
      lambda df: {"result": P.chain(F.lit(1000), ("<", F.col("pm25")), ("<=", 5000))})
_pred("p_in", "country IN (1, 2, 3) AS in_list, (segment IN ('BUILDING') OR segment IS NULL) AS in_with_null",
      lambda df: {"in_list": P.is_in(F.col("country"), [1, 2, 3]),
                  "in_with_null": P.is_in(F.col("segment"), ["BUILDING", None])})
_pred("p_not_in", "NOT coalesce(segment IN ('BUILDING', 'MACHINERY'), false) AS result, true AS null_container",
      lambda df: {"result": P.not_in(F.col("segment"), ["BUILDING", "MACHINERY"]),
                  "null_container": P.not_in(F.col("segment"), None)})
_pred("p_is", "segment IS NULL AS is_none, segment IS NOT NULL AS is_not_none",
      lambda df: {"is_none": P.is_(F.col("segment"), None), "is_not_none": P.is_not(F.col("segment"), None)})
_pred("p_bool", "coalesce(segment, status) AS or_value, "
      "CASE WHEN coalesce(length(segment) > 0, false) THEN status ELSE segment END AS and_value, "
      "NOT coalesce(length(segment) > 0, false) AS not_value, "
      "(pm25 <> 0 AND country <> 0) AS both_truthy",
      lambda df: {"or_value": P.py_or(F.col("segment"), _S, F.col("status")),
                  "and_value": P.py_and(F.col("segment"), _S, F.col("status")),
                  "not_value": P.py_not(F.col("segment"), _S),
                  "both_truthy": P.truthy(F.col("pm25"), _D) & P.truthy(F.col("country"), T.IntegerType())})
_pred("p_arith", "pm25 * 2 + country - 1 AS expr, -pm25 AS neg",
      lambda df: {"expr": F.col("pm25") * 2 + F.col("country") - 1, "neg": -F.col("pm25")})
_pred("p_div", "pm25 / (country + 1) AS result",
      lambda df: {"result": P.div(F.col("pm25"), F.col("country") + 1)})
_pred("p_floordiv_mod", "CAST(floor((key - 700) / 7) AS BIGINT) AS floordiv, "
      "((key - 700) % -7 + -7) % -7 AS mod_neg, ((key - 700) % 7 + 7) % 7 AS mod_pos",
      lambda df: {"floordiv": P.floordiv(F.col("key") - 700, 7), "mod_neg": P.mod(F.col("key") - 700, -7),
                  "mod_pos": P.mod(F.col("key") - 700, 7)})
_pred("p_ifexp", "CASE WHEN coalesce(length(segment) > 0, false) THEN 'A' ELSE 'B' END AS result",
      lambda df: {"result": P.if_else(F.col("segment"), _S, "A", "B")})
_pred("p_len", "CAST(coalesce(length(segment), 0) AS BIGINT) AS result",
      lambda df: {"result": P.length(F.col("segment"), _S)})
_pred("p_case", "lower(station_id) AS low, upper(lower(segment)) AS up",
      lambda df: {"low": P.lower(F.col("station_id")), "up": P.upper(F.lower(F.col("segment")))})
_pred("p_abs", "abs(pm25) AS result", lambda df: {"result": F.abs(F.col("pm25"))})
_pred("p_casts", "CAST(trunc(pm25) AS BIGINT) AS as_int, CAST(country AS DOUBLE) AS as_float",
      lambda df: {"as_int": P.to_int(F.col("pm25")), "as_float": P.to_float(F.col("country"))})
_pred("p_str_bool", "coalesce(segment, '') AS as_str, pm25 <> 0 AS as_bool",
      lambda df: {"as_str": P.to_str(F.col("segment")), "as_bool": P.truthy(F.col("pm25"), _D)})
_pred("p_affix", "coalesce(starts_with(segment, 'BUILD'), false) AS starts, "
      "coalesce(suffix(station_id, '7'), false) AS ends, false AS non_string",
      lambda df: {"starts": P.startswith(F.col("segment"), _S, "BUILD"),
                  "ends": P.endswith(F.col("station_id"), _S, "7"),
                  "non_string": P.startswith(F.col("pm25"), _D, "1")})
_pred("p_contains", "coalesce(contains(segment, 'NIT'), false) AS substring, "
      "coalesce(list_contains([segment, status], 'active'), false) AS member",
      lambda df: {"substring": P.contains(F.col("segment"), _S, "NIT"),
                  "member": P.contains(F.array("segment", "status"), T.ArrayType(_S), "active")})
_pred("p_null_fns", "segment IS NULL AS null_check, coalesce(segment, status) AS first_present",
      lambda df: {"null_check": P.is_null(F.col("segment")), "first_present": P.coalesce(F.col("segment"), F.col("status"))})


# --------------------------------------------------------------------------
# Sources (S*) and record mapping (B*)
# --------------------------------------------------------------------------

from featureflow.operators import features as B  # noqa: E402
from featureflow.sources import csv as CSV  # noqa: E402
from featureflow.sources import geojson as GJ  # noqa: E402
from featureflow.sources import jsonrec as JR  # noqa: E402
from featureflow.sources import landing as LD  # noqa: E402
from featureflow.sources.files import file_freshness  # noqa: E402
from featureflow.sources.sql import scan_sql  # noqa: E402
from featureflow.plans.oracle import DOC_PROBLEM_SQL  # noqa: E402


def _point_cols(df: DataFrame) -> list:
    g = F.col("geometry")
    return [F.variant_get(g, "$.coordinates[0]", "double").alias("lon"),
            F.variant_get(g, "$.coordinates[1]", "double").alias("lat")]


@query("scan_geojson", with_fixtures(
    "SELECT chunk AS doc, CAST(row_number() OVER (PARTITION BY chunk ORDER BY event_id) - 1 AS BIGINT) AS pos, "
    "CAST(event_id AS VARCHAR) AS id, event_type, k, lon, lat FROM ev", "ev"))
def q_scan_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FeatureCollection documents exploded to features (position kept)."""
    f = GJ.parse_geojson(X.geojson_docs(spark, sf_dir))
    return f.select(F.col("_doc").alias("doc"), F.col("_ord").alias("pos"), F.to_json("_id").alias("id"),
                    F.variant_get("_props", "$.event_type", "string").alias("event_type"),
                    F.variant_get("_props", "$.k", "int").alias("k"), *_point_cols(f))


@query("scan_geojson_shapes", with_fixtures(
    "SELECT event_id AS doc, CAST(0 AS BIGINT) AS pos, CASE WHEN event_id % 4 = 3 THEN NULL "
    "ELSE CAST(event_id AS VARCHAR) END AS id, CASE WHEN event_id % 4 = 3 THEN 0 ELSE 3 END AS n_props, lon, lat "
    "FROM ev", "ev"))
def q_scan_geojson_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collection / array / bare Feature / bare geometry documents, one feature each."""
    f = GJ.parse_geojson(X.shape_docs(spark, sf_dir))
    n_props = F.size(F.map_keys(F.variant_get("_props", "$", "map<string,variant>")))
    return f.select(F.col("_doc").alias("doc"), F.col("_ord").alias("pos"), F.to_json("_id").alias("id"),
                    n_props.alias("n_props"), *_point_cols(f))


@query("payload_problems", with_fixtures(f"SELECT event_id AS doc, {DOC_PROBLEM_SQL} AS problem FROM events"))
def q_payload_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first reason a document cannot be used, or null."""
    docs = X.problem_docs(spark, sf_dir)
    doc = F.try_parse_json("value")
    items = GJ.feature_items(doc)
    first_item = F.get(F.filter(F.transform(items, lambda x, i: GJ.item_problem(x, i)), lambda p: p.isNotNull()), 0)
    return docs.select(F.col("_doc").alias("doc"), F.coalesce(GJ.document_problem(F.col("value")), first_item)
                       .alias("problem"))


@query("scan_json_records", with_fixtures(
    "SELECT chunk AS doc, CAST(row_number() OVER (PARTITION BY chunk ORDER BY event_id) - 1 AS BIGINT) AS pos, "
    "event_id AS id, event_type AS type, lon, lat FROM ev", "ev"))
def q_scan_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + B1: records under ``$.data.items`` mapped to points."""
    records, _ = JR.scan_json_records(X.json_docs(spark, sf_dir), "$.data.items")
    r = F.col("rec")
    recs = records.select("_doc", "_ord", F.variant_get(r, "$.id", "long").alias("id"),
                          F.variant_get(r, "$.type", "string").alias("type"),
                          F.variant_get(r, "$.lon", "variant").alias("lon_v"),
                          F.variant_get(r, "$.lat", "variant").alias("lat_v"))
    f = B.map_point(recs, "lon_v", "lat_v")
    return f.select(F.col("_doc").alias("doc"), F.col("_ord").alias("pos"), "id", "type", *_point_cols(f))


@query("select_path", with_fixtures(
    "SELECT chunk AS doc, min(event_id) AS first_id, max(event_id) AS last_id, chunk AS odd, "
    "arg_max(k, event_id) AS last_k FROM ev GROUP BY chunk", "ev"))
def q_select_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index, negative index and quoted-member selectors."""
    docs = X.json_docs(spark, sf_dir)
    d = F.try_parse_json("value")
    first, _ = JR.select_path(d, "$.data.items[0].id")
    last, _ = JR.select_path(d, "$.data.items[-1].id")
    odd, _ = JR.select_path(d, '$["odd.key"]')
    last_k, _ = JR.select_path(d, "data.items[-1].k")
    return docs.select(F.col("_doc").alias("doc"), F.variant_get(first, "$", "long").alias("first_id"),
                       F.variant_get(last, "$", "long").alias("last_id"), F.variant_get(odd, "$", "long").alias("odd"),
                       F.variant_get(last_k, "$", "int").alias("last_k"))


@query("select_wildcard", with_fixtures(
    "SELECT chunk AS doc, count(*) AS n_values, CAST(sum(k) AS BIGINT) AS total_k, count(*) AS n_items "
    "FROM ev GROUP BY chunk", "ev"))
def q_select_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``[*]`` over an object's values and over a list."""
    docs = X.json_docs(spark, sf_dir)
    d = F.try_parse_json("value")
    vals, _ = JR.select_path(d, "$.data.byid[*]")
    items, _ = JR.select_path(d, "$.data.items[*]")
    arr = F.variant_get(vals, "$", "array<bigint>")
    return docs.select(F.col("_doc").alias("doc"), F.size(arr).cast("long").alias("n_values"),
                       F.aggregate(arr, F.lit(0).cast("long"), lambda a, x: a + x).alias("total_k"),
                       F.size(F.variant_get(items, "$", "array<variant>")).cast("long").alias("n_items"))


@query("scan_csv", with_fixtures(
    "SELECT station_id, country, lon, lat, CASE WHEN right(printf('%.2f', pm25), 1) = '0' THEN 'str' ELSE 'float' END "
    "AS pm25_kind FROM stations", "stations"))
def q_scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6/S7: ';'-delimited lines (delimiter sniffed from the header) coerced and mapped to points."""
    header = "station_id;country;lon;lat;pm25"
    sep = CSV.sniff_delimiter(header)
    rows = CSV.parse_lines(X.station_csv_lines(spark, sf_dir, sep), header.split(sep), sep)
    f = B.map_point(rows.withColumn("_ord", F.col("key")), "lon", "lat")
    return f.select("station_id", F.variant_get(CSV.coerce(F.col("country")), "$", "int").alias("country"),
                    *_point_cols(f), CSV.coerce_kind(F.col("pm25")).alias("pm25_kind"))


@query("csv_coerce", with_fixtures(
    """SELECT o_orderkey AS key, cell, CASE o_orderkey % 12 WHEN 0 THEN CASE WHEN cell LIKE '0%' THEN 'str' ELSE 'int' END
         WHEN 1 THEN CASE WHEN right(cell, 1) = '0' THEN 'str' ELSE 'float' END
         WHEN 2 THEN 'int' WHEN 3 THEN 'bool' WHEN 4 THEN 'bool' WHEN 5 THEN 'null' WHEN 6 THEN 'null'
         WHEN 7 THEN 'str' WHEN 8 THEN 'str' WHEN 9 THEN 'str' WHEN 10 THEN 'int' ELSE 'str' END AS kind
       FROM (SELECT o_orderkey, CASE o_orderkey % 12 WHEN 0 THEN lpad(CAST(o_orderkey AS VARCHAR), 8, '0')
         WHEN 1 THEN printf('%.2f', o_totalprice) WHEN 2 THEN ' 5 ' WHEN 3 THEN 'true' WHEN 4 THEN 'FALSE'
         WHEN 5 THEN 'null' WHEN 6 THEN '' WHEN 7 THEN '+44' WHEN 8 THEN '1e5' WHEN 9 THEN '-0'
         WHEN 10 THEN CAST(o_orderkey AS VARCHAR) ELSE ' ' || o_orderpriority END AS cell FROM orders)"""))
def q_csv_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-cell type coercion with exact round-trip rules."""
    c = X.cells(spark, sf_dir)
    return c.select("key", "cell", CSV.coerce_kind(F.col("cell")).alias("kind"))


@query("csv_ragged", with_fixtures(
    "SELECT key, key % 7 = 0 AS too_many, CASE WHEN key % 7 = 1 THEN NULL ELSE printf('%.2f', pm25) END AS pm25 "
    "FROM stations", "stations"))
def q_csv_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longer rows flagged, shorter rows null-filled."""
    header = ["station_id", "country", "lon", "lat", "pm25"]
    rows = CSV.parse_lines(X.station_csv_lines(spark, sf_dir, ",", ragged=True), header, ",")
    return rows.select("key", F.col("_too_many").alias("too_many"), "pm25")


@query("scan_sql", with_fixtures(
    "SELECT code, name, CAST((code * 7919) % 359999 AS DOUBLE) / 1000 - 179.99969 AS lon, "
    "CAST((code * 104729) % 179999 AS DOUBLE) / 1000 - 89.99969 AS lat FROM "
    "(SELECT c_custkey AS code, c_name AS name FROM customer WHERE c_acctbal > 0)"))
def q_scan_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL statement as a source, its rows mapped to points."""
    X.table(spark, sf_dir, "customer").createOrReplaceTempView("ff_customer")
    rows = scan_sql(spark, "SELECT c_custkey AS code, c_name AS name, "
                           "CAST((c_custkey * 7919) % 359999 AS DOUBLE) / 1000 - 179.99969 AS lon, "
                           "CAST((c_custkey * 104729) % 179999 AS DOUBLE) / 1000 - 89.99969 AS lat "
                           "FROM ff_customer WHERE c_acctbal > 0")
    f = B.map_point(rows.withColumn("_ord", F.col("code")), "lon", "lat")
    return f.select("code", "name", *_point_cols(f))


@query("file_freshness")
def q_file_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and HTTP-date mtime of the table files, without reading their bytes."""
    return file_freshness(spark, f"{sf_dir}/*.parquet")


@query("landing_latest", with_fixtures(
    "SELECT source, strftime(arg_max(fetched_at, fetched_at), '%Y-%m-%dT%H:%M:%SZ') AS fetched_at, "
    "arg_max(etag, fetched_at) AS etag, arg_max(attempts, fetched_at) AS attempts "
    "FROM landing WHERE status < 400 GROUP BY source", "landing"))
def q_landing_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest successful landed response per source."""
    latest = LD.latest_success(X.landing(spark, sf_dir))
    from featureflow.functions.freshness import iso8601
    return latest.select("source", iso8601(F.col("fetched_at")).alias("fetched_at"), "etag", "attempts")


@query("landing_status_classes", with_fixtures(
    "SELECT source, CASE WHEN status < 400 THEN 'ok' WHEN status IN (408, 425, 429, 500, 502, 503, 504, 507, 509) "
    "THEN 'transient' ELSE 'permanent' END AS class, count(*) AS n FROM landing GROUP BY 1, 2", "landing"))
def q_landing_status_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses per source and status class."""
    ld = X.landing(spark, sf_dir)
    return ld.groupBy("source", LD.status_class(F.col("status")).alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query("decode_payload", with_fixtures("SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS n_bytes, "
                                       "true AS valid_utf8 FROM pages"))
def q_decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload bytes and UTF-8 validity of landed pages."""
    p = X.table(spark, sf_dir, "pages")
    content = F.encode("html", "UTF-8")
    return p.select("page_id", F.octet_length(content).cast("long").alias("n_bytes"),
                    CSV.decode_check(content).alias("valid_utf8"))


@query("fetch_stats", with_fixtures(
    "SELECT source, count(*) AS responses, CAST(sum(bytes_read) AS BIGINT) AS bytes_read, max(attempts) AS max_attempts, "
    "count_if(status < 400) AS ok, count_if(status IN (408, 425, 429, 500, 502, 503, 504, 507, 509)) AS transient, "
    "count_if(status >= 400 AND status NOT IN (408, 425, 429, 500, 502, 503, 504, 507, 509)) AS permanent "
    "FROM landing GROUP BY source", "landing"))
def q_fetch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch statistics per source."""
    return LD.fetch_stats(X.landing(spark, sf_dir))


@query("redact_origin", with_fixtures(
    "SELECT event_id, regexp_replace(url, '^(.*?)://.*@', '\\1://***@') AS origin FROM landing", "landing"))
def q_redact_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Origins with credentials removed."""
    return X.landing(spark, sf_dir).select("event_id", LD.redact_origin(F.col("url")).alias("origin"))


@query("map_point", with_fixtures(
    """SELECT key, CASE WHEN key % 31 = 0 OR key % 37 = 0 THEN NULL ELSE lon END AS lon,
              CASE WHEN key % 31 = 0 OR key % 37 = 0 THEN NULL ELSE lat END AS lat,
              CASE WHEN key % 31 = 0 THEN 'record ' || CAST(key AS VARCHAR) || ': field ''lon'' is not a number (''n/a'')'
                   WHEN key % 37 = 0 THEN 'record ' || CAST(key AS VARCHAR) || ': field ''lat'' is not a number (None)'
              END AS problem FROM stations""", "stations"))
def q_map_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: Point from text fields; bad values reported with record index and field."""
    s = X.stations_raw(spark, sf_dir)
    k = F.col("key")
    recs = s.select("key", F.when(k % 31 == 0, F.lit("n/a")).otherwise(F.col("lon").cast("string")).alias("lon"),
                    F.when(k % 37 == 0, F.lit(None).cast("string")).otherwise(F.col("lat").cast("string")).alias("lat"))
    f = B.map_point(recs, "lon", "lat", index_col="key")
    return f.select("key", *_point_cols(f), F.col("_problem").alias("problem"))


@query("map_geometry_field", with_fixtures(
    f"SELECT key, CASE WHEN fault = 0 THEN NULL ELSE 'record ' || CAST(key AS VARCHAR) || "
    f"': field ''shape'' is not a valid GeoJSON geometry (' || ({ZONE_PROBLEM_SQL}) || ')' END AS problem FROM zones",
    "zones"))
def q_map_geometry_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: geometry from a JSON-text field, validated."""
    f = B.map_geometry_field(X.zones(spark, sf_dir), "shape", index_col="key")
    return f.select("key", F.col("_problem").alias("problem"))


@query("map_properties_list", with_fixtures(
    f"SELECT ord, {station_feature_json(precision=None, props=('station_id', 'pm25'))} AS feature_json FROM stations",
    "stations"))
def q_map_properties_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An explicit property list."""
    return _json_out(B.map_properties(X.stations(spark, sf_dir), ["station_id", "pm25"]))


@query("map_properties_star", with_fixtures(
    f"SELECT ord, {station_feature_json(precision=None, props=('key', 'station_id', 'country', 'pm25', 'status', 'segment'))} "
    "AS feature_json FROM stations", "stations"))
def q_map_properties_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``*`` keeps every field except the geometry ones."""
    return _json_out(B.map_properties(X.stations(spark, sf_dir), "*"))


@query("map_id", with_fixtures(
    "SELECT ord, replace(" + station_feature_json(precision=None, props=('station_id',)) +
    ", '\"properties\"', '\"id\":' || to_json(station_id) || ',\"properties\"') AS feature_json FROM stations",
    "stations"))
def q_map_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id field becomes the top-level feature id and stays a property."""
    f = B.map_id(B.map_properties(X.stations(spark, sf_dir), ["station_id"]), "station_id")
    return _json_out(f)


# --------------------------------------------------------------------------
# Freshness, manifest and gates (F*, V*)
# --------------------------------------------------------------------------

from featureflow.functions import freshness as FR  # noqa: E402
from featureflow.operators import manifest as M  # noqa: E402
from featureflow.plans.oracle import humanize_sql  # noqa: E402

_ISO = "'%Y-%m-%dT%H:%M:%SZ'"
_CARRIED = """
    carried AS (SELECT *, last_value(fetched_at IGNORE NULLS) OVER w AS last_fetched_at,
                       last_value(content_hash IGNORE NULLS) OVER w AS last_content_hash,
                       last_value(feature_count IGNORE NULLS) OVER w AS last_feature_count
                FROM runs WINDOW w AS (PARTITION BY source ORDER BY run_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    st AS (SELECT *, lag(last_content_hash) OVER (PARTITION BY source ORDER BY run_ts) AS previous_content_hash FROM carried),
    st2 AS (SELECT *, ok AND NOT coalesce(content_hash = previous_content_hash, false) AS changed FROM st),
    man AS (SELECT *, CASE WHEN NOT ok THEN 'failed' WHEN changed THEN 'ok' ELSE 'unchanged' END AS status,
                   CASE WHEN last_fetched_at IS NOT NULL THEN CAST(floor(greatest(0, (epoch_us(now) - epoch_us(last_fetched_at)) / 1e6)) AS BIGINT) END AS age_seconds,
                   CASE WHEN max_age IS NULL THEN false WHEN last_fetched_at IS NULL THEN true
                        ELSE (epoch_us(now) - epoch_us(last_fetched_at)) / 1e6 > max_age END AS stale
            FROM st2)"""


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.with_freshness(M.source_status(X.runs(spark, sf_dir)))


def _iso(c: str) -> Column:
    return FR.iso8601(F.col(c)).alias(c)


@query("iso8601", with_fixtures(f"SELECT event_id, strftime(ts, {_ISO}) AS iso, true AS roundtrip FROM events"))
def q_iso8601(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO-8601 UTC text and its parse back."""
    e = X.table(spark, sf_dir, "events").select("event_id", FR.iso8601(F.col("ts")).alias("iso"))
    return e.select("event_id", "iso", (FR.iso8601(FR.parse_iso8601(F.col("iso"))) == F.col("iso")).alias("roundtrip"))


@query("durations", with_fixtures(
    "SELECT p_partkey AS key, CAST(CASE p_partkey % 7 WHEN 0 THEN p_size WHEN 1 THEN p_size * 60 WHEN 2 THEN p_size * 3600 "
    "WHEN 3 THEN p_size * 86400 WHEN 4 THEN p_size * 604800 WHEN 5 THEN p_size + 0.5 END AS DOUBLE) AS seconds FROM part"))
def q_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """duration text to seconds; an unknown unit is null."""
    d = X.durations(spark, sf_dir)
    return d.select("key", FR.parse_duration(F.col("text")).alias("seconds"))


@query("age_seconds", with_fixtures(f"SELECT source, strftime(run_ts, {_ISO}) AS run_ts, age_seconds FROM man",
                                    "runs", extra=_CARRIED))
def q_age_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seconds since the last good fetch at each run."""
    return _manifest(spark, sf_dir).select("source", _iso("run_ts"), "age_seconds")


@query("humanize_age", with_fixtures(
    f"SELECT event_id, {humanize_sql('s')} AS age FROM (SELECT event_id, "
    "CAST((event_id * 7919) % 40000000 - 100 AS DOUBLE) AS s FROM events)"))
def q_humanize_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """humanised ages from the future to years."""
    e = X.table(spark, sf_dir, "events")
    s = ((F.col("event_id") * 7919) % 40000000 - 100).cast("double")
    return e.select("event_id", FR.humanize_age(s).alias("age"))


@query("stale_flags", with_fixtures(f"SELECT source, strftime(run_ts, {_ISO}) AS run_ts, stale FROM man",
                                    "runs", extra=_CARRIED))
def q_stale_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stale when older than max_age; no max_age never; never fetched always."""
    return _manifest(spark, sf_dir).select("source", _iso("run_ts"), "stale")


@query("carry_forward", with_fixtures(
    f"SELECT source, strftime(run_ts, {_ISO}) AS run_ts, strftime(last_fetched_at, {_ISO}) AS last_fetched_at, "
    "last_content_hash, last_feature_count FROM carried", "runs", extra=_CARRIED))
def q_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """failed runs inherit the last good fetch time, hash and count."""
    c = M.carry_forward(X.runs(spark, sf_dir))
    return c.select("source", _iso("run_ts"), _iso("last_fetched_at"), "last_content_hash", "last_feature_count")


@query("source_status", with_fixtures(
    f"SELECT source, strftime(run_ts, {_ISO}) AS run_ts, status, previous_content_hash FROM man", "runs", extra=_CARRIED))
def q_source_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ok / unchanged / failed per source and run."""
    return _manifest(spark, sf_dir).select("source", _iso("run_ts"), "status", "previous_content_hash")


@query("run_outcome", with_fixtures(
    f"SELECT strftime(run_ts, {_ISO}) AS run_ts, CASE WHEN bool_or(status = 'failed') THEN 4 "
    "WHEN bool_or(changed) THEN 0 ELSE 3 END AS exit_code FROM man GROUP BY run_ts", "runs", extra=_CARRIED))
def q_run_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: exit code per run."""
    fetch = F.when(F.col("status") == "failed", F.lit(M.EXIT_FETCH_FAILURE)).alias("error_code")  # the fixture's runs fail to fetch
    return M.run_outcome(_manifest(spark, sf_dir).select("*", fetch)).select(_iso("run_ts"), "exit_code")


@query("manifest_totals", with_fixtures(
    f"SELECT strftime(run_ts, {_ISO}) AS run_ts, count(*) AS sources, CAST(coalesce(sum(last_feature_count), 0) AS BIGINT) "
    "AS features, count_if(changed) AS changed_sources, count_if(stale) AS stale_sources, "
    "count_if(status = 'failed') AS failed_sources, bool_or(changed) AS changed, bool_or(stale) AS stale "
    "FROM man GROUP BY run_ts", "runs", extra=_CARRIED))
def q_manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run totals and any-flags."""
    t = M.manifest_totals(_manifest(spark, sf_dir))
    return t.select(_iso("run_ts"), *[c for c in t.columns if c != "run_ts"])


@query("freshness_state", with_fixtures(
    f"""SELECT strftime(run_ts, {_ISO}) AS run_ts, state, label, title, age_seconds FROM (
          SELECT run_ts, CASE WHEN any_failed THEN 'failed' WHEN any_stale THEN 'stale' ELSE 'fresh' END AS state,
                 CASE WHEN any_failed THEN 'Refresh failed — showing data from ' || txt
                      WHEN any_stale THEN 'Data may be out of date — updated ' || txt ELSE 'Updated ' || txt END AS label,
                 CASE WHEN any_failed THEN failed WHEN any_stale THEN old ELSE CAST(features AS VARCHAR) || ' features across '
                      || CAST(n AS VARCHAR) || ' source(s)' END AS title, age AS age_seconds
          FROM (SELECT *, coalesce({humanize_sql('CAST(age AS DOUBLE)')}, 'unknown') AS txt FROM (
                SELECT run_ts, bool_or(status = 'failed') AS any_failed, bool_or(stale) AS any_stale,
                       CASE WHEN bool_or(age_seconds IS NULL) THEN NULL ELSE max(age_seconds) END AS age,
                       count(*) AS n, CAST(coalesce(sum(last_feature_count), 0) AS BIGINT) AS features,
                       string_agg(source || ': failed', chr(10) ORDER BY source) FILTER (WHERE status = 'failed') AS failed,
                       string_agg(source || ' is older than its ' || replace({humanize_sql('max_age')}, ' ago', '') || ' limit',
                                  chr(10) ORDER BY source) FILTER (WHERE stale) AS old
                FROM man GROUP BY run_ts)))""", "runs", extra=_CARRIED))
def q_freshness_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """badge state, label and title per run."""
    f = M.freshness_state(_manifest(spark, sf_dir))
    return f.select(_iso("run_ts"), "state", "label", "title", "age_seconds")


@query("status_report", with_fixtures(
    f"SELECT strftime(run_ts, {_ISO}) AS run_ts, source, CASE WHEN age_seconds IS NULL THEN 'never fetched' "
    f"ELSE {humanize_sql('CAST(age_seconds AS DOUBLE)')} END AS age, CAST(coalesce(last_feature_count, 0) AS BIGINT) "
    "AS features, concat_ws(' ', CASE WHEN stale THEN 'STALE' END, CASE WHEN status = 'failed' THEN 'FAILED' "
    "WHEN changed THEN 'changed' ELSE status END) AS flags FROM man", "runs", extra=_CARRIED))
def q_status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """status table rows."""
    r = M.status_report(_manifest(spark, sf_dir))
    return r.select(_iso("run_ts"), "source", "age", "features", "flags")


@query("publish_gate", with_fixtures(
    f"SELECT strftime(run_ts, {_ISO}) AS run_ts, bool_or(status = 'failed') AS blocked, "
    "count_if(status = 'failed') AS failed_sources FROM man GROUP BY run_ts", "runs", extra=_CARRIED))
def q_publish_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: any failed source blocks publishing for the run."""
    return M.publish_gate(_manifest(spark, sf_dir)).select(_iso("run_ts"), "blocked", "failed_sources")


@query("nonfinite_check", with_fixtures(
    "SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS \"column\", "
    "unnest([count_if(isnan(l_quantity) OR isinf(l_quantity)), count_if(isnan(l_extendedprice) OR isinf(l_extendedprice)), "
    "count_if(isnan(l_discount) OR isinf(l_discount)), count_if(isnan(l_tax) OR isinf(l_tax))]) AS nonfinite FROM lineitem"))
def q_nonfinite_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: NaN/Infinity per numeric column (one scan)."""
    return M.nonfinite_counts(X.table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


# --------------------------------------------------------------------------
# Runs, sinks and state (R*, O*, V1, F9)
# --------------------------------------------------------------------------

from featureflow.operators import publish as PUB  # noqa: E402
from featureflow.plans.refresh import SourceSpec, empty_state, refresh  # noqa: E402

RUN_NOW = "2024-01-31 00:00:00"


def _specs(sf_dir: str, prev: bool = False, depot_min: int = 1) -> list[SourceSpec]:
    stations = X.stations_prev_raw if prev else X.stations_raw
    return [SourceSpec("stations", lambda s: stations(s, sf_dir), tuple(STATION_STEPS), "station_id", 1, 86400.0, X.as_features),
            SourceSpec("depots", lambda s: X.depots_raw(s, sf_dir), (), "depot_id", depot_min, None, X.as_features)]


def _two_runs(spark: SparkSession, sf_dir: str, **kw):
    """The previous run (stations_prev, depots) from an empty state, then the current run on its state."""
    idx, meta = empty_state(spark)
    before = refresh(spark, _specs(sf_dir, prev=True), idx, meta, "2024-01-30 00:00:00", dry_run=True)
    depot_min = kw.pop("depot_min", 1)
    return refresh(spark, _specs(sf_dir, depot_min=depot_min), before.next_index, before.next_meta, RUN_NOW,
                   dry_run=True, **kw)


_RUN_SQL = _FEED_SQL + f""",
    dep AS (SELECT count(*) AS n, min(lon) AS min_lon, min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat
            FROM depots),
    sta AS (SELECT count(*) AS n, min(round(lon, 3)) AS min_lon, min(round(lat, 3)) AS min_lat,
                   max(round(lon, 3)) AS max_lon, max(round(lat, 3)) AS max_lat FROM stations WHERE {_ACTIVE}),
    cnt AS (SELECT count_if(op = 'added') AS added, count_if(op = 'removed') AS removed,
                   count_if(op = 'modified') AS modified, count_if(op = 'unchanged') AS unchanged FROM feed)"""


@query("refresh", with_fixtures(
    """SELECT 'stations' AS source, 'ok' AS status, sta.n AS feature_count, true AS changed, added, removed, modified,
              unchanged, true AS keyed, false AS first_run, min_lon, min_lat, max_lon, max_lat, false AS stale
       FROM sta, cnt
       UNION ALL
       SELECT 'depots', 'unchanged', n, false, 0, 0, 0, n, true, false, min_lon, min_lat, max_lon, max_lat, false
       FROM dep""", "stations", "stations_prev", "depots", extra=_RUN_SQL))
def q_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh run over two sources against the previous run's state."""
    m = _two_runs(spark, sf_dir).manifest
    return m.select("source", "status", "feature_count", "changed", "added", "removed", "modified", "unchanged",
                    "keyed", "first_run", "min_lon", "min_lat", "max_lon", "max_lat", "stale")


@query("refresh_dry_run", with_fixtures(
    "SELECT 'stations' AS source, 'ok' AS status, 'would write geojson features/_source=stations' AS output "
    "UNION ALL SELECT 'depots', 'unchanged', NULL"))
def q_refresh_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: everything computed, nothing written; the planned outputs are reported."""
    r = _two_runs(spark, sf_dir)
    planned = spark.createDataFrame([(o.rsplit("=", 1)[-1], o) for o in r.outputs], "source STRING, output STRING")
    return r.manifest.join(planned, "source", "left").select("source", "status", "output")


@query("subset_run", with_fixtures(
    "SELECT 'stations' AS source, 'skipped' AS status, false AS changed, count(*) AS feature_count FROM stations_prev "
    f"WHERE {_ACTIVE} UNION ALL SELECT 'depots', 'unchanged', false, count(*) FROM depots",
    "stations", "stations_prev", "depots"))
def q_subset_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only 'depots' runs; 'stations' is skipped and carries its previous count."""
    m = _two_runs(spark, sf_dir, only=["depots"]).manifest
    return m.select("source", "status", "changed", "feature_count")


@query("next_state", with_fixtures(
    f"SELECT 'stations' AS source, key, hash FROM ({_station_index_sql('stations')}) "
    f"UNION ALL SELECT 'depots', depot_id, sha256({_DEPOT_JSON}) FROM depots", "stations", "depots"))
def q_next_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A failed source (depots, min_features unmet) keeps its old state rows; stations gets its new index."""
    r = _two_runs(spark, sf_dir, depot_min=10**9)
    return r.next_index.select("source", "key", "hash")


@query("publish_changed", with_fixtures(
    f"SELECT 'stations' AS source, count(*) AS published FROM stations WHERE {_ACTIVE}", "stations"))
def q_publish_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only changed sources' features are published (semi join on the manifest's changed flag)."""
    r = _two_runs(spark, sf_dir)
    changed = r.manifest.where("changed").select(F.col("source").alias("_source"))
    return (r.features.join(changed, "_source", "left_semi").groupBy(F.col("_source").alias("source"))
            .agg(F.count(F.lit(1)).alias("published")))


@query("min_features_gate", with_fixtures(
    f"SELECT 'stations' AS source, count(*) AS feature_count, CAST(1000 AS BIGINT) AS min_features, count(*) >= 1000 "
    f"AS passed FROM stations WHERE {_ACTIVE} UNION ALL SELECT 'depots', count(*), 1000, count(*) >= 1000 FROM depots",
    "stations", "depots"))
def q_min_features_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: per-source surviving count against min_features."""
    st = refreshed_stations(spark, sf_dir).select(F.lit("stations").alias("source"))
    dp = X.depots(spark, sf_dir).select(F.lit("depots").alias("source"))
    counts = st.unionByName(dp).groupBy("source").agg(F.count(F.lit(1)).alias("feature_count"))
    spec = spark.createDataFrame([("stations", 1000), ("depots", 1000)], "source STRING, min_features BIGINT")
    return M.min_features_gate(counts, spec)


@query("source_manifest", with_fixtures(
    "SELECT 'stations' AS source, c.content_hash, p.content_hash AS previous_content_hash, c.feature_count "
    "FROM digest c, pdigest p UNION ALL SELECT 'depots', d.content_hash, d.content_hash, d.feature_count FROM ddigest d",
    "stations", "stations_prev", "depots",
    extra=f"hs AS ({_hash_sql('stations')}),{_digest_sql('hs')}, phs AS ({_hash_sql('stations_prev')}),"
          + _digest_sql('phs', prefix='p') + f", dhs AS (SELECT sha256({_DEPOT_JSON}) AS h FROM depots),"
          + _digest_sql('dhs', prefix='d')))
def q_source_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """manifest rows with current and previous content hashes."""
    m = _two_runs(spark, sf_dir).manifest
    return m.select("source", "content_hash", "previous_content_hash", "feature_count")


@query("feature_rows_json", with_fixtures(
    f"SELECT key, rtrim({station_feature_json()}, '}}') || '}},\"type\":\"Feature\"}}' AS line FROM stations "
    f"WHERE {_ACTIVE}", "stations"))
def q_feature_rows_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: one GeoJSON Feature text per line, as written by the publisher."""
    df = apply_steps(X.stations(spark, sf_dir).withColumn("_key", F.col("key")), STATION_STEPS)
    return df.select(F.col("_key").alias("key"), PUB.feature_line(df).alias("line"))


@query("summary", with_fixtures(
    "SELECT 'stations' AS _source, feature_count, content_hash, min_lon, min_lat, max_lon, max_lat, "
    "'Point=' || CAST(feature_count AS VARCHAR) AS geometry_types, 'country,pm25,segment,station_id' AS properties "
    "FROM digest, sta UNION ALL SELECT 'depots', d.feature_count, d.content_hash, min_lon, min_lat, max_lon, max_lat, "
    "'Point=' || CAST(d.feature_count AS VARCHAR), 'capacity,country,depot_id' FROM ddigest d, dep",
    "stations", "depots",
    extra=f"hs AS ({_hash_sql('stations')}),{_digest_sql('hs')}, dhs AS (SELECT sha256({_DEPOT_JSON}) AS h FROM depots),"
          + _digest_sql('dhs', prefix='d') + f""",
    dep AS (SELECT min(lon) AS min_lon, min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat FROM depots),
    sta AS (SELECT min(round(lon, 3)) AS min_lon, min(round(lat, 3)) AS min_lat, max(round(lon, 3)) AS max_lon,
                   max(round(lat, 3)) AS max_lat FROM stations WHERE {_ACTIVE})"""))
def q_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: per-source summary (count, bbox, type histogram, property names, digest)."""
    parts = []
    for name, df in (("stations", apply_steps(X.stations(spark, sf_dir), STATION_STEPS)), ("depots", X.depots(spark, sf_dir))):
        names = F.array(*[F.lit(f.name) for f in property_fields(df)])
        parts.append(with_feature_hash(df).select(F.lit(name).alias("_source"), "geometry", "_hash", names.alias("_names")))
    return PUB.summary(parts[0].unionByName(parts[1]))


@query("merge_sources", with_fixtures(
    f"SELECT 'stations' AS source, ord, {station_feature_json(precision=None, props=('key', 'station_id', 'country', 'pm25', 'status', 'segment'))} "
    f"AS feature_json FROM stations UNION ALL SELECT 'depots', ord, {_DEPOT_JSON} FROM depots", "stations", "depots"))
def q_merge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: every source's features in one frame, duplicates kept."""
    m = PUB.merge_sources({"stations": X.stations(spark, sf_dir), "depots": X.depots(spark, sf_dir)})
    return m.select(F.col("_source").alias("source"), F.col("_ord").alias("ord"), F.col("_json").alias("feature_json"))


@query("refresh_stream", with_fixtures(
    "SELECT 'stations' AS source, 'ok' AS status, feature_count, content_hash, feature_count AS added FROM digest", "stations",
    extra="hs AS (SELECT sha256(" + station_feature_json() + f") AS h FROM stations WHERE {_ACTIVE})," + _digest_sql("hs")))
def q_refresh_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table streamed through refresh runs, from an empty state."""
    import uuid

    from featureflow.session import checkpoint_dir
    from featureflow.streaming.stream import refresh_stream

    table = X.table(spark, sf_dir, "customer")
    out = f"{checkpoint_dir(spark).rstrip('/')}/featureflow-stream/{uuid.uuid4().hex}"
    # a table is a folder of part files, or one file of its folder
    one = table.select("_metadata.file_path").first()
    single = one is None or one[0].endswith("/customer.parquet")
    path = refresh_stream(spark, sf_dir if single else f"{sf_dir}/customer.parquet", table.schema,
                          SourceSpec("stations", X.stations, tuple(STATION_STEPS), "station_id", 1),
                          lambda b: X.as_features(X.stations_from_customers(b)), out, RUN_NOW,
                          file_glob="customer.parquet" if single else None)
    return spark.read.parquet(path).select("source", "status", "feature_count", "content_hash", "added")
