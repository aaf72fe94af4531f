"""DuckDB twins of the fixture views, for the oracle SQL of each query.

These strings restate the fixture rules of ``fixtures.py`` in plain SQL over
the same parquet tables (pre-registered as views by the checker).
"""

from __future__ import annotations

FIXTURE_SQL = {
    "stations": """
        SELECT c_custkey AS key, 'ST-' || CAST(c_custkey AS VARCHAR) AS station_id,
               CAST((c_custkey * 7919) % 359999 AS DOUBLE) / 1000 - 179.99969 AS lon,
               CAST((c_custkey * 104729) % 179999 AS DOUBLE) / 1000 - 89.99969 AS lat,
               c_nationkey AS country, c_acctbal AS pm25,
               CASE WHEN c_custkey % 11 = 0 THEN 'decommissioned' ELSE 'active' END AS status,
               CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_mktsegment END AS segment,
               c_custkey * 2 AS ord
        FROM customer""",
    "stations_prev": """
        SELECT key, station_id, lon, lat, country,
               CASE WHEN key % 13 = 0 THEN pm25 + 1 ELSE pm25 END AS pm25, status, segment, ord
        FROM stations WHERE key % 17 <> 0
        UNION ALL
        SELECT key + 1000000000000, 'ST-' || CAST(key + 1000000000000 AS VARCHAR), lon, lat, country,
               pm25, status, segment, (key + 1000000000000) * 2
        FROM stations WHERE key % 23 = 0""",
    "stations_dup": """
        SELECT * FROM stations
        UNION ALL
        SELECT key, station_id, lon, lat, country, pm25 + 5, status, segment, ord + 1
        FROM stations WHERE key % 29 = 0""",
    "depots": """
        SELECT 'DP-' || CAST(s_suppkey AS VARCHAR) AS depot_id,
               CAST((s_suppkey * 7919) % 359999 AS DOUBLE) / 1000 - 179.99969 AS lon,
               CAST((s_suppkey * 104729) % 179999 AS DOUBLE) / 1000 - 89.99969 AS lat,
               s_nationkey AS country, s_acctbal AS capacity, s_suppkey * 2 AS ord
        FROM supplier""",
    "zones": """
        SELECT c_custkey AS key, 'Z-' || CAST(c_custkey AS VARCHAR) AS zone_id, c_mktsegment AS segment,
               c_custkey % 13 AS fault,
               (c_custkey * 7919) % 359 - 179 AS x, (c_custkey * 104729) % 179 - 89 AS y,
               c_custkey * 2 AS ord
        FROM customer""",
    "tracks": """
        SELECT user_id, CAST(floor(event_id / 50) AS BIGINT) AS chunk, event_id,
               CAST((event_id * 7919) % 359999 AS DOUBLE) / 1000 - 179.99969 AS lon,
               CAST((event_id * 104729) % 179999 AS DOUBLE) / 1000 - 89.99969 AS lat
        FROM events""",
}

# Which fixtures each fixture reads (so WITH clauses come out in order).
_DEPENDS = {"stations_prev": ["stations"], "stations_dup": ["stations"]}


def num(x: str) -> str:
    """Canonical number text of a DOUBLE expression (matches canonical.number_text)."""
    return (f"CASE WHEN ({x}) = floor({x}) AND abs({x}) < 9007199254740992 "
            f"THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END")


def jstr(x: str) -> str:
    """JSON string literal of a VARCHAR expression, ``null`` when NULL."""
    return f"coalesce(CAST(to_json({x}) AS VARCHAR), 'null')"


def with_fixtures(body: str, *names: str, extra: str = "") -> str:
    """``WITH <fixture CTEs>[, extra CTEs] body``."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [f"{n} AS ({FIXTURE_SQL[n]})" for n in order]
    if extra.strip():
        ctes.append(extra.strip())
    return "WITH " + ",\n".join(ctes) + "\n" + body if ctes else body


def station_feature_json(prefix: str = "", precision: int | None = 3,
                         props: tuple[str, ...] = ("country", "pm25", "segment", "station_id"),
                         rename: dict[str, str] | None = None) -> str:
    """Canonical feature JSON of a stations row after select(props) and round(precision)."""
    p = prefix
    render = {
        "country": f"CAST({p}country AS VARCHAR)",
        "pm25": num(f"{p}pm25"),
        "segment": jstr(f"{p}segment"),
        "station_id": jstr(f"{p}station_id"),
        "status": jstr(f"{p}status"),
        "key": f"CAST({p}key AS VARCHAR)",
    }
    rename = rename or {}
    out = {rename.get(n, n): render[n] for n in props}
    members = " || ',' || ".join(f"'\"{name}\":' || {out[name]}" for name in sorted(out))
    lon = num(f"round({p}lon, {precision})" if precision is not None else f"{p}lon")
    lat = num(f"round({p}lat, {precision})" if precision is not None else f"{p}lat")
    return (f"'{{\"geometry\":{{\"coordinates\":[' || {lon} || ',' || {lat} || '],\"type\":\"Point\"}},"
            f"\"properties\":{{' || {members} || '}}}}'")


# The expected G1 message for each zones fault (k % 13).
ZONE_PROBLEM_SQL = """CASE fault
  WHEN 0 THEN NULL
  WHEN 1 THEN 'geometry is null'
  WHEN 2 THEN 'unknown geometry type ''Hexagon''; expected one of GeometryCollection, LineString, MultiLineString, MultiPoint, MultiPolygon, Point, Polygon'
  WHEN 3 THEN 'Polygon geometry has no ''coordinates'''
  WHEN 4 THEN 'Polygon: position must have 2 or 3 numbers, got 1'
  WHEN 5 THEN 'Polygon: position components must be numbers'
  WHEN 6 THEN 'Polygon: longitude 200.0 is outside [-180, 180]'
  WHEN 7 THEN 'Polygon: latitude 95.0 is outside [-90, 90]'
  WHEN 8 THEN 'Polygon: coordinate array must not be empty'
  WHEN 9 THEN 'Polygon: a linear ring needs at least 4 positions, got 3'
  WHEN 10 THEN 'Polygon: linear ring is not closed (first position != last)'
  WHEN 11 THEN 'GeometryCollection needs a non-empty ''geometries'' array'
  ELSE 'geometry must be an object, got list' END"""

ZONE_TYPE_SQL = """CASE WHEN fault IN (1, 12) THEN 'null' WHEN fault = 2 THEN 'Hexagon'
  WHEN fault = 11 THEN 'GeometryCollection' ELSE 'Polygon' END"""

FIXTURE_SQL["ev"] = """
    SELECT event_id, event_type, value, user_id, ts, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
           CAST((event_id * 7919) % 359999 AS DOUBLE) / 1000 - 179.99969 AS lon,
           CAST((event_id * 104729) % 179999 AS DOUBLE) / 1000 - 89.99969 AS lat,
           CAST(floor(event_id / 50) AS BIGINT) AS chunk, props
    FROM events"""

FIXTURE_SQL["landing"] = """
    SELECT event_type AS source, event_id,
           CASE WHEN event_id % 3 = 0 THEN 'https://user:pw' || CAST(user_id AS VARCHAR) || '@api.example.com/' || event_type
                ELSE 'https://api.example.com/' || event_type END AS url,
           CASE event_id % 10 WHEN 6 THEN 404 WHEN 7 THEN 429 WHEN 8 THEN 500 WHEN 9 THEN 503 ELSE 200 END AS status,
           ts AS fetched_at, 'W/"' || CAST(event_id AS VARCHAR) || '"' AS etag, 1 + event_id % 4 AS attempts,
           CAST(length(props) AS BIGINT) AS bytes_read
    FROM events"""

# Expected problem per problem_docs fault (event_id % 10).
DOC_PROBLEM_SQL = """CASE event_id % 10
  WHEN 0 THEN NULL
  WHEN 1 THEN 'payload is empty; expected a JSON document'
  WHEN 2 THEN 'invalid JSON'
  WHEN 3 THEN 'feature 0 is a int, expected a GeoJSON Feature object'
  WHEN 4 THEN 'unrecognised GeoJSON: top-level ''type'' is ''Topology''. Expected ''FeatureCollection'', ''Feature'' or a geometry object.'
  WHEN 5 THEN 'FeatureCollection has no ''features'' member'
  WHEN 6 THEN 'FeatureCollection ''features'' must be an array, got dict'
  WHEN 7 THEN 'expected a GeoJSON object, got str'
  WHEN 8 THEN 'feature 0 has type ''Point'', expected ''Feature'''
  ELSE 'feature 0: ''properties'' must be an object or null, got list' END"""

FIXTURE_SQL["runs"] = """
    SELECT source, run_ts, ok, CASE WHEN ok THEN last_ts END AS fetched_at,
           CASE WHEN ok THEN sha256(CAST(CAST(trunc(n / 10) AS BIGINT) AS VARCHAR)) END AS content_hash,
           CASE WHEN ok THEN n END AS feature_count,
           CASE source WHEN 'click' THEN 86400.0 WHEN 'view' THEN 172800.0 WHEN 'purchase' THEN 21600.0
                       WHEN 'signup' THEN 43200.0 END::DOUBLE AS max_age,
           TIMESTAMP '2024-01-31 00:00:00' AS now
    FROM (SELECT event_type AS source, date_trunc('day', ts) AS run_ts, max(ts) AS last_ts, count(*) AS n,
                 day(date_trunc('day', ts)) % 7 <> 0 AS ok FROM events GROUP BY 1, 2)"""


def humanize_sql(s: str) -> str:
    """SQL twin of freshness.humanize_age for a DOUBLE seconds expression."""
    units = [(86400 * 365, "year"), (86400 * 30, "month"), (86400 * 7, "week"), (86400, "day"), (3600, "hour"),
             (60, "minute")]
    parts = [f"WHEN {s} < 0 THEN 'in the future'", f"WHEN {s} < 45 THEN 'just now'"]
    for size, name in units:
        n = f"CAST(floor({s} / {size}) AS BIGINT)"
        parts.append(f"WHEN {s} >= {size} THEN CAST({n} AS VARCHAR) || ' {name}' || "
                     f"CASE WHEN {n} <> 1 THEN 's' ELSE '' END || ' ago'")
    return "CASE " + " ".join(parts) + f" ELSE CAST(CAST(floor({s}) AS BIGINT) AS VARCHAR) || ' seconds ago' END"
