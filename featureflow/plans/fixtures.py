"""Fixture feature sources derived from the TPC-H-like test tables.

Each builder reads parquet and returns a DataFrame whose size grows with the
table it is derived from. Fault injection is by key modulus so that an
oracle can state the expected answer with a CASE on the same modulus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions import geo

# Fixed values of the fixture rules (shared with the SQL twins).
LON_MULT, LON_MOD = 7919, 359999
LAT_MULT, LAT_MOD = 104729, 179999
LON_SHIFT, LAT_SHIFT = 179.99969, 89.99969
REMOVED_KEY_OFFSET = 1_000_000_000_000
DOC_CHUNK = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lon_of(k: Column) -> Column:
    return ((k * LON_MULT) % LON_MOD).cast("double") / 1000 - LON_SHIFT


def lat_of(k: Column) -> Column:
    return ((k * LAT_MULT) % LAT_MOD).cast("double") / 1000 - LAT_SHIFT


def stations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stations`` as plain records (lon/lat columns, no geometry yet)."""
    return stations_from_customers(table(spark, sf_dir, "customer"))


def stations_from_customers(c: DataFrame) -> DataFrame:
    """The stations rule applied to any customer rows (a table or a stream batch)."""
    k = F.col("c_custkey")
    return c.select(
        k.alias("key"),
        F.concat(F.lit("ST-"), k.cast("string")).alias("station_id"),
        lon_of(k).alias("lon"),
        lat_of(k).alias("lat"),
        F.col("c_nationkey").alias("country"),
        F.col("c_acctbal").alias("pm25"),
        F.when(k % 11 == 0, F.lit("decommissioned")).otherwise(F.lit("active")).alias("status"),
        F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("segment"),
        (k * 2).alias("_ord"),
    )


def as_features(records: DataFrame) -> DataFrame:
    """Point features from ``lon``/``lat`` records (all other columns kept)."""
    return records.withColumn("geometry", geo.point(F.col("lon"), F.col("lat"))).drop("lon", "lat")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_features(stations_raw(spark, sf_dir))


def stations_prev_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The previous run: minus key%17=0, pm25+1 on key%13=0, plus shifted keys for key%23=0."""
    s = stations_raw(spark, sf_dir)
    k = F.col("key")
    kept = s.where(k % 17 != 0).withColumn("pm25", F.when(k % 13 == 0, F.col("pm25") + 1).otherwise(F.col("pm25")))
    gone_key = k + F.lit(REMOVED_KEY_OFFSET)
    gone = (s.where(k % 23 == 0)
            .withColumn("station_id", F.concat(F.lit("ST-"), gone_key.cast("string")))
            .withColumn("_ord", gone_key * 2)
            .withColumn("key", gone_key))
    return kept.unionByName(gone)


def stations_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_features(stations_prev_raw(spark, sf_dir))


def stations_dup_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stations_raw`` plus a later copy (pm25+5) of every key%29=0 row."""
    s = stations_raw(spark, sf_dir)
    k = F.col("key")
    dup = (s.where(k % 29 == 0).withColumn("pm25", F.col("pm25") + 5)
           .withColumn("_ord", F.col("_ord") + 1))
    return s.unionByName(dup)


def stations_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_features(stations_dup_raw(spark, sf_dir))


def depots_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second source with another schema: suppliers as depots, as plain records."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("DP-"), k.cast("string")).alias("depot_id"),
        lon_of(k).alias("lon"), lat_of(k).alias("lat"),
        F.col("s_nationkey").alias("country"),
        F.col("s_acctbal").alias("capacity"),
        (k * 2).alias("_ord"),
    )


def depots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_features(depots_raw(spark, sf_dir))


def zone_text(k: Column) -> Column:
    """Polygon GeoJSON text around an integer cell; fault chosen by ``k % 13``."""
    x = ((k * LON_MULT) % 359) - 179
    y = ((k * LAT_MULT) % 179) - 89

    def pos(a: Column, b: Column) -> Column:
        return F.concat(F.lit("["), a.cast("string"), F.lit(","), b.cast("string"), F.lit("]"))

    def ring(a: Column, b: Column, closed: bool = True, n: int = 5) -> Column:
        pts = [pos(a, b), pos(a + 1, b), pos(a + 1, b + 1), pos(a, b + 1), pos(a, b)]
        if not closed:
            pts = pts[:4]
        if n == 3:
            pts = [pos(a, b), pos(a + 1, b), pos(a, b)]
        return F.concat(F.lit("["), F.concat_ws(",", *pts), F.lit("]"))

    def poly(r: Column, kind: str = "Polygon") -> Column:
        return F.concat(F.lit('{"type":"' + kind + '","coordinates":['), r, F.lit("]}"))

    fault = k % 13
    short = F.concat(F.lit("[[" ), x.cast("string"), F.lit("],"),
                     F.concat_ws(",", pos(x + 1, y), pos(x + 1, y + 1), pos(x, y + 1), pos(x, y)), F.lit("]"))
    text_cell = F.concat(F.lit('[["a",'), y.cast("string"), F.lit("],"),
                         F.concat_ws(",", pos(x + 1, y), pos(x + 1, y + 1), pos(x, y + 1), pos(x, y)), F.lit("]"))
    return (F.when(fault == 0, poly(ring(x, y)))
            .when(fault == 1, F.lit("null"))
            .when(fault == 2, poly(ring(x, y), "Hexagon"))
            .when(fault == 3, F.lit('{"type":"Polygon"}'))
            .when(fault == 4, poly(short))
            .when(fault == 5, poly(text_cell))
            .when(fault == 6, poly(ring(F.lit(200), y)))
            .when(fault == 7, poly(ring(x, F.lit(95))))
            .when(fault == 8, F.lit('{"type":"Polygon","coordinates":[]}'))
            .when(fault == 9, poly(ring(x, y, n=3)))
            .when(fault == 10, poly(ring(x, y, closed=False)))
            .when(fault == 11, F.lit('{"type":"GeometryCollection","geometries":[]}'))
            .otherwise(F.lit("[1,2]")))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone polygon per customer, as GeoJSON text in ``shape``."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("key"),
        F.concat(F.lit("Z-"), k.cast("string")).alias("zone_id"),
        F.col("c_mktsegment").alias("segment"),
        zone_text(k).alias("shape"),
        (k * 2).alias("_ord"),
    )


def zone_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = zones(spark, sf_dir)
    return z.withColumn("geometry", F.try_parse_json("shape")).drop("shape")


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LineString per ``(user_id, event_id div 50)``: the user's events in id order.

    Chunking by event id bounds every group to 50 positions, so a hot user
    does not turn into one huge row.
    """
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    pts = e.select("user_id", (k / DOC_CHUNK).cast("long").alias("chunk"), k.alias("event_id"),
                   F.array(lon_of(k), lat_of(k)).alias("p"))
    grouped = pts.groupBy("user_id", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "p"))).alias("pts"),
        F.min("event_id").alias("first_event"))
    line = F.to_variant_object(F.struct(
        F.transform(F.col("pts"), lambda s: s["p"]).alias("coordinates"), F.lit("LineString").alias("type")))
    return grouped.select(
        F.concat_ws("-", F.lit("T"), F.col("user_id").cast("string"), F.col("chunk").cast("string")).alias("track_id"),
        "user_id", F.size("pts").alias("n_points"), line.alias("geometry"), F.col("first_event").alias("_ord"))


def _event_cols(e: DataFrame) -> DataFrame:
    k = F.col("event_id")
    return e.select("event_id", "event_type", "value", "user_id", "ts",
                    F.get_json_object("props", "$.k").cast("int").alias("k"),
                    lon_of(k).alias("lon"), lat_of(k).alias("lat"),
                    (k / DOC_CHUNK).cast("long").alias("chunk"))


def _feature_struct() -> Column:
    return F.struct(
        F.col("event_id").alias("_sort"),
        F.lit("Feature").alias("type"),
        F.col("event_id").alias("id"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias("geometry"),
        F.struct("event_type", "k", "value").alias("properties"),
    )


def _drop_sort(arr: Column) -> Column:
    return F.transform(arr, lambda s: s.dropFields("_sort"))


def geojson_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FeatureCollection documents of 50 consecutive events each: ``(_doc, value)``."""
    ev = _event_cols(table(spark, sf_dir, "events"))
    grouped = ev.groupBy("chunk").agg(F.array_sort(F.collect_list(_feature_struct())).alias("fs"))
    doc = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), _drop_sort(F.col("fs")).alias("features")))
    return grouped.select(F.col("chunk").alias("_doc"), doc.alias("value"))


def shape_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per event, shaped by ``event_id % 4``: collection, array, bare Feature, bare geometry."""
    ev = _event_cols(table(spark, sf_dir, "events"))
    feat = _feature_struct().dropFields("_sort")
    shape = F.col("event_id") % 4
    geom = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    text = (F.when(shape == 0, F.to_json(F.struct(F.lit("FeatureCollection").alias("type"),
                                                  F.array(feat).alias("features"))))
            .when(shape == 1, F.to_json(F.array(feat)))
            .when(shape == 2, F.to_json(feat))
            .otherwise(F.to_json(geom)))
    return ev.select(F.col("event_id").alias("_doc"), text.alias("value"))


def problem_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per event with a fault chosen by ``event_id % 10`` (0 is sound)."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    good = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(F.struct(
        F.lit("Feature").alias("type"), k.alias("id"),
        F.struct(F.lit("Point").alias("type"), F.array(lon_of(k), lat_of(k)).alias("coordinates")).alias("geometry"),
        F.struct("event_type").alias("properties"))).alias("features")))
    fault = k % 10
    text = (F.when(fault == 0, good).when(fault == 1, F.lit("  "))
            .when(fault == 2, F.concat(F.lit('{"type": "FeatureCollection", "features": ['), F.col("props")))
            .when(fault == 3, F.lit("[1, 2]"))
            .when(fault == 4, F.lit('{"type": "Topology"}'))
            .when(fault == 5, F.lit('{"type": "FeatureCollection"}'))
            .when(fault == 6, F.lit('{"type": "FeatureCollection", "features": {}}'))
            .when(fault == 7, F.concat(F.lit('"'), F.col("event_type"), F.lit('"')))
            .when(fault == 8, F.lit('{"type": "FeatureCollection", "features": [{"type": "Point"}]}'))
            .otherwise(F.lit('[{"type": "Feature", "properties": [1]}]')))
    return e.select(k.alias("_doc"), text.alias("value"))


def json_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``{"data": {"items": [...], "byid": {...}}, "odd.key": chunk}`` per 50 events."""
    ev = _event_cols(table(spark, sf_dir, "events"))
    item = F.struct(F.col("event_id").alias("id"), "k", "lon", "lat", F.col("event_type").alias("type"))
    grouped = ev.groupBy("chunk").agg(
        F.array_sort(F.collect_list(item)).alias("items"),
        F.map_from_entries(F.collect_list(F.struct(F.col("event_id").cast("string"), F.col("k")))).alias("byid"))
    doc = F.to_json(F.struct(F.struct("items", "byid").alias("data"), F.col("chunk").alias("odd.key")))
    return grouped.select(F.col("chunk").alias("_doc"), doc.alias("value"))


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses: one per event, status by ``event_id % 10``."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    status = (F.when(k % 10 == 6, 404).when(k % 10 == 7, 429).when(k % 10 == 8, 500)
              .when(k % 10 == 9, 503).otherwise(200))
    url = F.when(k % 3 == 0, F.concat(F.lit("https://user:pw"), F.col("user_id").cast("string"),
                                      F.lit("@api.example.com/"), F.col("event_type")))
    url = url.otherwise(F.concat(F.lit("https://api.example.com/"), F.col("event_type")))
    return e.select(F.col("event_type").alias("source"), k.alias("event_id"), url.alias("url"),
                    status.alias("status"), F.col("ts").alias("fetched_at"),
                    F.concat(F.lit('W/"'), k.cast("string"), F.lit('"')).alias("etag"),
                    (F.lit(1) + k % 4).alias("attempts"), F.length("props").cast("long").alias("bytes_read"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV cell texts by ``o_orderkey % 12``."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    m = k % 12
    text = (F.when(m == 0, F.lpad(k.cast("string"), 8, "0"))
            .when(m == 1, F.format_string("%.2f", F.col("o_totalprice")))
            .when(m == 2, F.lit(" 5 ")).when(m == 3, F.lit("true")).when(m == 4, F.lit("FALSE"))
            .when(m == 5, F.lit("null")).when(m == 6, F.lit("")).when(m == 7, F.lit("+44"))
            .when(m == 8, F.lit("1e5")).when(m == 9, F.lit("-0")).when(m == 10, k.cast("string"))
            .otherwise(F.concat(F.lit(" "), F.col("o_orderpriority"))))
    return o.select(k.alias("key"), text.alias("cell"))


def station_csv_lines(spark: SparkSession, sf_dir: str, sep: str = ";", ragged: bool = False) -> DataFrame:
    """``stations`` as CSV data lines ``(key, value)``; ragged rows by ``key % 7`` when asked."""
    s = stations_raw(spark, sf_dir)
    k = F.col("key")
    pm = F.format_string("%.2f", F.col("pm25"))
    base = [F.col("station_id"), F.col("country").cast("string"), F.col("lon").cast("string"),
            F.col("lat").cast("string")]
    line = F.concat_ws(sep, *base, pm)
    if ragged:
        line = (F.when(k % 7 == 0, F.concat_ws(sep, *base, pm, F.lit("extra")))
                .when(k % 7 == 1, F.concat_ws(sep, *base)).otherwise(line))
    return s.select("key", line.alias("value"))


# Fixed values of the runs fixture: the clock and the max_age per source (seconds).
RUNS_NOW = "2024-01-31 00:00:00"
RUNS_MAX_AGE = {"click": 86400.0, "view": 172800.0, "purchase": 21600.0, "signup": 43200.0}


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per ``(source = event_type, run_ts = day)``; days with ``day % 7 = 0`` fail."""
    e = table(spark, sf_dir, "events")
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    g = e.groupBy(F.col("event_type").alias("source"), day.alias("run_ts")).agg(
        F.max(F.col("ts").cast("timestamp")).alias("last_ts"), F.count(F.lit(1)).alias("n"))
    ok = F.dayofmonth("run_ts") % 7 != 0
    max_age = F.create_map(*[x for k, v in RUNS_MAX_AGE.items() for x in (F.lit(k), F.lit(v))])[F.col("source")]
    return g.select(
        "source", "run_ts", ok.alias("ok"),
        F.when(ok, F.col("last_ts")).alias("fetched_at"),
        F.when(ok, F.sha2((F.col("n") / 10).cast("long").cast("string"), 256)).alias("content_hash"),
        F.when(ok, F.col("n")).alias("feature_count"),
        max_age.alias("max_age"),
        F.lit(RUNS_NOW).cast("timestamp").alias("now"),
    )


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duration texts by ``p_partkey % 7``: s, m, h, d, w, bare fraction, invalid unit."""
    p = table(spark, sf_dir, "part")
    m = F.col("p_partkey") % 7
    n = F.col("p_size").cast("string")
    text = (F.when(m == 0, F.concat(n, F.lit("s"))).when(m == 1, F.concat(F.lit(" "), n, F.lit("m ")))
            .when(m == 2, F.concat(n, F.lit("H"))).when(m == 3, F.concat(n, F.lit("d")))
            .when(m == 4, F.concat(n, F.lit(" w"))).when(m == 5, F.concat(n, F.lit(".5")))
            .otherwise(F.concat(n, F.lit("x"))))
    return p.select(F.col("p_partkey").alias("key"), text.alias("text"))
