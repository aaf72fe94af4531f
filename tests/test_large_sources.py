"""What a run does with sources of few files, and what its geometry expressions cost."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from featureflow.functions import geo
from featureflow.functions.canonical import variant_text
from featureflow.operators.digest import collection_digest
from featureflow.operators.transforms import Step
from featureflow.plans.refresh import SourceSpec, empty_state, hashed_features, refresh
from featureflow.session import spread, written


def _plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def _geometries(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING").select("i", F.parse_json("t").alias("geometry"))


def test_what_made_a_geometry_stands_once_in_a_filter_on_it(spark):
    """the filter is pushed below the rounding, which then stood in it at every mention of the geometry."""
    df = Step("drop_invalid", True).apply(Step("round", 3).apply(_geometries(spark, '{"type":"Point","coordinates":[1,2]}')))
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 250_000


def test_source_with_problems_is_read_once_and_dealt_out(spark, capsys):
    """One read a source, and the work on its rows behind a round robin exchange."""
    rows = spark.range(20).select(F.col("id").alias("_ord"), F.when(F.col("id") % 4 == 3, F.lit("broken")).alias("_problem"),
                                  geo.point(F.lit(1.0), F.lit(2.0)).alias("geometry"), F.col("id").alias("n"))
    plan = _plan(hashed_features(spark, [SourceSpec("a", lambda s: rows)]), capsys)
    assert plan.count("Range (") == 1 and plan.count("RoundRobinPartitioning") == 1


def test_rows_with_problems_pass_by_the_steps(spark):
    """Neither a filter, nor a raising condition, nor drop_invalid hides or touches a row that its reader could not use."""
    def load(s):
        return s.range(12).select(
            F.col("id").alias("_ord"), F.when(F.col("id") % 4 == 3, F.lit("broken")).alias("_problem"),
            F.when(F.col("id") % 4 != 2, geo.point(F.col("id").cast("double"), F.lit(2.0))).alias("geometry"),
            F.when(F.col("id") % 4 == 3, F.lit("x")).otherwise(F.col("id").cast("string")).alias("n"))

    steps = (Step("filter", "CAST(n AS INT) > 3"), Step("drop_invalid", True), Step("round", 1), Step("select", ["n"]))
    r = refresh(spark, [SourceSpec("a", load, steps), SourceSpec("b", lambda s: load(s).where("_problem IS NULL"), steps)],
                *empty_state(spark), "2024-01-31 00:00:00", dry_run=True)
    rows = {x["source"]: x for x in r.manifest.collect()}
    assert (rows["a"]["status"], rows["a"]["error"]) == ("failed", "3 record(s) could not be read: broken")
    assert (rows["b"]["status"], rows["b"]["feature_count"]) == ("ok", 4)
    for s in "ab":
        assert [(x["features_in"], x["removed"]) for x in rows[s]["steps"]] == [(9, 3), (6, 2), (4, 0), (4, 0)]


def test_spread_and_written_keep_rows(spark):
    df = spark.range(50).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 3 == 0, geo.point(F.lit(1.5), F.col("id"))).alias("geometry"))
    want = sorted((x.k, x.g or "") for x in df.select("k", F.to_json("geometry").alias("g")).collect())
    got = written(spread(df), "test").select("k", F.to_json("geometry").alias("g")).collect()
    assert sorted((x.k, x.g or "") for x in got) == want


_SQUARE = [[0, 0], [1, 0], [1, 1], [0, 0]]


@pytest.mark.parametrize("kind, coordinates, problem", [
    ("Point", [1.5, 2], None), ("Point", [1, 2, 3], None), ("Point", [1, None], "components"), ("Point", [1, 2, None], "components"),
    ("Point", [181, 2], "longitude"), ("Point", [1, -90.5], "latitude"), ("Point", [1], "2 or 3"), ("Point", [1, 2, 3, 4], "2 or 3"),
    ("Point", [[1, 2], [3, 4]], "components"), ("LineString", [[1, 2], [3, 4]], None), ("LineString", [[1, 2], None], "array"),
    ("LineString", [[1, 2], []], "2 or 3"), ("LineString", [1, 2], "array"), ("MultiLineString", [[[1, 2]], []], "empty"),
    ("Polygon", [_SQUARE], None), ("Polygon", [_SQUARE, _SQUARE[:3]], "at least 4"), ("Polygon", [_SQUARE[:3] + [[5, 5]]], "closed"),
    ("MultiPolygon", [[_SQUARE], [_SQUARE]], None), ("MultiPolygon", [[_SQUARE], []], "empty"), ("MultiPolygon", [[_SQUARE], None], "array")])
def test_plain_geometries_are_judged_part_by_part_when_not_sound(spark, kind, coordinates, problem):
    df = _geometries(spark, json.dumps({"type": kind, "coordinates": coordinates}), json.dumps({"type": kind, "coordinates": coordinates, "z": 1}))
    said = [r[0] for r in df.select(geo.geometry_problem(F.col("geometry"))).collect()]
    assert said[0] == said[1]  # a further member takes the general way
    assert said[0] is None if problem is None else problem in said[0]


def test_box_has_both_axes_and_rounding_keeps_members(spark):
    df = _geometries(spark, '{"type":"LineString","coordinates":[[1.26,2.5],[-3,7.04]]}', '{"type":"Point","coordinates":[1.26,7.04],"z":[1.26]}',
                     '{"type":"Point","coordinates":[1.26,null]}', '{"type":"Point","coordinates":[-0.01,3]}').orderBy("i")
    assert [tuple(r) for r in df.select(*geo.bbox_parts(F.col("geometry"))).collect()][:2] == [(-3.0, 2.5, 1.26, 7.04), (1.26, 7.04, 1.26, 7.04)]
    assert [r[0] for r in df.select(F.to_json(geo.round_geometry(F.col("geometry"), 1))).collect()] == [
        '{"coordinates":[[1.3,2.5],[-3,7]],"type":"LineString"}', '{"coordinates":[1.3,7],"type":"Point","z":[1.26]}',
        '{"coordinates":[1.3,null],"type":"Point"}', '{"coordinates":[0,3],"type":"Point"}']


def test_even_text_of_a_variant_is_left(spark):
    texts = ['{"a":1.5,"b":"x.0 -0 1.50"}', '{"a":[1.0,-0,1.50,-0.5,100,1e20]}', '"-0"', "10.20"]
    got = [r[0] for r in _geometries(spark, *texts).orderBy("i").select(variant_text(F.col("geometry"))).collect()]
    assert got[0] == '{"a":1.5,"b":"x.0 -0 1.50"}' and got[2] == '"-0"' and got[3] == "10.2" and got[1].startswith('{"a":[1,0,1.5,-0.5,100,')


@pytest.mark.parametrize("text", ['{"type":"Point","coordinates":%s}' % c for c in (
    "[1.26,7.04]", "[1.26,7.04,3.55]", "[1]", "[1.26,null]", "[null,2.5]", "[1,2,null]", "[]", "[1.5e10,-2.5]", '["a",2]', "[[1.26,2.5]]")]
    + ['{"type":"Point"}', '{"type":"LineString","coordinates":[1,2]}', '{"type":["Point"],"coordinates":[1,2]}'])
def test_points_take_a_short_way_to_the_same_end(spark, text):
    """Rounding and box of a plain point are those of the same point as the only member of a collection."""
    df = _geometries(spark, text, '{"type":"GeometryCollection","geometries":[%s]}' % text).orderBy("i")
    alone, inside = df.select(F.to_json(geo.round_geometry(F.col("geometry"), 1)).alias("g"), geo.bbox(F.col("geometry")).alias("b")).collect()
    assert inside.g == '{"geometries":[%s],"type":"GeometryCollection"}' % alone.g
    assert alone.b == inside.b


def test_features_are_made_after_the_rows_are_dealt_out(spark, capsys):
    """The geometry is built above the exchange, not in the tasks that read the file."""
    spec = SourceSpec("a", lambda s: s.range(20).select(F.col("id").alias("_ord"), F.col("id").cast("double").alias("x")),
                      features=lambda rows: rows.withColumn("geometry", geo.point(F.col("x"), F.lit(2.0))).drop("x"))
    plan = _plan(hashed_features(spark, [spec]), capsys)
    assert plan.count("RoundRobinPartitioning") == 1 and plan.index("to_variant_object") < plan.index("RoundRobinPartitioning")
    assert hashed_features(spark, [spec]).where("_json IS NOT NULL").count() == 20


def test_digest_deals_its_hashes_out_once(spark, capsys):
    """Equal hashes meet, then leaves and middles are built where their rows are; the digest is the one of before."""
    df = spark.range(3000).select(F.when(F.col("id") >= 0, "s").alias("_source"), F.sha2((F.col("id") % 2000).cast("string"), 256).alias("_hash"))
    digest = collection_digest(df, ["_source"])
    assert _plan(digest, capsys).count("Exchange hashpartitioning") == 3
    leaves, middles = {}, {}
    for h, n in sorted((hashlib.sha256(str(i).encode()).hexdigest(), 2 if i < 1000 else 1) for i in range(2000)):
        leaves.setdefault(h[:6], []).append(f"{h}:{n}")
    for b6, entries in sorted(leaves.items()):
        middles.setdefault(b6[:3], []).append(f"{b6}={hashlib.sha256(','.join(entries).encode()).hexdigest()}")
    body = ",".join(f"{b3}={hashlib.sha256(','.join(m).encode()).hexdigest()}" for b3, m in sorted(middles.items()))
    want = "sha256-merkle-v1:" + hashlib.sha256(f"sha256-merkle-v1|3000|{body}".encode()).hexdigest()
    assert [tuple(r) for r in digest.collect()] == [("s", 3000, want)]


@pytest.mark.parametrize("text", [
    '{"type":"Point","coordinates":[1.5,-2]}', '{"type":"Point","coordinates":[1,2,3]}', '{"type":"Point","coordinates":[1]}',
    '{"type":"Point","coordinates":["1",2]}', '{"type":"Point","coordinates":[1,2,null]}', '{"type":"Point","coordinates":[200,2]}',
    '{"type":"Point","coordinates":[1,2],"more":1}', '{"type":"LineString","coordinates":[[1,2],[3,-4]]}', "null", '{"type":"Point"}'])
def test_short_ways_of_points_agree_with_the_long_ones(spark, text):
    """Soundness and box of a plain point are told without opening it, and are those of the whole check."""
    f = _geometries(spark, text)
    g = F.col("geometry")
    feature = F.concat(F.lit('{"geometry":'), variant_text(g), F.lit(',"properties":{}}'))
    pos = geo.positions(g)
    r = f.select(geo.no_problem(g).alias("sound"), geo.geometry_problem(g).isNull().alias("whole"), geo.bbox(g).alias("box"),
                 geo.bbox(g, feature).alias("of_text"), F.array_min(F.transform(pos, lambda p: p[0])).alias("west"),
                 F.array_max(F.transform(pos, lambda p: p[1])).alias("north")).first()
    assert r["sound"] == r["whole"] and r["box"] == r["of_text"]
    assert (r["box"]["west"], r["box"]["north"]) == (r["west"], r["north"])


def test_documents_are_parsed_once(spark, capsys):
    """what is wrong with a document is told from its parsed value."""
    from featureflow.sources.geojson import parse_geojson

    docs = spark.createDataFrame([(1, '{"type":"FeatureCollection","features":[{"type":"Feature","properties":[1]}]}'), (2, "{"), (3, " "),
                                  (4, '{"type":"FeatureCollection","features":[]}'), (5, '{"type":"FeatureCollection","features":[3]}')], "_doc INT, value STRING")
    f = parse_geojson(docs)
    assert _plan(f, capsys).count("parseJson(") == 1
    got = {r["_doc"]: r["_problem"] for r in f.collect()}
    assert got == {1: "feature 0: 'properties' must be an object or null, got list", 2: "invalid JSON",
                   3: "payload is empty; expected a JSON document", 5: "feature 0 is a int, expected a GeoJSON Feature object"}


def test_own_text_of_doubles_is_the_canonical_one(spark):
    from pyspark.sql import types as T

    from featureflow.functions.canonical import number_text

    values = [0.1, 0.30000000000000004, 4516.95, -9999998.5, 1234567.125, 0.09999, 1e7 + 0.5, 12.0, -0.0, 1e-7]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    got = [r[0] for r in df.select(number_text(F.col("v"), T.DoubleType())).collect()]
    assert got == ["0.1", "0.30000000000000004", "4516.95", "-9999998.5", "1234567.125", "0.09999", "10000000.5", "12", "0", "0.0000001"]
