import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions import freshness as FR
from featureflow.functions import geo
from featureflow.functions import predicates as P

# Cases follow from the rules: every simple type at its depth, each fault put at the end of an otherwise sound shape.
RING = [[-12, 7], [5, 7], [5, 21], [-12, 7]]
SOUND = {"Point": [-180, 90], "MultiPoint": [[180, -90], [0.5, 0.25, 9]], "LineString": [[3, 4], [5, 6]],
         "MultiLineString": [[[3, 4], [5, 6]], [[7, 8], [9, 1]]], "Polygon": [RING], "MultiPolygon": [[RING], [RING, RING]]}
POSITION_FAULTS = [
    ([], "position must have 2 or 3 numbers, got 0"), ([8], "position must have 2 or 3 numbers, got 1"),
    ([8, 8, 8, 8], "position must have 2 or 3 numbers, got 4"), ([8, None], "position components must be numbers"),
    ([False, 8], "position components must be numbers"), (["8", "8"], "position components must be numbers"),
    ([-180.5, 8], "longitude -180.5 is outside [-180, 180]"), ([8, 90.25], "latitude 90.25 is outside [-90, 90]"),
    ({"x": 1}, "position must be an array, got dict"), ("8,8", "position must be an array, got str"),
]


def geometry_cases():
    for kind, coords in SOUND.items():
        yield {"type": kind, "coordinates": coords}, None
        yield {"type": kind}, f"{kind} geometry has no 'coordinates'"
        if kind != "Point":
            yield {"type": kind, "coordinates": []}, f"{kind}: coordinate array must not be empty"
        for fault, text in POSITION_FAULTS:
            bad = json.loads(json.dumps(coords))
            holder = bad
            for _ in range(geo.COORD_DEPTH[kind] - 1):
                holder = holder[-1]
            if kind == "Point":
                bad = fault
            else:
                holder[-1] = fault
            yield {"type": kind, "coordinates": bad}, f"{kind}: {text}"
    yield {"type": "Polygon", "coordinates": [RING, RING[:3]]}, "Polygon: a linear ring needs at least 4 positions, got 3"
    yield {"type": "MultiPolygon", "coordinates": [[RING], [RING[:3] + [[5, 7]]]]}, \
        "MultiPolygon: linear ring is not closed (first position != last)"
    yield None, "geometry is null"
    yield 17, "geometry must be an object, got int"
    yield {"type": None, "coordinates": [1, 2]}, "unknown geometry type None; expected one of " + ", ".join(geo.GEOMETRY_TYPES)
    yield {"type": "Sphere"}, "unknown geometry type 'Sphere'; expected one of " + ", ".join(geo.GEOMETRY_TYPES)


def nested(geometry, levels):
    for i in range(levels):
        others = [{"type": kind, "coordinates": c} for kind, c in list(SOUND.items())[:i % 3]]
        geometry = {"type": "GeometryCollection", "geometries": [*others, geometry]}
    return geometry


def test_geometry_problems(spark):
    cases = list(geometry_cases())
    member = "GeometryCollection member: "
    cases += [(nested(g, levels), p and member * levels + p) for levels in (1, 2, 3, 5, 9) for g, p in cases[::7]]
    empty = "GeometryCollection needs a non-empty 'geometries' array"
    cases += [(nested({"type": "GeometryCollection", "geometries": []}, k), member * k + empty) for k in (0, 1, 4)]
    cases += [({"type": "GeometryCollection"}, empty), ({"type": "GeometryCollection", "geometries": 5}, empty)]
    df = spark.createDataFrame([(i, json.dumps(g)) for i, (g, _) in enumerate(cases)], "i INT, t STRING")
    got = dict(df.select("i", geo.geometry_problem(F.parse_json("t")).alias("p")).collect())
    for i, (g, expected) in enumerate(cases):
        assert got[i] == expected, g


def test_deep_collections_are_measured_and_rounded(spark):
    rows = [(k, json.dumps(nested({"type": "LineString", "coordinates": [[1.26, 2], [3.04, 4, 5.55]]}, k))) for k in (0, 1, 2, 3, 6, 12)]
    df = spark.createDataFrame(rows, "k INT, t STRING").select("k", "t", F.parse_json("t").alias("g"))
    boxes = geo.bbox_parts(F.col("g"))
    for r in df.select("k", "t", F.to_json(geo.round_geometry(F.col("g"), 1)).alias("r"), geo.positions(F.col("g")).alias("p"), boxes[2].alias("e")).collect():
        want = json.loads(r["t"].replace("1.26", "1.3").replace("3.04", "3").replace("5.55", "5.6"))
        for i in range(r["k"]):  # the other members hold 0.5 and 0.25
            assert len(json.loads(r["r"])["geometries"]) == len(want["geometries"])
        flat = json.dumps(want, sort_keys=True).replace("0.25", "0.2").replace(".0", "")
        assert json.dumps(json.loads(r["r"]), sort_keys=True).replace(".0", "") == flat
        assert [1.26, 2.0] in [list(p) for p in r["p"]] and r["e"] >= 3.04


def test_only_numbers_are_rounded_or_counted(spark):
    df = spark.createDataFrame([('{"type":"LineString","coordinates":[["7.77",1],[2.22,3.33],[true,4.44]]}',)], "t STRING")
    g = F.parse_json("t")
    r = df.select(F.to_json(geo.round_geometry(g, 1)).alias("r"), geo.positions(g).alias("p")).first()
    assert json.loads(r["r"])["coordinates"] == [["7.77", 1], [2.2, 3.3], [True, 4.4]]
    assert [list(p) for p in r["p"]] == [[2.22, 3.33]]


def test_round_and_positions(spark):
    doc = '{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[1.23456,-0.00001]},' \
          '{"type":"LineString","coordinates":[[2.5,3.5,100.04],[4.0,5.0]]}],"bbox":[1,2,3,4]}'
    df = spark.createDataFrame([(doc,)], "t STRING").select(F.parse_json("t").alias("g"))
    r = df.select(F.to_json(geo.round_geometry(F.col("g"), 1)).alias("j"),
                  geo.positions(F.col("g")).alias("p")).first()
    out = json.loads(r["j"])
    assert out["geometries"][0]["coordinates"] == [1.2, 0]
    assert out["geometries"][1]["coordinates"] == [[2.5, 3.5, 100], [4, 5]]
    assert out["bbox"] == [1, 2, 3, 4]  # other members untouched
    assert sorted(map(tuple, r["p"])) == [(1.23456, -1e-05), (2.5, 3.5), (4.0, 5.0)]


def test_null_rules(spark):
    df = spark.createDataFrame([(None,), ("x",), ("",)], "s STRING")
    rows = df.select(P.ne(F.col("s"), "x").alias("ne"), P.gt(F.col("s"), "a").alias("gt"),
                     (~P.gt(F.col("s"), "a")).alias("not_gt"), P.not_in(F.col("s"), ["x"]).alias("nin"),
                     P.truthy(F.col("s"), T.StringType()).alias("t"), P.length(F.col("s"), T.StringType()).alias("n"),
                     P.to_str(F.col("s")).alias("str")).collect()
    assert [tuple(r) for r in rows] == [(True, False, True, True, False, 0, ""), (False, True, False, False, True, 1, "x"),
                                        (True, False, True, True, False, 0, "")]


def test_python_style_floordiv_and_mod(spark):
    df = spark.createDataFrame([(7, -3), (-7, 3), (7, 3)], "a BIGINT, b BIGINT")
    got = [tuple(r) for r in df.select(P.floordiv(F.col("a"), F.col("b")), P.mod(F.col("a"), F.col("b"))).collect()]
    assert got == [(7 // -3, 7 % -3), (-7 // 3, -7 % 3), (7 // 3, 7 % 3)]


def test_floordiv_and_mod_stay_whole(spark):
    big = 2 ** 53 + 1
    rows = [(big, 1), (-big, 2), (2 ** 63 - 1, 2), (-(2 ** 63), 3), (2 ** 63 - 1, -(2 ** 62)), (5, 5), (-6, 3)]
    df = spark.createDataFrame(rows, "a BIGINT, b BIGINT")
    got = [tuple(r) for r in df.select(P.floordiv(F.col("a"), F.col("b")), P.mod(F.col("a"), F.col("b"))).collect()]
    assert got == [(a // b, a % b) for a, b in rows]


def test_other_kinds_pass_through_text_functions(spark):
    df = spark.createDataFrame([(5, True, "Ab"), (None, None, None)], "n INT, b BOOLEAN, s STRING")
    r = df.select(P.lower(F.col("n"), T.IntegerType()).alias("n"), P.upper(F.col("s")).alias("s"),
                  P.to_str(F.col("b"), T.BooleanType()).alias("b")).collect()
    assert [tuple(x) for x in r] == [(5, "AB", "True"), (None, None, "")]


def test_kinds_that_do_not_compare_raise(spark):
    df = spark.createDataFrame([("x", 1)], "s STRING, n INT")
    with pytest.raises(Exception):
        df.where(P.gt(F.col("s"), F.col("n"))).collect()  # P13: text that is no number against a number


def test_missing_names_are_listed(spark):
    df = spark.createDataFrame([(1, 2)], "a INT, _score INT")
    assert P.missing_names(df, ["a", "zeta", "b", "_score"]) == ["b", "zeta"]
    assert df.select(P.prop(df, "_score"), P.prop(df, "b").cast("int").alias("b")).first()[:] == (2, None)


def test_division_by_zero_raises(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a DOUBLE, b DOUBLE")
    with pytest.raises(Exception):
        df.select(P.div(F.col("a"), F.col("b"))).collect()


HUMANIZE = [(-1, "in the future"), (0, "just now"), (44, "just now"), (45, "45 seconds ago"), (60, "1 minute ago"),
            (119, "1 minute ago"), (3600, "1 hour ago"), (7200, "2 hours ago"), (86400, "1 day ago"),
            (86400 * 14, "2 weeks ago"), (86400 * 400, "1 year ago")]


def test_humanize_table(spark):
    df = spark.createDataFrame([(float(s),) for s, _ in HUMANIZE], "s DOUBLE")
    got = [r[0] for r in df.select(FR.humanize_age(F.col("s"))).collect()]
    assert got == [t for _, t in HUMANIZE]


UNIT = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}
DURATIONS = [(f"{n}{u}", float(n) * size) for u, size in UNIT.items() for n in ("0", "4", "11", "2.25")]
DURATIONS += [("44", 44.0), ("  3 D", 259200.0), ("3q", None), ("-4m", None), ("", None), ("h", None)]


def test_durations(spark):
    df = spark.createDataFrame([(t,) for t, _ in DURATIONS], "t STRING")
    assert [r[0] for r in df.select(FR.parse_duration(F.col("t"))).collect()] == [s for _, s in DURATIONS]


def test_stale_rules(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 10.0), (None, 10.0), ("2024-01-01 00:00:00", None),
                                ("2024-01-01 00:00:05", 10.0)], "f STRING, m DOUBLE")
    now = F.lit("2024-01-01 00:00:15").cast("timestamp")
    got = [r[0] for r in df.select(FR.is_stale(F.col("f").cast("timestamp"), F.col("m"), now)).collect()]
    assert got == [True, True, False, False]
