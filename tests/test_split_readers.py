"""Files split over tasks against the same files read whole."""

import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from featureflow.sources import csv as CSV
from featureflow.sources import csv_split as CS
from featureflow.sources import geojson as GJ
from featureflow.sources import geojson_split as GS


@pytest.fixture(params=[1 << 27, 400])
def ranges(spark, request):
    """Bytes a task reads at most."""
    names = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def staged(tmp_path, texts):
    folder = tmp_path / uuid.uuid4().hex
    folder.mkdir()
    for name, text in texts.items():
        (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


def rows(frame):
    """Name of the file, place among its features, and the feature."""
    r = frame.select(F.coalesce(F.try_url_decode(F.regexp_replace(F.regexp_extract("_doc", "[^/]*$", 0), "[+]", "%2B")), "_doc").alias("doc"), F.col("_ord"), F.to_json("geometry").alias("g"),
                     F.to_json("_props").alias("p"), F.to_json("_id").alias("i"),
                     F.regexp_replace("_problem", "feature [0-9]+", "feature").alias("why")).collect()
    out = {}
    for x in sorted(r, key=lambda x: (x["doc"], x["_ord"])):
        out.setdefault(x["doc"], []).append((x["g"], x["p"], x["i"], x["why"]))
    return out


def feature(rng, n):
    odd = ['plain', 'a "quoted" }{][, text', '\\', '\\"', '"features":[', 'é 漢😀', '}' * 40, '', '\n']
    props = {"name": rng.choice(odd), "features": [1, {"features": [2]}], "n": n, rng.choice(odd[:3]): [[], {}, [{"x": "]"}]]}
    if rng.random() < 0.1:
        props["long"] = rng.choice(odd) * rng.randrange(1, 60)
    return {"type": "Feature", "id": n, "geometry": {"type": "Point", "coordinates": [n, rng.random()]}, "properties": props}


def documents():
    rng = random.Random(7)
    out = {}
    for i in range(4):
        fs = [feature(rng, n) for n in range(rng.choice([0, 1, 2, 12]))]
        doc = {"type": "FeatureCollection", "meta": {"features": [[1], {"a": "}"}], "t": '"features":['}, "features": fs,
               "after": {"features": [{"type": "Feature"}], "deep": [[{"x": [1, 2]}]]}}
        if i % 2:
            doc = dict(reversed(doc.items()))
        text = json.dumps(doc, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        out[f"doc{i}.json"] = rng.choice(["", "\n", "  \n"]) + text + rng.choice(["", "\n", "\n\n "])
    out["mark.json"] = b"\xef\xbb\xbf" + b'{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"a":"}"},"geometry":null}]}'
    out["mark_blank.json"] = out["mark.json"] + b"\n"
    out["one.json"] = json.dumps(feature(rng, 1))
    out["point.json"] = '{"type":"Point","coordinates":[1,2]}'
    out["array.json"] = json.dumps([feature(rng, n) for n in range(5)])
    out["none.json"] = '{"type":"FeatureCollection","features":[ \n ]}'
    out["null.json"] = '{"type":"FeatureCollection","features":null}'
    out["map.json"] = '{"type":"FeatureCollection","features":{"features":[1]}}'
    out["other.json"] = '{"type":"Thing","x":[{"y":"}"}]}'
    out["items.json"] = '{"type":"FeatureCollection","features":[1,null,"a,b",[2,3],{"type":"Point"},{"type":"Feature","properties":3}]}'
    out["escaped.json"] = '{"type":"FeatureCollection","feat\\u0075res":[{"type":"Feature","properties":{"a":1}}]}'
    out["empty.json"] = ""
    out["a b+%20é.json"] = out["items.json"]
    out["blank.json"] = " \n "
    return out


def test_geojson_split_reads_what_whole_files_hold(spark, tmp_path, ranges):
    path = staged(tmp_path, documents())
    split = GS.read_geojson_split(spark, path)
    got, want = rows(split), rows(GJ.read_geojson(spark, path))
    for name in documents():
        assert got.get(name) == want.get(name), name
    assert [x[3] for x in got["empty.json"]] == ["payload is empty; expected a JSON document"]
    for name in ("mark.json", "mark_blank.json"):
        assert got[name] == [("null", '{"a":"}"}', None, None)]
    if ranges < 1000:
        assert GS.S.tokens(spark, path, "}").rdd.getNumPartitions() > len(documents())


UNREADABLE = [
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"a":1}}',
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"a":1',
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"a":1}}]',
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"a":1}},]}',
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"a":1}} {"type":"Feature"}]}',
    '{"type":"FeatureCollection","features":[,{"type":"Feature","properties":{"a":1}}]}',
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"a":1]}]}',
    '{"type":"FeatureCollection","features":[{"type":"Feature"}],"features":[{"type":"Feature"}]}',
    '{"type":"Feature","features":[{"type":"Feature"}]}',
    '}}}', '"', '{"a":"}',
]


def test_geojson_split_never_hides_what_is_unreadable(spark, tmp_path):
    texts = {f"{i}{kind}.json": text + tail for i, text in enumerate(UNREADABLE) for kind, tail in (("a", ""), ("b", "\n"))}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    try:
        found = rows(GS.read_geojson_split(spark, staged(tmp_path, texts)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [n for n in texts if not any(x[3] for x in found.get(n, []))] == []


def test_compressed_files_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="compressed"):
        GS.read_geojson_split(spark, staged(tmp_path, {"x.json.gz": b""}))


def csv_rows(frame):
    out = {}
    for x in sorted(frame.withColumn("_doc", F.regexp_extract("_doc", "[^/]*$", 0)).collect(), key=lambda x: (x["_doc"], x["_ord"])):
        out.setdefault(x["_doc"], []).append(tuple(v for k, v in x.asDict().items() if k not in ("_doc", "_ord")))
    return out


def csv_files(rng):
    cells = ["", "plain", 'say "hi"', "a,b", "two\nlines", '"', '","', '\n"\n', "\n\n", "é漢", "x" * 90, '""', "end\n"]

    def cell(c):
        return '"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n') or rng.random() < 0.2 else c

    out = {}
    for i in range(3):
        lines = ["k,a,b"]
        for n in range(30):
            some = [str(n), *(cell(rng.choice(cells)) for _ in range(rng.choice([2, 2, 2, 1, 3])))]
            lines.append(",".join(some))
        out[f"f{i}.csv"] = "\n".join(lines) + rng.choice(["", "\n"])
    out["loose.csv"] = 'k,a,b\n1,in "the" middle,it"s\n2,"a\nb",c"\n\n3,x,"y"\n'
    out["head.csv"] = 'k,a,b\n'
    out["mark.csv"] = b"\xef\xbb\xbf" + 'k,a,b\n1,"x\n,""y",z'.encode()
    return out


def test_csv_split_reads_what_whole_files_hold(spark, tmp_path, ranges):
    for seed in (1, 2):
        texts = csv_files(random.Random(seed))
        path = staged(tmp_path, texts)
        got, want = csv_rows(CS.read_csv_split(spark, path)), csv_rows(CSV.read_csv(spark, path))
        for name in texts:
            assert got.get(name) == want.get(name), name


def test_csv_split_flags_a_quote_that_is_never_closed(spark, tmp_path, ranges):
    got = csv_rows(CS.read_csv_split(spark, staged(tmp_path, {"x.csv": 'k,a\n1,x\n2,"y\n' + "3,z\n" * 200})))["x.csv"]
    assert got[0] == ("1", "x", None) and len(got) == 2 and got[1][2] == "quoted cell is not closed"


def test_line_end_against_a_plain_walk():
    def walk(line, inside):
        i = 0
        state = "cell" if inside else "start"
        while i < len(line):
            c = line[i]
            if state == "start":
                state = "cell" if c == '"' else "start" if c == "," else "bare"
            elif state == "bare":
                state = "start" if c == "," else "bare"
            elif c == '"':
                if line[i + 1:i + 2] == '"':
                    i += 1
                else:
                    state = "bare"
            i += 1
        return state == "cell"

    rng, end = random.Random(3), CS.line_end(",")
    for _ in range(20000):
        line = "".join(rng.choice('"",a') for _ in range(rng.randrange(12)))
        for inside in (False, True):
            assert end(line.encode(), inside) == walk(line, inside), (line, inside)
