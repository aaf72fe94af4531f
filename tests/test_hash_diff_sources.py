import json

import pytest
from pyspark.sql import functions as F

from featureflow.functions import canonical
from featureflow.functions import predicates as P
from featureflow.operators import diff as D
from featureflow.operators.digest import collection_digest, empty_digest_hash, with_feature_hash
from featureflow.operators.transforms import Step, step_counts
from featureflow.plans import fixtures as X
from featureflow.plans.refresh import SourceSpec, empty_state, load_state, refresh
from featureflow.sources import csv as CSV
from featureflow.sources import geojson as GJ
from featureflow.sources import jsonrec as JR


def _digest(df):
    return collection_digest(with_feature_hash(df)).first()["content_hash"]


def test_digest_is_order_free_and_counts_duplicates(spark, sf_dir):
    st = X.stations(spark, sf_dir)
    base = _digest(st)
    assert _digest(st.repartition(7).orderBy(F.rand(3))) == base
    assert _digest(st.unionByName(st.limit(1))) != base
    assert _digest(st.withColumn("pm25", F.col("pm25") + F.lit(0.0))) == base  # same numbers, same digest


def test_key_and_property_order_free(spark):
    a = spark.createDataFrame([(1, "x")], "a INT, b STRING").withColumn("geometry", F.parse_json(F.lit('{"type":"Point","coordinates":[1,2]}')))
    b = spark.createDataFrame([("x", 1)], "b STRING, a INT").withColumn("geometry", F.parse_json(F.lit('{"coordinates":[1.0,2],"type":"Point"}')))
    ha = with_feature_hash(a).first()["_hash"]
    hb = with_feature_hash(b).first()["_hash"]
    assert ha == hb


def test_diff_identity(spark, sf_dir):
    from featureflow.plans.queries import refreshed_stations

    cur = D.key_index(refreshed_stations(spark, sf_dir))
    prev = D.key_index(refreshed_stations(spark, sf_dir, "stations_prev"))
    c = D.diff_counts(D.change_feed(cur, prev)).first()
    assert c["added"] - c["removed"] == cur.count() - prev.count()
    same = D.diff_counts(D.change_feed(cur, cur)).first()
    assert (same["added"], same["removed"], same["modified"]) == (0, 0, 0)


def test_second_run_publishes_nothing(spark, sf_dir):
    from featureflow.plans.queries import _specs
    from featureflow.plans.refresh import empty_state, refresh

    idx, meta = empty_state(spark)
    first = refresh(spark, _specs(sf_dir), idx, meta, "2024-01-31 00:00:00", dry_run=True)
    assert {r["status"] for r in first.manifest.collect()} == {"ok"}
    assert len(first.outputs) == 2
    second = refresh(spark, _specs(sf_dir), first.next_index, first.next_meta, "2024-01-31 01:00:00", dry_run=True)
    rows = second.manifest.collect()
    assert {r["status"] for r in rows} == {"unchanged"} and second.outputs == []
    assert all(r["unchanged"] == r["feature_count"] for r in rows)


def test_write_and_read_back_geojson(spark, sf_dir, tmp_path):
    from featureflow.plans.queries import _specs
    from featureflow.plans.refresh import empty_state, refresh

    idx, meta = empty_state(spark)
    out = str(tmp_path / "run")
    r = refresh(spark, _specs(sf_dir), idx, meta, "2024-01-31 00:00:00", out_dir=out, run_id="1")
    back = GJ.read_geojson_seq(spark, f"{out}/features/run_id=1/_source=depots/*.txt")
    assert back.count() == X.depots(spark, sf_dir).count()
    assert back.where(F.col("_problem").isNotNull()).count() == 0
    assert spark.read.parquet(f"{out}/manifest").count() == 2
    assert r.outputs


def test_read_geojson_file_shapes(spark, tmp_path):
    (tmp_path / "fc.geojson").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","id":7,'
                                         '"geometry":{"type":"Point","coordinates":[1,2]},"properties":null}]}')
    (tmp_path / "bare.geojson").write_text('{"type":"Point","coordinates":[3,4]}')
    df = GJ.read_geojson(spark, str(tmp_path / "*.geojson"))
    rows = sorted((str(r["id"]), r["p"]) for r in df.select(F.to_json("_id").alias("id"),
                                                             F.to_json("_props").alias("p")).collect())
    assert rows == [("7", "{}"), ("None", "{}")]


def test_selectors(spark):
    doc = {"net": {"rows": [{"k": 4}, {"k": 6}, {"k": 9}], "by id": {"q": 1, "p": 2}}, "x.y": [[10, 20], [30]], "it's": None}
    df = spark.createDataFrame([(json.dumps(doc),)], "t STRING").select(F.parse_json("t").alias("d"))
    found = {"": doc, "$": doc, "net.rows[1].k": 6, "$.net.rows[-3].k": 4, "$['x.y'][0][ -1 ]": 20, r"""$["it\'s"]""": None,
             "$.net['by id'][*]": [2, 1], "$.net.rows[*]": doc["net"]["rows"]}
    for selector, value in found.items():
        v, p = JR.select_path(F.col("d"), selector)
        r = df.select(F.to_json(v).alias("v"), p.alias("p")).first()
        assert json.loads(r["v"]) == value and r["p"] is None, selector
    absent = {"$.net.cols": "no member 'cols' at $.net", "$.net.rows[3]": "no item 3 among 3 at $.net.rows",
              "$.net[0]": "no array at $.net: dict", "net.rows.k": "no object at $.net.rows: list",
              "$['x.y'][1][0][*]": "no values to list at $.x.y[1][0]: int"}
    for selector, why in absent.items():
        v, p = JR.select_path(F.col("d"), selector)
        assert df.select(p).first()[0] == why
    for text in ("$.", "$[", "$[x]", "$['a'", "a..b", "$a]"):
        with pytest.raises(ValueError):
            JR.selector_steps(text)
    for selector, why in {"$.net": "no list of records at $.net: dict", "$['x.y']": "record no object at $['x.y'][0]: list"}.items():
        _, problem = JR.select_records(F.col("d"), selector)
        assert df.select(problem).first()[0] == why


CELLS = [("01234", "str"), ("+44", "str"), ("1e5", "str"), ("14.437800", "str"), ("14.4378", "float"), ("7", "int"),
         (" 5 ", "int"), ("-0", "str"), ("TRUE", "bool"), ("null", "null"), ("", "null"), ("0.5", "float"),
         ("-12.25", "float"), ("nan", "str"), ("abc ", "str"), ("13.404953999999999", "float"), ("0.30000000000000004", "float"),
         ("0.300000000000000041", "str"), ("1e-05", "float"), ("1e+16", "float"), ("1e-5", "str"), ("2.5e-07", "float"),
         ("123456789012345678901", "int"), ("0.1", "float"), ("-0.0", "float"), ("0.00001", "str"), ("1.0", "float")]


def test_csv_coercion_table(spark):
    df = spark.createDataFrame([(c,) for c, _ in CELLS], "c STRING")
    assert [r[0] for r in df.select(CSV.coerce_kind(F.col("c"))).collect()] == [k for _, k in CELLS]


def test_csv_reader_and_sniffer(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("﻿station_id;city;lat;lon\n007;Berlin;52.5;13.4\n008;Paris;48.9;2.35\n", encoding="utf-8")
    df = CSV.read_csv(spark, str(p))
    assert df.columns == ["_doc", "_ord", "station_id", "city", "lat", "lon", "_problem"]
    assert sorted(r["station_id"] for r in df.collect()) == ["007", "008"]
    assert CSV.sniff_delimiter("a|b|c") == "|" and CSV.sniff_delimiter("single") == ","


def test_csv_dialect_and_wide_rows(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text('_code,note,n\n1,"say ""hi"", twice",2\n2,"two\nlines",3\n3,a,4,\n4,b\n5,"x,y",6\n', encoding="utf-8")
    rows = {r["_code"]: r for r in CSV.read_csv(spark, str(p)).collect()}
    assert rows["1"]["note"] == 'say "hi", twice' and rows["2"]["note"] == "two\nlines" and rows["5"]["note"] == "x,y"
    assert rows["3"]["_problem"] and rows["4"]["n"] is None
    assert [k for k in rows if rows[k]["_problem"]] == ["3"]
    bad = tmp_path / "bad.csv"
    bad.write_text("a,,c\n1,2,3\n")
    with pytest.raises(ValueError):
        CSV.read_csv(spark, str(bad))
    lines = spark.createDataFrame([("1,2,",), ("1,2,,4",), ("1,2",), ('1,"2,3"',)], "value STRING")
    assert [r["_too_many"] for r in CSV.parse_lines(lines, ["a", "b"], ",").collect()] == [True, True, False, False]


def test_canonical_text_loses_nothing(spark):
    texts = ["a\u2028b", "a\u2029b", "a\u0085b", "a\nb", '"', "\\", "]", ""]
    df = spark.createDataFrame([(t,) for t in texts], "v STRING")
    got = [json.loads(r[0]) for r in df.select(canonical.json_text(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == texts
    numbers = [1.23456789012345e-10, 1.23456789099345e-10, 1e-300, 0.1, -0.0, 2.0 ** 60, 1.5e300, 1e22, 123456.789, 1e-7, 4.9e-324]
    df = spark.createDataFrame([(x,) for x in numbers], "v DOUBLE")
    text = [r[0] for r in df.select(canonical.json_text(F.col("v"), df.schema["v"].dataType)).collect()]
    assert [float(t) for t in text] == numbers and len(set(text)) == len(numbers)
    assert text[4] == "0" and text[7] == "1e+22" and text[9] == "0.0000001"


def test_variant_numbers_have_one_text(spark):
    same = ['{"a":1}', '{"a":1.0}', '{"a":1e0}', '{ "a" : 1.00 }']
    df = spark.createDataFrame([(t,) for t in [*same, '{"a":"1.0"}', '{"a":-0.0,"b":1.50,"c":10.0,"d":"x-0,1.0","e":100}']], "t STRING")
    got = [r[0] for r in df.select(canonical.variant_text(F.parse_json("t"))).collect()]
    assert set(got[:4]) == {'{"a":1}'} and got[4] == '{"a":"1.0"}'
    assert got[5] == '{"a":0,"b":1.5,"c":10,"d":"x-0,1.0","e":100}'


def features(spark, *members):
    text = json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [i, 2]}, "properties": p} for i, p in enumerate(members)]})
    return GJ.parse_geojson(spark.createDataFrame([("d", text)], "_doc STRING, value STRING"))


def test_steps_on_schemaless_properties(spark):
    f = features(spark, {"name": "a", "pop": 5, "_score": 1}, {"name": "b", "pop": None}, {"pop": 9, "alias": "z"})
    kept = Step("filter", lambda df: P.gt(P.prop(df, "pop", "int"), 4)).apply(f)
    assert kept.count() == 2
    picked = Step("select", ["pop", "_score", "nope"]).apply(f)
    assert [json.loads(r[0]) for r in picked.select(F.to_json("_props")).collect()] == [{"_score": 1, "pop": 5}, {"pop": None}, {"pop": 9}]
    renamed = Step("rename", {"name": "title", "alias": "pop"}).apply(f)
    assert [json.loads(r[0]) for r in renamed.select(F.to_json("_props")).collect()] == [
        {"_score": 1, "pop": 5, "title": "a"}, {"pop": None, "title": "b"}, {"pop": 9}]
    report = [(r["features_in"], r["features_out"]) for r in step_counts(f, [
        Step("rename", {"pop": "people"}), Step("filter", lambda df: P.gt(P.prop(df, "people", "int"), 4)),
        Step("select", ["name"]), Step("filter", lambda df: P.eq(P.prop(df, "people", "int"), None))]).orderBy("step_no").collect()]
    assert report == [(3, 3), (3, 2), (2, 2), (2, 2)]


def test_step_report_sees_what_the_steps_left(spark, sf_dir):
    st = X.stations(spark, sf_dir)
    steps = [Step("rename", {"pm25": "fine"}), Step("filter", "fine > 0"), Step("select", ["station_id"]), Step("round", 2)]
    counts = [(r["features_in"], r["features_out"]) for r in step_counts(st, steps).orderBy("step_no").collect()]
    n, k = st.count(), st.where("pm25 > 0").count()
    assert counts == [(n, n), (n, k), (k, k), (k, k)]


def test_last_row_of_a_key_does_not_depend_on_arrival(spark):
    docs = spark.createDataFrame([(f"d{i}", json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": 1, "geometry": None, "properties": {"v": i}}]})) for i in range(6)], "_doc STRING, value STRING")
    seen = set()
    for n in (1, 3, 6):
        f = D.with_key(with_feature_hash(GJ.parse_geojson(docs.repartition(n).orderBy(F.rand(n)))))
        seen.add(D.key_index(f).first()["hash"])
    assert len(seen) == 1


def source(name, texts, **kw):
    return SourceSpec(name, lambda s: GJ.parse_geojson(s.createDataFrame([(f"{name}{i}", t) for i, t in enumerate(texts)], "_doc STRING, value STRING")), **kw)


def collection(*coords):
    return json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": i, "geometry": {"type": "Point", "coordinates": c}, "properties": {}} for i, c in enumerate(coords)]})


def test_bad_payload_fails_its_source_only(spark, tmp_path):
    nan = SourceSpec("nan", lambda s: s.createDataFrame([(1, float("nan"))], "_ord INT, v DOUBLE").withColumn("geometry", F.lit(None).cast("variant")))
    specs = [source("cut", [collection([1, 2]), '{"type":"FeatureCollection","fea'], steps=[Step("drop_invalid", True)]), nan,
             source("good", [collection([3, 4])])]
    out = str(tmp_path / "run")
    r = refresh(spark, specs, *empty_state(spark), "2024-02-01 00:00:00", out_dir=out)
    rows = {x["source"]: x for x in r.manifest.collect()}
    assert {k: (x["status"], x["error_code"]) for k, x in rows.items()} == {"cut": ("failed", 5), "nan": ("failed", 5), "good": ("ok", None)}
    assert r.exit_code == 5 and r.outputs == [] and "invalid JSON" in rows["cut"]["error"]
    assert spark.read.parquet(f"{out}/manifest").count() == 3


def test_blocked_change_is_published_later(spark, tmp_path):
    out = str(tmp_path / "run")

    def run(n, a, b):
        index, meta = load_state(spark, out, replay_of=str(n))
        return refresh(spark, [source("a", [a]), source("b", [b])], index, meta, f"2024-02-0{n} 00:00:00", out_dir=out, run_id=str(n))

    assert len(run(1, collection([1, 1]), collection([2, 2])).outputs) == 2
    second = run(2, collection([5, 5]), "{")
    assert second.outputs == [] and second.exit_code == 5
    third = run(3, collection([5, 5]), collection([2, 2]))
    assert [r["status"] for r in third.manifest.orderBy("source").collect()] == ["unchanged", "unchanged"]
    assert len(third.outputs) == 1 and third.exit_code == 0
    fourth = run(4, collection([5, 5]), collection([2, 2]))
    assert fourth.outputs == [] and fourth.exit_code == 3
    run(4, collection([5, 5]), collection([2, 2]))  # a replay leaves one manifest of the run
    assert spark.read.parquet(f"{out}/manifest").where("run_id = 4").count() == 2


def test_empty_source_and_lost_state(spark, tmp_path):
    empty = json.dumps({"type": "FeatureCollection", "features": []})
    first = refresh(spark, [source("e", [empty])], *empty_state(spark), "2024-02-01 00:00:00", dry_run=True)
    row = first.manifest.first()
    assert (row["status"], row["feature_count"], row["content_hash"]) == ("ok", 0, empty_digest_hash())
    second = refresh(spark, [source("e", [empty])], first.next_index, first.next_meta, "2024-02-02 00:00:00", dry_run=True)
    assert second.manifest.first()["status"] == "unchanged"
    index, meta = load_state(spark, str(tmp_path / "nowhere"))
    assert index.count() == 0 and meta.count() == 0


def test_records_to_run(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"rows": [{"x": 1, "y": "2", "n": "p"}, {"x": 3, "y": 4, "n": "q"}]}))
    (tmp_path / "b.json").write_text('{"rows": [')
    records = JR.read_json_records(spark, str(tmp_path / "*.json"), "$.rows")
    f = JR.features_of_records(records, "x", "y")
    rows = f.collect()
    assert len(rows) == 3 and sum(r["_problem"] is not None for r in rows) == 1
    spec = SourceSpec("j", lambda s: f.where("_problem is null"), id_property="n")
    r = refresh(spark, [spec], *empty_state(spark), "2024-02-01 00:00:00", dry_run=True).manifest.first()
    assert (r["status"], r["feature_count"], r["keyed"]) == ("ok", 2, True)


def test_dry_run_reports_the_outputs_of_the_run(spark, sf_dir, monkeypatch):
    from dataclasses import replace

    from featureflow.plans import queries as Q

    run = Q.refresh
    planned = lambda *a, **k: replace(run(*a, **k), outputs=["would write geojson features/_source=depots"])
    monkeypatch.setattr(Q, "refresh", planned)
    got = {r["source"]: r["output"] for r in Q.q_refresh_dry_run(spark, sf_dir).collect()}
    assert got == {"stations": None, "depots": "would write geojson features/_source=depots"}
