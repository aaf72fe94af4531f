"""Committed state: deltas, digests, conflicts, damaged commits; and rows that used to be lost or to block a run."""

import json
import os

import pytest
from pyspark.sql import functions as F

from featureflow.functions import canonical
from featureflow.operators import diff as D
from featureflow.operators.digest import with_feature_hash
from featureflow.operators.features import map_point
from featureflow.plans import state as S
from featureflow.operators.transforms import Step, apply_steps
from featureflow.plans.refresh import SourceSpec, empty_state, load_state, published, refresh, run_committed
from featureflow.sources import csv as CSV
from featureflow.sources import geojson as GJ
from featureflow.sources import landing


def rows(spark, values, source="s"):
    """Features with (key, value), hashed and keyed."""
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(values)], "_ord long, k string, v long").withColumn("geometry", F.lit(None).cast("variant"))
    return D.with_key(with_feature_hash(df), "k").withColumn("_source", F.lit(source))


def committed(spark, out, values, keyed=True):
    change = S.compare(S.open_state(spark, out), rows(spark, values), {"s": keyed})
    counts = {r["_source"]: tuple(r[o] for o in D.OPS) for r in change.counts.collect()}
    state = S.commit(change.state, S.write_state(change, ["s"], spark.createDataFrame([], S.META)))
    change.release()
    return state, counts.get("s", (0, 0, 0, 0))


def keys(state):
    return sorted((r["id"], r["n"]) for r in state.rows().collect())


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    """A base of 2,000 rows, a delta of three, then the state before again."""
    out = str(tmp_path_factory.mktemp("state"))
    first = [(f"k{i}", i) for i in range(2000)]
    second = first[1:] + [("k5", 99), ("new", 1)]  # one gone, one changed by its last row, one added
    return out, first, [committed(spark, out, v) for v in (first, second, first)]


def test_a_delta_holds_what_changed(spark, history):
    out, first, steps = history
    assert [c for _, c in steps] == [(2000, 0, 0, 0), (1, 1, 1, 1998), (1, 1, 1, 1998)]
    second = steps[1][0]
    assert len(second.entry["deltas"]) == 1 and second.entry["delta_rows"] == 3 and second.digits == 2
    assert dict(keys(second))["k5"] == 2 and "k0" not in dict(keys(second))
    assert keys(steps[2][0]) == keys(steps[0][0]) == sorted((k, 1) for k, _ in first)
    assert keys(S.open_state(spark, out, 2)) == keys(second)


def test_only_rows_of_differing_leaves_are_joined(spark, history):
    out, first, steps = history
    change = S.compare(S.open_state(spark, out, 1), rows(spark, first[:-1] + [("k1999", 5)]), {"s": True})
    assert change.changed.count() == 1
    leaf = change.changed.first()["leaf"]
    assert change.feed.count() == rows(spark, first).where(S.leaf_of(F.col("_key"), 2) == leaf).count() < 40
    change.release()


def test_the_base_is_joined_without_an_exchange(spark, history):
    out, first, _ = history
    state = S.open_state(spark, out, 1)
    plan = state.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        change = S.compare(state, rows(spark, first), {"s": True})
        now = change.merged.select("source", "id", F.col("hash").alias("h"))
        text = now.join(state.base(), ["source", "id"], "full_outer")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", plan)
    right = text[text.index("Bucketed: true") - 3000:text.index("Bucketed: true")] if "Bucketed: true" in text else ""
    assert "Bucketed: true" in text and "FullOuter" in text
    assert "Exchange" not in right[right.rfind("InMemoryTableScan"):]
    change.release()


def test_a_second_commit_of_one_number_conflicts(spark, tmp_path):
    out = str(tmp_path / "o")
    a, b = S.open_state(spark, out), S.open_state(spark, out)
    S.commit(a, dict(a.entry))
    with pytest.raises(S.RunConflict):
        S.commit(b, dict(b.entry))
    assert S.commits(spark, out) == [1] and not [n for n in os.listdir(f"{out}/state/log") if n.startswith(".") and not n.endswith(".crc")]


def spec(name, values):
    def load(s):
        return s.createDataFrame([(i, k, v) for i, (k, v) in enumerate(values)], "_ord long, k string, v long").withColumn("geometry", F.lit(None).cast("variant"))

    return SourceSpec(name, load, id_property="k")


def test_of_two_runs_one_is_run_again_and_nothing_is_lost(spark, tmp_path, monkeypatch):
    out, commit, between = str(tmp_path / "o"), S.commit, []

    def late(state, entry):
        if not between:  # another run commits first
            between.append(1)
            run_committed(spark, [spec("b", [("x", 1)])], out, "2024-01-01 00:00:00", "other")
        return commit(state, entry)

    monkeypatch.setattr(S, "commit", late)
    r = run_committed(spark, [spec("a", [("x", 1), ("y", 2)])], out, "2024-01-02 00:00:00", "mine")
    assert r.committed.version == 2
    assert sorted(map(tuple, r.next_index.select("source", "key").collect())) == [("a", "x"), ("a", "y"), ("b", "x")]
    assert set(published(spark, out)) == {"a", "b"} and set(published(spark, out, 1)) == {"b"}
    assert spark.read.text(published(spark, out)["a"]).count() == 2


def test_modes_may_change_and_folders_are_dropped(spark, tmp_path):
    out = str(tmp_path / "o")
    assert committed(spark, out, [("a", 1), ("b", 2), ("b", 2)])[1] == (2, 0, 0, 0)
    _, counts = committed(spark, out, [(None, 1), ("b", 2), ("b", 2), (None, 7)], keyed=False)
    assert counts[2] == 0  # by hashes: nothing is modified
    state, counts = committed(spark, out, [(None, 1), ("b", 2)], keyed=False)
    assert counts == (0, 2, 0, 2) and state.rows().count() == 2
    gone = S.vacuum(spark, out, keep=1)
    assert any(n.startswith("base-") for n in gone) and S.open_state(spark, out).rows().count() == 2


def test_a_damaged_commit_is_passed_over(spark, tmp_path):
    out = str(tmp_path / "o")
    committed(spark, out, [("a", 1)])
    state, _ = committed(spark, out, [("a", 1), ("b", 2)])
    with open(f"{out}/state/log/{2:020d}.json", "w") as f:
        f.write('{"version": 2, "ba')
    crc = f"{out}/state/log/.{2:020d}.json.crc"
    if os.path.exists(crc):
        os.rename(crc, f"{tmp_path}/crc")
    again = S.open_state(spark, out)
    assert keys(again) == [("a", 1)] and again.version == 2
    assert committed(spark, out, [("a", 1), ("b", 2)])[0].version == 3


def test_damaged_state_of_plain_runs_is_a_first_run(spark, tmp_path):
    base = tmp_path / "run"
    spark.createDataFrame([("1", "2024-01-01")], "run_id string, run_at string").selectExpr("cast(run_at as timestamp) as run_at", "run_id") \
        .write.partitionBy("run_id").parquet(f"{base}/manifest")
    for part in ("index", "meta"):
        os.makedirs(f"{base}/state/run_id=1/{part}")
        (base / "state" / "run_id=1" / part / "part-0.parquet").write_bytes(b"no parquet")
    index, meta = load_state(spark, str(base))
    assert index.count() == 0 and meta.count() == 0


def test_csv_cells_reach_features(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,lon,lat,pm2.5,id\n1,2,3,4.5,x\n2,2,3,007,y,z\n3,2\n4,q,3,true,w\n")
    records = CSV.read_csv(spark, str(tmp_path / "a.csv"))
    assert records.columns == ["_doc", "_ord", "id", "lon", "lat", "pm2.5", "_problem"]
    f = map_point(CSV.coerced(records), "lon", "lat")
    got = {json.loads(r["id"]) if r["id"] else None: r for r in f.select(F.to_json("id").alias("id"), "_problem", F.to_json("`pm2.5`").alias("pm")).collect()}
    assert got["x"]["pm"] == "4.5" and got["x"]["_problem"] is None
    assert "more than 5 cells" in got["y"]["_problem"] and got["y"]["pm"] == '"007"'
    assert "'lon'" in got["w"]["_problem"] and got["w"]["pm"] == "true"
    assert "'lat'" in got[None]["_problem"]
    assert with_feature_hash(f).where("_hash is not null").count() == 4


def test_texts_that_look_like_nan_are_texts(spark):
    docs = ['{"a":"NaN","b":1e3}', '["Infinity",1.5e0,["x"]]', '{"a":{"b":["NaN"]},"c":1e0}', '"NaN"', "null", "[]"]
    v = spark.createDataFrame([(d,) for d in docs], "d string").select(F.parse_json("d").alias("v"))
    assert v.where(canonical.nonfinite(F.col("v"), v.schema["v"].dataType)).count() == 0
    deep = spark.range(3).select(F.to_variant_object(F.struct(F.lit("NaN").alias("t"), F.array(F.struct(F.array(
        F.when(F.col("id") == 1, F.lit(float("nan"))).when(F.col("id") == 2, F.lit(float("-inf"))).otherwise(F.lit(1.5))).alias("x"))).alias("l"))).alias("v"), "id")
    assert sorted(r["id"] for r in deep.where(canonical.nonfinite(F.col("v"), deep.schema["v"].dataType)).collect()) == [1, 2]


def test_ties_do_not_depend_on_arrival(spark):
    df = spark.createDataFrame([("a", 200, "2024-01-01", u) for u in "qzm"], "source string, status int, fetched_at string, url string")
    assert {landing.latest_success(df.orderBy(F.rand(i))).first()["url"] for i in range(4)} == {"z"}
    keyed = spark.createDataFrame([("d2", 0, "b"), ("d1", 0, "a"), ("d1", 1, "c")], "_doc string, _ord long, _key string")
    assert [r["key"] for r in D.first_run_samples(keyed).orderBy("rank").collect()] == ["a", "c", "b"]


def test_dotted_names_in_geojson_sources(spark):
    text = json.dumps({"type": "Feature", "geometry": None, "properties": {"pm2.5": 1}})
    f = GJ.parse_geojson(spark.createDataFrame([("d", text)], "_doc STRING, value STRING"))
    assert '"pm2.5":1' in with_feature_hash(f).select(F.to_json("_props")).first()[0]


def test_steps_of_a_run_are_counted_without_hiding_or_raising(spark, tmp_path):
    """What a step removed is not seen by later steps, keeps no content, and the run's result is that of the plain steps."""
    rows = [(i, None if i % 7 == 0 else str(i) if i % 3 else "x", float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "_ord long, n string, v double").withColumn(
        "geometry", F.parse_json(F.when(F.col("_ord") % 4 == 0, F.lit('{"type":"Point","coordinates":[500]}'))
                                 .otherwise(F.lit('{"type":"Point","coordinates":[1.26,2.5]}'))))
    steps = (Step("filter", "n <> 'x'", "numbers"), Step("rename", {"n": "m"}), Step("filter", "cast(m as int) > 10", "large"),
             Step("drop_invalid", True), Step("round", 1))
    spec = SourceSpec("s", lambda _: df, steps, "m")
    plain = apply_steps(df, steps)
    first = refresh(spark, [spec], *empty_state(spark), "2024-01-01 00:00:00", out_dir=str(tmp_path), run_id="1")
    a = [r for r in rows if r[1] not in (None, "x")]
    b = [r for r in a if int(r[1]) > 10]
    c = [r for r in b if r[0] % 4]
    got = [(r["step_no"], r["features_in"], r["features_out"], r["removed"]) for r in first.step_report().orderBy("step_no").collect()]
    assert got == [(1, 60, len(a), 60 - len(a)), (2, len(a), len(a), 0), (3, len(a), len(b), len(a) - len(b)),
                   (4, len(b), len(c), len(b) - len(c)), (5, len(c), len(c), 0)]
    assert first.manifest.first()["feature_count"] == plain.count() == len(c)
    assert {r["hash"] for r in first.next_index.collect()} == {r["_hash"] for r in with_feature_hash(plain).collect()}
    assert spark.read.text(f"{tmp_path}/features/run_id=1").count() == len(c)


def test_step_report_of_empty_and_skipped_sources(spark):
    none = spark.createDataFrame([], "_ord long, v double").withColumn("geometry", F.parse_json(F.lit("{}")))
    specs = [SourceSpec("empty", lambda _: none, (Step("filter", "v > 0"),)), SourceSpec("other", lambda _: none), SourceSpec("skipped", lambda _: none)]
    r = refresh(spark, specs, *empty_state(spark), "2024-01-01 00:00:00", only=["empty", "other"], dry_run=True)
    assert [tuple(x) for x in r.step_report().collect()] == [("empty", 1, "filter", "", 0, 0, 0)]
    assert {x["source"]: x["steps"] for x in r.manifest.collect()} == {"empty": [(1, "filter", "", 0, 0, 0)], "other": [], "skipped": None}
