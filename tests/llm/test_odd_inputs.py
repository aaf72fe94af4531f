"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from featureflow.llm import (ball_tree, byte_bpe, jaccard_join, license_scan, mixing, ppm, quality_rules, toxicity,
                             unigram_counts, weak_quality)
from featureflow.llm.queries import default_vocabulary

PROSE = "the quick brown fox jumps over the lazy dog while seven small birds watch from a high wire in silence today "
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["id", "c", "n", "t", "row", "size", "kept", "score", "source_size", "n_words", "copies", "k", "root", "word", "h"]

ROWS = [
    (1, PROSE + "one", "en", "a", 1), (1, PROSE + "one", "en", "a", 1), (2, PROSE + "two", "en", None, None),
    (3, None, None, "a", None), (4, "", "en", "b", 0), (5, " \n\t ", "en", "b", 3), (None, PROSE + "no id", "en", "b", 1),
    (None, None, None, None, None), (6, "short", "en", "a", 5), (7, (PROSE + "word ") * 3000, "en", "c", 1),
    (8, "loser idiot " * 30, "en", "c", 1), (9, "Ünïcode ça va   naïve \x85 \U0001f600 " + PROSE, "fr", "c", 1),
]


def docs_frame(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (8, 1, 1), (8, 0, 0), (99, 0, 1), (None, 0, 1), (3, 1, None)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def vocabulary(spark):
    return default_vocabulary(spark)


def unigram(spark):
    import public_tokenizers as P

    return unigram_counts.share_model(spark, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def run_ppm(docs):
    model, words = ppm.train(docs)
    return ppm.score(docs, model, words)


PER_ROW = {
    "weak_quality": lambda s, d: weak_quality.score(d, weak_quality.train(d)),
    "mixing": lambda s, d: mixing.plan_copies(d),
    "unigram_counts": lambda s, d: unigram_counts.token_counts(d, unigram(s)),
    "quality_rules": lambda s, d: quality_rules.judge(d),
    "toxicity": lambda s, d: toxicity.score(d, toxicity.train(d, labels(s))),
    "ppm": lambda s, d: run_ppm(d),
    "byte_bpe": lambda s, d: byte_bpe.digests(d, default_vocabulary(s), with_ids=True),
    "jaccard_join": lambda s, d: jaccard_join.near_components(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_input_row(spark, name):
    rows = PER_ROW[name](spark, docs_frame(spark)).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, name):
    assert PER_ROW[name](spark, docs_frame(spark, [])).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_and_empty_tables(spark, name, stage):
    docs = docs_frame(spark)
    out = stage(spark, docs, "")
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns
    out.collect()
    empty = stage(spark, docs_frame(spark, []), "")
    assert empty.count() == 0


def test_rules_on_odd_rows(spark):
    got = {r["doc_id"]: r for r in quality_rules.judge(docs_frame(spark)).collect()}
    assert got[3]["n_words"] == 0 and got[3]["base_failed"] and not got[3]["kept"]
    assert got[2]["kept"] and got[2]["host_rate"] is None  # no host, no verdict
    assert got[7]["n_repeat_words"] == got[7]["n_words"] and got[7]["base_failed"]


@pytest.mark.parametrize("doc_id", ["7L", "cast(null as long)"])
def test_mixing_takes_repeated_rows_one_by_one(spark, doc_id):
    tied = spark.range(0, 1000, 1, 4).selectExpr(f"{doc_id} as doc_id", "'two words' as text", "'a' as source")
    others = spark.range(1000, 2000).selectExpr("id as doc_id", "'two words' as text", "'b' as source")
    for r in mixing.plan_copies(tied.union(others)).groupBy("source").agg(
            F.sum("taken").alias("taken"), F.first("target").alias("target"), F.count("*").alias("n")).collect():
        assert r["n"] == 1000 and abs(r["taken"] - r["target"]) <= 1.001


def test_near_copies_on_odd_rows(spark):
    got = {}
    for r in jaccard_join.near_components(docs_frame(spark)).collect():
        got.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert got[3] == [(0, 3)] and got[4] == [(0, 4)] and got[5] == [(0, 5)] and got[6] == [(1, 6)]
    assert len(got[1]) == 2 and all(c == 1 for _, c in got[1]) and got[2][0][1] == 1
    kept = jaccard_join.keep_one(docs_frame(spark)).collect()
    assert sum(r["doc_id"] == 1 for r in kept) == 1  # of repeated rows one stays
    assert {3, 4, 5, 6} <= {r["doc_id"] for r in kept} and not any(r["doc_id"] == 2 for r in kept)


def test_scores_on_odd_rows(spark):
    got = {r["doc_id"]: r["score"] for r in PER_ROW["toxicity"](spark, docs_frame(spark)).collect()}
    assert all(0 <= x <= 1 for x in got.values()) and got[3] == got[4]
    only_clean = toxicity.train(docs_frame(spark), labels(spark).where("toxic = 0 and doc_id < 8"))
    assert toxicity.score(docs_frame(spark), only_clean).agg(F.count_distinct("score")).first()[0] == 1


def test_lm_on_odd_rows(spark):
    got = {r["doc_id"]: r for r in run_ppm(docs_frame(spark)).collect()}
    assert got[4]["n_tokens"] == 1 and got[4]["n_known"] == 1 and got[4]["score"] < 0
    assert got[5]["n_tokens"] == 1
    model, words = ppm.train(docs_frame(spark, []))
    blank = {r["doc_id"]: r for r in ppm.score(docs_frame(spark), model, words).collect()}
    assert blank[6]["n_known"] == 0 and blank[6]["train_tokens"] == 0
    assert abs(blank[6]["score"] + 6 * 2.4099) < 0.01  # 5 bytes and the end among 257 symbols


def test_license_scan_on_odd_rows(spark):
    rows = [(1, "Licensed under the Apache License, Version 2.0.\n" * 400), (2, None), (3, ""), (None, "All rights reserved."), (4, "of")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("x")).withColumn("h", F.lit(1))
    got = {(r["doc_id"], r["license"]): r for r in license_scan.scan(docs, license_scan.notices(spark)).collect()}
    assert set(got) == {(1, "apache-2.0"), (None, "all-rights-reserved")}
    assert got[(1, "apache-2.0")]["first_shingle"] == 0 and got[(1, "apache-2.0")]["n_windows"] >= 400
    assert license_scan.scan(docs.limit(0), license_scan.notices(spark)).count() == 0
    assert license_scan.scan(docs, license_scan.notices(spark).limit(0)).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(docs, spark.createDataFrame([("x", "one")], "license string, text string"))


def test_ball_tree_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [1.0, nan]), (4, None), (5, [1.0, None]), (6, [inf, 1.0]),
            (7, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (100, [1.0, -1.0]), (200, []), (8, []), (0, [0.5, 0.25])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit(1)).withColumn("id", F.lit(2))
    got = [tuple(r) for r in ball_tree.top_k(v, F.col("vec_id") % 100 == 0, 3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 512 * 512 + 256 * 256), (0, 2, 2, 512 * 512 + 256 * 256), (0, 3, 100, 512 * 1024 - 256 * 1024),
                   (100, 1, 0, 262144), (100, 2, 0, 262144), (100, 3, 1, 262144), (200, 1, 8, 0)]
    assert ball_tree.top_k(v.limit(0), F.col("vec_id") % 100 == 0, 3).count() == 0


def test_ball_tree_large_components(spark):
    rows = [(i, [float(2 ** 27 + i), -float(i) * 2 ** 26]) for i in range(20)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in ball_tree.top_k(v, F.col("vec_id") % 10 == 0, 4, scale=1.0).collect()]
    want = []
    for q, x in rows:
        if q % 10 == 0:
            dots = sorted(((-sum(int(a) * int(b) for a, b in zip(x, y)), i) for i, y in rows if i != q))[:4]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(dots)]
    assert sorted(got) == sorted(want)
