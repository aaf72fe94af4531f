"""The registered queries of the operators, with their SQL twins where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm import (ball_tree, byte_bpe, jaccard_join, license_scan, merkle_manifest, mixing, ppm, quality_rules, sanitise,
                             spelling_variants, toxicity, unigram_counts, weak_quality)
from featureflow.llm.common import crc_bucket, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.tiktoken"

SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def default_vocabulary(spark: SparkSession):
    import public_tokenizers

    return byte_bpe.share_vocabulary(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


# -- 1: quality classifier ------------------------------------------------------

@query
def op1_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = weak_quality.score(docs, weak_quality.train(docs))
    return out.select("doc_id", "p_weak", "quality", (F.col("quality") >= 0.5).alias("kept"))


# -- 2: mixing sources to target weights --------------------------------------

@query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_copies(table(spark, sf_dir, "documents"), importance=mixing.by_length(F.col("text")))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "copies")


ORACLE["op2_mix_sources"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, CAST(len({SQL_WORDS}) AS BIGINT) AS size,
         (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
           / 4503599627370496.0::DOUBLE AS u
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS DOUBLE) AS w,
              row_number() OVER (ORDER BY source IS NULL, source) AS i, 3.0::DOUBLE * source_size AS cap FROM s0),
s2 AS (SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(cap) OVER before, 0))
                 / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level FROM s1
       WINDOW before AS (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, cap <= level * w AS capped FROM s2),
s AS (SELECT source, source_size,
             CASE WHEN capped THEN cap ELSE
               (SELECT level FROM s3 x WHERE NOT capped ORDER BY cap / w, i LIMIT 1) * w END AS target FROM s3),
i AS (SELECT source, CAST(length(bin(size)) AS DOUBLE) AS imp, CAST(sum(size) AS DOUBLE) AS words FROM d GROUP BY ALL),
j AS (SELECT i.source, imp, CASE WHEN sum(imp * words) OVER rest > 0 THEN
               (target - 3 * coalesce(sum(words) OVER before, 0)) / sum(imp * words) OVER rest END AS level
      FROM i JOIN s ON i.source IS NOT DISTINCT FROM s.source
      WINDOW before AS (PARTITION BY i.source ORDER BY imp DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             rest AS (PARTITION BY i.source ORDER BY imp DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
v AS (SELECT source, arg_max(level, imp) FILTER (WHERE level * imp < 3) AS level FROM j GROUP BY source),
e AS (SELECT d.*, source_size, target, least(3.0::DOUBLE, level * CAST(length(bin(size)) AS DOUBLE)) AS ideal
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source LEFT JOIN v ON d.source IS NOT DISTINCT FROM v.source),
q AS (SELECT *, floor(ideal) AS sure, ideal - floor(ideal) AS p FROM e),
r AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) * ((1 - p) / p) END AS k FROM q),
c AS (SELECT *, target - sum(sure * size) OVER (PARTITION BY source) AS need,
             sum(CASE WHEN k IS NULL THEN 0 ELSE size END) OVER (PARTITION BY source ORDER BY k NULLS LAST, doc_id NULLS FIRST, size, rid
                                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               - CASE WHEN k IS NULL THEN 0 ELSE size END AS before FROM r)
SELECT doc_id, size, source_size, target,
       CAST(sure + CASE WHEN k IS NOT NULL AND need > 0 AND before + size / 2 <= need THEN 1 ELSE 0 END AS INTEGER) AS copies,
       CAST((sure + CASE WHEN k IS NOT NULL AND need > 0 AND before + size / 2 <= need THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM c
"""


# -- 3: token counts ---------------------------------------------------------------

@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = unigram_counts.share_model(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return unigram_counts.token_counts(table(spark, sf_dir, "documents"), model)


# -- 4: host-level quality rules ----------------------------------------------

@query
def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


ORACLE["op4_host_rules"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text, {SQL_WORDS} AS w FROM documents),
l AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT rid, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g
      FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 7, 0) + 1)) AS i FROM d)),
m AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n
      FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM m) GROUP BY rid),
b AS (SELECT d.rid, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN l USING (rid) LEFT JOIN c USING (rid)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b),
x AS (SELECT source, unnest(['base', 'symbols', 'lines', 'letters']) AS rule, unnest([0, -1, -2, -3]) AS i,
             unnest([base_failed, n_words > 0 AND 100 * n_symbols > 10 * n_words, 100 * n_dup_lines > 30 * n_lines,
                     100 * word_chars < 300 * n_words]) AS bad FROM f WHERE source IS NOT NULL),
h AS (SELECT source, rule, i, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE bad) AS DOUBLE) AS m
      FROM x GROUP BY source, rule, i),
p AS (SELECT rule, coalesce(avg(m / n) FILTER (WHERE n >= 2), 0) AS mean,
             coalesce(avg(m * (m - 1) / (n * (n - 1))) FILTER (WHERE n >= 2), 0) AS second FROM h GROUP BY rule),
k AS (SELECT rule, mean, CASE WHEN second - mean * mean <= 0 THEN 1e6
                         ELSE least(greatest((mean - second) / (second - mean * mean), 2.0), 1e6) END AS strength FROM p),
r AS (SELECT source, rule, i, n + strength AS size, (m + strength * mean) / (n + strength) AS rate FROM h JOIN k USING (rule)),
o AS (SELECT *, rate - 2.0 * sqrt(greatest(rate * (1 - rate), 0) / (size + 1)) AS low FROM r),
v AS (SELECT source, rate AS host_rate, low > 0.5 AS host_rejected, CASE WHEN low > 0.5 THEN rule END AS host_rule
      FROM o QUALIFY row_number() OVER (PARTITION BY source ORDER BY low DESC, i DESC) = 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed, host_rate,
       coalesce(host_rejected, false) AS host_rejected, host_rule, NOT base_failed AND NOT coalesce(host_rejected, false) AS kept
FROM f LEFT JOIN v ON f.source = v.source
"""


# -- 5: toxicity ------------------------------------------------------------------

@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_bucket(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs.where(~held_out), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


# -- 6: license scans ----------------------------------------------------------------

@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.notices(spark)).select("doc_id", "license", "containment")


# -- 7: LM scoring -----------------------------------------------------------------

@query
def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_bucket(F.col("doc_id"), 5) == 1
    model, words = ppm.train(docs.where(~held_out))
    out = ppm.score(docs, model, words, extra=held_out)
    return out.withColumnRenamed("extra", "held_out")


# -- 8: exact top-k search ----------------------------------------------------------

@query
def op8_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE["op8_ball_tree"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""


# -- 9: byte-level BPE ---------------------------------------------------------

@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), default_vocabulary(spark))


# -- 10: n-gram Jaccard join ---------------------------------------------------

@query
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.near_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


# -- 11: spelling variant grouping -----------------------------------------------

@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


# -- 12: personal data -----------------------------------------------------------

@query
def op12_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.digests(table(spark, sf_dir, "documents"))


# -- 13: Merkle dataset manifest -------------------------------------------------

@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.verify(table(spark, sf_dir, "documents"))


def _sql_field(c: str) -> str:
    return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


# DuckDB has no crc32: the table of its 256 bytes, then one step a digit.
_SQL_CRC_TABLE = ("list_transform(range(256), lambda b: list_reduce(range(8), "
                  "lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b))")

ORACLE["op13_merkle_manifest"] = f"""
WITH RECURSIVE t AS (SELECT {_SQL_CRC_TABLE} AS crcs),
d AS (
  SELECT doc_id, lang, sha256({" || ".join(_sql_field(c) for c in merkle_manifest.FIELDS)}) AS leaf,
         sha256({" || ".join(_sql_field("translate(text, '" + merkle_manifest.UPPER + "', '" + merkle_manifest.LOWER + "')" if c == "text" else c)
                             for c in merkle_manifest.FIELDS)}) AS lowered,
         xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                         lambda c, b: xor(c // 256, crcs[xor(c % 256, b) + 1]), 4294967295), 4294967295) AS crc
  FROM documents, t),
l AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
             CASE WHEN crc % 3 = 0 THEN lowered ELSE leaf END AS start FROM d),
lv AS (
  SELECT tree, 0 AS level, idx, leaf AS h FROM l
  UNION ALL
  SELECT tree, level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM lv) WHERE n > 1 GROUP BY tree, level, idx // 8),
sub AS (SELECT tree, level, h FROM (SELECT *, max(level) OVER (PARTITION BY tree) AS top FROM lv) WHERE level = top),
tv AS (
  SELECT 0 AS level, tree AS idx, h FROM sub
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS n FROM tv) WHERE n > 1 GROUP BY level, idx // 8),
-- levels of a tree and of the subroots' tree in one numbering, runs by their number
nodes AS (
  SELECT tree, level, idx, h FROM lv
  UNION ALL
  SELECT s.tree, s.level + v.level, v.idx, v.h FROM sub s JOIN tv v ON v.level > 0),
runs AS (
  SELECT s.tree, s.level + v.level AS level, v.idx // 8 AS run, list(v.h ORDER BY v.idx) AS hs FROM sub s JOIN tv v ON true
  GROUP BY s.tree, s.level + v.level, v.idx // 8
  UNION ALL
  SELECT lv.tree, lv.level, lv.idx // 8, list(lv.h ORDER BY lv.idx) FROM lv JOIN sub s ON lv.tree = s.tree AND lv.level < s.level
  GROUP BY lv.tree, lv.level, lv.idx // 8),
depth AS (SELECT s.tree, s.level AS sublevel, s.level + (SELECT max(level) FROM tv) AS top, s.h AS subroot FROM sub s),
climb AS (
  SELECT l.tree, l.idx AS leaf_idx, 0 AS level, CASE WHEN p.sublevel = 0 THEN l.tree ELSE l.idx END AS idx, start AS folded, '' AS proof, p.sublevel, p.top
  FROM l JOIN depth p ON l.tree = p.tree
  UNION ALL
  SELECT c.tree, c.leaf_idx, c.level + 1, CASE WHEN c.level + 1 = c.sublevel THEN c.tree ELSE c.idx // 8 END,
         sha256(array_to_string(list_concat(r.hs[:c.idx % 8], [c.folded], r.hs[c.idx % 8 + 2:]), '')),
         c.proof || array_to_string(list_concat(r.hs[:c.idx % 8], r.hs[c.idx % 8 + 2:]), ''), c.sublevel, c.top
  FROM climb c JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = c.idx // 8 WHERE c.level < c.top)
SELECT l.doc_id, l.leaf, p.subroot, (SELECT h FROM tv ORDER BY level DESC LIMIT 1) AS root, sha256(c.proof) AS proof_sha256,
       c.folded AS folded_root, c.folded = (SELECT h FROM tv ORDER BY level DESC LIMIT 1) AS verified
FROM l JOIN climb c ON c.tree = l.tree AND c.leaf_idx = l.idx JOIN depth p ON p.tree = l.tree WHERE c.level = c.top
"""
