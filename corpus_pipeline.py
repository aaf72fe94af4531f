"""The corpus pipeline: documents to training token ids in five stages.

Quality rules, quality classifier, near duplicates, mixing, and encoding. Each
stage takes (spark, docs, sf_dir) and works on all that its predecessor kept;
its result is written as Parquet and read back as the next one's input. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featureflow.llm import byte_bpe, jaccard_join, mixing, quality_rules, weak_quality
from featureflow.llm.common import stored, table
from featureflow.llm.queries import default_vocabulary


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host passes."""
    return quality_rules.keep_good(docs)


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised scorer holds to be good."""
    return weak_quality.keep_good(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the least id, of each group linked at 80 % of 5-word shingles."""
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, sources near their target weights."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded bytes."""
    return byte_bpe.digests(docs, default_vocabulary(spark), with_ids=True)


STAGES = [
    ("quality_rules", keep_by_rules),
    ("quality_classifier", keep_by_classifier),
    ("near_duplicates", keep_one_of_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

# The classifier's fit is not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
