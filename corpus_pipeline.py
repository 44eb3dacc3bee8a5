"""A training corpus from ``documents`` in five stages, each written as Parquet and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm import knn_quality, line_rules, mixing, near_dedup, packing
from galley.llm.staging import made, remove, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not depleted by cross-document lines, without these lines."""
    return line_rules.keep_good(docs).withColumn("n_chars", F.length("text").cast("long"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled documents vote to be good."""
    return knn_quality.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.near_dedup(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mix(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

#: No SQL expresses the classifier, the similarity search or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  What a stage has written for itself, and its input, is removed
    when its result lies in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = set(made(spark))
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        remove(spark, [path for path in made(spark)[:-1] if path not in before])
    return docs
