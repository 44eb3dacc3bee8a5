"""The registered queries over the training-data operators, with oracle SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat, knn_quality, line_rules, mixing, packing, sharding, simhash, topk, url_rules, warc


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_report(_read(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(_read(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_read(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_quality.quality_report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_read(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.rules_report(_read(spark, sf_dir, "documents"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(_read(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_simhash, op3_warc, op4_quality, op5_urls, op6_packing, op7_rules, op8_topk, op9_sharding, op10_chat)}
ORACLE = {"op1_mixing": mixing.MIX_SQL, "op3_warc": warc.WARC_SQL, "op7_rules": line_rules.RULES_SQL, "op8_topk": topk.TOPK_SQL, "op10_chat": chat.CHAT_SQL}
