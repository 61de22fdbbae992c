"""The queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scrubline.llm import (
    chat,
    hosts,
    licences,
    mixing,
    near_vectors,
    oracles,
    pieces,
    quality,
    resampling,
    sharding,
    simhash,
    spelling,
    templates,
    topk,
)
from scrubline.llm.tables import table


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract(table(spark, sf_dir, "pages"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judged(table(spark, sf_dir, "documents"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_page_text": op1,
    "op2_exact_top_k": op2,
    "op3_chat_repair": op3,
    "op4_licence_scan": op4,
    "op5_embedding_near_duplicates": op5,
    "op6_mix_sources": op6,
    "op7_pieces": op7,
    "op8_shards": op8,
    "op9_quality": op9,
    "op10_simhash_near_duplicates": op10,
    "op11_host_rules": op11,
    "op12_spelling_variants": op12,
    "op13_importance_resampling": op13,
}

# The others rest on hashes, fitted models or a tokenizer that SQL does not have.
ORACLES = {
    "op1_page_text": oracles.PAGE_TEXT,
    "op2_exact_top_k": oracles.TOP_K,
    "op5_embedding_near_duplicates": oracles.NEAR_VECTORS,
    "op11_host_rules": oracles.HOST_RULES,
    "op12_spelling_variants": oracles.SPELLING,
    "op13_importance_resampling": oracles.RESAMPLING,
}
