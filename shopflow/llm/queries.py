"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm import (
    bpe_codec,
    conversation_repair,
    decontamination,
    exact_dedup,
    language_id,
    near_dedup,
    prefix_forest,
    ranked_search,
    sharding,
    substring_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from shopflow.llm.common import in_training, table

#: the tokenizer file of op3 and op9, and the longest sequence op9 allows
TOKENIZER = "byte_bpe_50k.json"
MOST_TOKENS = 1024
#: production shard names of op1
SHARDS = [f"shard-{i:03d}" for i in range(64)]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    sized = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    return sharding.place(sized, "doc_id", SHARDS).select("doc_id", "slot", "shard", "n_bytes")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = substring_dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return stripped.select("doc_id", "n_words", "n_removed",
                           F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe_codec.round_trip(docs, public_tokenizers.path(TOKENIZER)).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.language_model(docs)
    classifier = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), model)
    scored = toxicity.score(docs, model, classifier)
    return scored.select("doc_id", (~in_training(F.col("doc_id"))).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontamination.leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.query(spark, sf_dir)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = language_id.predict(docs.select("doc_id", "text"), language_id.train(docs))
    return found.select("doc_id", (~in_training(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path(TOKENIZER))
    return counted.withColumn("over_limit", F.col("n_tokens") > MOST_TOKENS)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classify(table(spark, sf_dir, "documents", "doc_id", "text"), size=3, percent=85)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents", "doc_id", "text"),
                                table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", F.col("embedding").alias("vec"))
    return prefix_forest.search(vectors, F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_url_filter": op6_url_filter,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_language_id": op8_language_id,
    "op9_token_counts": op9_token_counts,
    "op10_near_dedup": op10_near_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_prefix_forest": op13_prefix_forest,
}
ORACLE_SQL: dict[str, str] = {
    "op6_url_filter": url_filter.ORACLE,
    "op7_exact_dedup": exact_dedup.ORACLE,
    "op11_ranked_search": ranked_search.ORACLE,
    "op12_conversation_repair": conversation_repair.ORACLE,
}
