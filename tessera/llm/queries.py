"""Registered queries of the training-data operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import chat, decontaminate, embeddings, lexical, mixing, near_dedup, packing, quality, repeats, secret_scan, token_counts, toxicity, whitening
from tessera.llm.oracles import ORACLES
from tessera.llm.shared import documents, ship_package, written
from tessera.sources.tables import table

TOKENIZER = "byte_bpe_50k.json"
CHAT_BUDGET, CHAT_HISTORY = 512, 128


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7, whose texts hold control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = r"\### Assistant: </turn> ok"
    return turns.unionByName(spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], turns.schema))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digest(chat.format_chat(chat_turns(spark, sf_dir), budget=CHAT_BUDGET, history=CHAT_HISTORY))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = written(mixing.sizes(documents(spark, sf_dir)), "sizes")
    return mixing.taken(sized).select("doc_id", "size", "source_size", "target", "taken")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return whitening.whitened_embeddings(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_token_counts, op2_packing, op3_secret_scan, op4_toxicity, op5_substring_dedup, op6_near_dedup,
        op7_quality, op8_decontamination, op9_chat_format, op10_embedding_dedup, op11_lexical_search,
        op12_mixing, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
