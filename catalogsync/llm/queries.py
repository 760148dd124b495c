"""The registered queries of this subpackage: thin views of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

COUNT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _query(build: Query) -> Query:
    _REGISTRY[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalogsync.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), COUNT_TOKENIZER)


@_query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalogsync.llm.bpe import bpe_round_trip

    return bpe_round_trip(table(spark, sf_dir, "documents"), BPE_RANKS, public_tokenizers.PATTERN)


@_query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalogsync.llm.quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalogsync.llm.language_id import identify

    return identify(table(spark, sf_dir, "documents"))


@_query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalogsync.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


@_query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalogsync.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


@_query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalogsync.llm.pii import find_pii

    return find_pii(table(spark, sf_dir, "documents"))


@_query
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalogsync.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalogsync.llm.topk_search import top_k

    return top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


@_query
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalogsync.llm.lm_score import train_and_score

    return train_and_score(table(spark, sf_dir, "documents"))


@_query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalogsync.llm.divergence import audit

    return audit(table(spark, sf_dir, "documents"))


@_query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalogsync.llm.substring_dedup import drop_repeats

    return drop_repeats(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


@_query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catalogsync.llm.conversation_trie import shared_beginnings

    return shared_beginnings(table(spark, sf_dir, "conversations"))
