"""A training corpus from raw documents: stages that each read what the one before has kept.

Language identification drops what has no language, exact and near-duplicate
removal leave one document of each group, mixing takes the documents of each
source as often as its target asks for, and the last stage encodes and decodes
what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from catalogsync.llm.bpe import bpe_round_trip
from catalogsync.llm.common import crc_mod, stage
from catalogsync.llm.exact_dedup import keep_one
from catalogsync.llm.language_id import keep_identified, language_profiles
from catalogsync.llm.mixing import apply_mix
from catalogsync.llm.near_dedup import keep_representatives
from catalogsync.llm.queries import BPE_RANKS


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter go."""
    return keep_identified(docs, language_profiles(docs.where(crc_mod("doc_id", 4) != 2)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_representatives(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the targets of their sources take them."""
    return apply_mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded documents."""
    return bpe_round_trip(docs, BPE_RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("byte_bpe", byte_bpe),
]

# The first stage is a learnt model, so SQL cannot express the rows of run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
