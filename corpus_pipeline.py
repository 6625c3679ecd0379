"""A training corpus from ``documents``: five stages, each written as Parquet before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from almsflow.llm import decontaminate, language, mixing, neardup, shards
from almsflow.runtime import cut_lineage

#: At least so many shards, and as many more as keep a shard near the target.
SHARDS = 24
TARGET_BYTES = 256_000_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told, or whose text speaks clearly against their label, go; a missing label is filled in."""
    return language.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five words, similarity 0.8)."""
    return neardup.drop_near_duplicates(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark passages go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.copies(docs, mixing.plan(docs)).drop("mix_copy", "mix_shard")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their place in it.

    The tree cuts along draws from the text, so every shard has the mix's shares, equal texts share a shard,
    and the order inside is hashed, so that copies do not stand side by side.
    """
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + shards.ROW_BYTES
    total = docs.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    return shards.with_shards(docs, max(SHARDS, shards.shards_for(total, TARGET_BYTES)), shards.mixing_dims(), shuffled=True)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mixing_stage), ("sharding", sharding)]

#: Learning, hashing and drawing have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
