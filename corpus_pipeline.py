"""Training corpus pipeline: quality, near duplicates, benchmark leaks, source mix, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
below ``spark.checkpoint.dir`` and read again as the next stage's ``docs``.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import decontaminate, mixing, near_dups, quality, sharding
from shelfcast.llm.common import stage, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.reject(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dups.dedup(docs)


def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken (some repeatedly) until each source has its target share of words."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents get a shard and a slot; the operator also writes them by shard."""
    return sharding.external_shuffle(docs)


STAGES = [
    ("quality", keep_good),
    ("near_dups", keep_one_of_each),
    ("decontaminate", keep_unleaked),
    ("mix", mix_sources),
    ("shard", shard),
]

# the fitted classifier and the near-duplicate classes have no SQL form: tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
