"""Registered queries of the training-data operators: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, chat, decontaminate, html, katz, line_dedup, merkle, mixing, near_dups, packing, quality, sharding
from .common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item against every document: one row per finding."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document; texts with crc32(doc_id) mod 7 = 2 are held out."""
    return katz.score_documents(table(spark, sf_dir, "documents"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every row whose vec_id is divisible by 50, against all other rows."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.classes(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(sharding.external_shuffle(table(spark, sf_dir, "documents")))


def op11_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json")))


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))[0]


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, audited with every row whose id's crc32 3 divides tampered."""
    return merkle.manifest(table(spark, sf_dir, "documents"), *merkle.tampered())


def registry() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_decontaminate, op2_katz, op3_mix, op4_line_dedup, op5_shard, op6_chat, op7_ann, op8_quality,
                                    op9_near_dups, op10_html, op11_pack, op12_align, op13_merkle)}
