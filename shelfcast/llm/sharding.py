"""Sharding by a two-pass external shuffle.

Pass 1 scatters records into memory-sized buckets: the shard by rendezvous hashing of
doc_id (law ``key``: doc_id and the shard count decide, one more shard only takes rows into
itself), the bucket within the shard by a seeded hash of doc_id and text.  The number of
buckets follows from the table's bytes, so a bucket stays near ``bucket_bytes``.
Pass 2 puts each bucket in a fixed order, shuffles it (Spark's ``shuffle`` is a
Fisher-Yates walk) and writes it; slots run on from bucket to bucket of a shard.

Defined results: null text counts no bytes and has crc 0; null doc_ids share a shard;
repeated rows are kept, each with a slot of its own; an empty table gives no shards; input
columns named like the operator's own outputs are replaced by them.

Scale: text moves once.  Groups of equal texts are spread by doc_id, so a text that a third
of all rows hold is no hot bucket.  Shard offsets come from one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import carried, stage

SHARDS = 40
BUCKET_BYTES = 16 << 20
ROW_BYTES = 16
SEED = 23
OUTPUTS = ("shard", "slot", "grown_shard")


def rendezvous(doc_id: Column, shards: int, seed: int) -> tuple[Column, Column]:
    """Highest seeded hash of the id over all shards, and the winning shard."""
    hashes = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.xxhash64(doc_id, s, F.lit(seed)))
    return F.array_max(hashes), hashes


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def external_shuffle(docs: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, text, ...) plus shard, slot and grown_shard, as a written table partitioned by shard."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(record_size(F.col("text")))).first()[0] or 0
    subs = max(1, -(-total // (bucket_bytes * shards)))  # buckets per shard
    last = F.xxhash64(F.col("__id"), F.lit(shards), F.lit(seed))
    records = (docs.select(carried(docs, OUTPUTS).alias("row"), F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
               .withColumn("hashes", rendezvous(F.col("__id"), shards, seed)[1])
               .withColumn("top", F.array_max("hashes"))
               .select("row",
                       (F.array_position("hashes", F.col("top")) - 1).cast("int").alias("shard"),
                       F.when(last > F.col("top"), F.lit(shards)).otherwise(F.array_position("hashes", F.col("top")) - 1).cast("int").alias("grown_shard"),
                       F.xxhash64("__id", "__text", F.lit(seed + 1)).alias("key"))
               .withColumn("sub", F.pmod(F.xxhash64("key", F.lit(seed + 2)), F.lit(subs)).cast("int")))
    bucket = ["shard", "sub"]
    width = max(shards * subs, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = (records.repartition(width, *bucket)
               .groupBy(*bucket).agg(F.sort_array(F.collect_list(F.struct("key", "grown_shard", "row"))).alias("members"))
               .sortWithinPartitions(*bucket)
               .select(*bucket, F.shuffle("members", seed).alias("members")))
    # slots: where each bucket of a shard begins (one row per bucket)
    counts = records.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("sub").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = (buckets.join(starts, bucket)
              .select("shard", "start", F.posexplode("members").alias("pos", "m"))
              .select("m.row.*", (F.col("start") + F.col("pos")).cast("long").alias("slot"),
                      F.col("m.grown_shard").alias("grown_shard"), "shard"))
    return stage(placed.sortWithinPartitions("shard", "slot"), "shards", ("shard",))


def digest(sharded: DataFrame) -> DataFrame:
    """The check columns of a sharded table: sizes, text crc, law, shard, slot, shard among one more."""
    return sharded.select(
        "doc_id", record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot", "grown_shard")
