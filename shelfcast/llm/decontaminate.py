"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

An item is found in a document when at least ``threshold`` of the item's distinct 5-word
shingles (lower-cased runs of letters and digits) occur in the document.  An item of one to four words
is one shingle of its own length: it is found where its words follow each other.

1. An item is a distinct normalised text (``item``, its md5): ids only name it in the report.
   Items are partitioned by shingle count (powers of two).  Each item's sketch is its
   bottom-k MinHash: the k shingles with the smallest hashes, with k = 2 m + 2, where m is the
   number of shingles that the largest item of the partition may miss.  An item that reaches
   the threshold misses at most m, so at least k - m of its sketch is in the document:
   candidates lose nothing, whatever the document's length.
2. Documents' shingle hashes meet the sketches in a hash join; (document, item) pairs with
   too few sketch hits go.
3. Candidates' documents are shingled again and counted against all shingles of their items:
   the exact containment decides.

Defined results: a document shorter than an item's shingles can't hold it, a null or empty one holds
nothing; null items and items without words are found nowhere; items of equal text are found each; every text of an item_id is found on
its own, and so are texts without an id (reported with a null item_id); repeated document
rows are reported once per (doc_id, item_id), with the largest containment if texts differ;
a null doc_id is reported as such.  Extra columns are ignored.

Scale: the item side is broadcast only after its rows were counted (``BROADCAST_ROWS``),
else it is shuffled, where AQE splits a shingle that many documents hold.  Documents are
exploded only into the join; nothing is grouped before the hits are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound, normal_words, small, stage, window_hashes

SHINGLE = 5
THRESHOLD = 0.8
BROADCAST_ROWS = 500_000  # of (item, hash) pairs, item ids or candidate documents: 16 to 40 bytes a row


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small(df, BROADCAST_ROWS) else df


def item_key() -> Column:
    """Key of the normalised text of a benchmark row."""
    return F.unhex(F.md5(F.array_join(normal_words(F.col("text")), " ").cast("binary")))


def item_shingles(items: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """item (key of a distinct text), size (words of its shingles), h, n (distinct shingles), need (hits that the threshold takes), in_sketch, sketch_need."""
    worded = (items.select(item_key().alias("item"), "text").groupBy("item").agg(F.min("text").alias("text"))
              .select("item", normal_words(F.col("text")).alias("words")).withColumn("size", F.least(F.size("words"), F.lit(k))).filter("size > 0"))
    windows = F.coalesce(*[F.when(F.col("size") == size, window_hashes(F.col("words"), size)) for size in range(k, 0, -1)])
    hashed = worded.select("item", "size", F.array_distinct(windows).alias("hs")).withColumn("n", F.size("hs"))
    upper = F.pow(F.lit(2.0), F.ceil(F.log2("n")))  # largest item of the size partition
    may_miss = F.floor(upper * (1 - threshold) + 1e-9).cast("int")
    ranked = (hashed.withColumn("need", F.ceil(F.col("n") * threshold - 1e-9).cast("int"))
              .withColumn("sketch", F.least(F.col("n"), 2 * may_miss + 2))
              .withColumn("sketch_need", F.greatest(F.lit(1), F.col("sketch") - (F.col("n") - F.col("need"))))
              .select("item", "size", "n", "need", "sketch", "sketch_need", F.posexplode(F.sort_array("hs")).alias("rank", "h")))
    return ranked.select("item", "size", "h", "n", "need", (F.col("rank") < F.col("sketch")).alias("in_sketch"), "sketch_need")


def document_shingles(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """(doc_id, key, h) of every window of one of the ``sizes``."""
    windows = bound(normal_words(F.col("text")), lambda w: F.concat(*[window_hashes(w, size) for size in sizes]))
    return docs.select("doc_id", "key", F.explode(windows).alias("h"))


def contamination(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """doc_id, key (md5 of the text), item, n_shingles, n_shared, containment of every finding."""
    keyed = docs.select("doc_id", "text", F.md5(F.col("text").cast("binary")).alias("key"))
    shingles = stage(item_shingles(items, threshold, k), "benchmark-shingles")
    sizes = sorted(r[0] for r in shingles.select("size").distinct().collect()) or [k]  # at most k rows
    sketches = shingles.filter("in_sketch").select("item", "h", "sketch_need")
    hits = document_shingles(keyed, sizes).join(_maybe_broadcast(sketches), "h")
    candidates = stage(hits.groupBy("doc_id", "key", "item", "sketch_need").agg(F.countDistinct("h").alias("hits"))
                       .filter("hits >= sketch_need").select("doc_id", "key", "item"), "candidates")
    wanted = candidates.select(F.col("key").alias("wanted")).distinct()
    again = keyed.join(_maybe_broadcast(wanted), F.col("key") == F.col("wanted"), "left_semi")
    texts = again.groupBy("key").agg(F.min("text").alias("text")).withColumn("doc_id", F.lit(None))
    found = (document_shingles(texts, sizes).select("key", "h").distinct()
             .join(_maybe_broadcast(shingles.select("item", "h", "n", "need")), "h")
             .groupBy("key", "item", "n", "need").agg(F.count(F.lit(1)).alias("n_shared"))
             .filter("n_shared >= need"))
    return candidates.join(found, ["key", "item"]).select(
        "doc_id", "key", "item", F.col("n").cast("long").alias("n_shingles"), F.col("n_shared").cast("long").alias("n_shared"),
        (F.col("n_shared") / F.col("n")).alias("containment"))


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per (doc_id, item_id) found, with the exact containment."""
    best = F.max_by(F.struct("n_shingles", "n_shared", "containment"), F.struct("containment", "n_shared"))
    ids = stage(items.select(item_key().alias("item"), "item_id").distinct(), "benchmark-ids")
    return (contamination(docs, items, threshold).join(_maybe_broadcast(ids), "item").groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", "b.*"))


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose text holds no benchmark item; all columns stay."""
    bad = stage(contamination(docs, items, threshold).select(F.col("key").alias("__bad")).distinct(), "contaminated")
    return docs.join(_maybe_broadcast(bad), F.md5(docs["text"].cast("binary")) == F.col("__bad"), "left_anti")
