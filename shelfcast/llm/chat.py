"""Chat formatting with cumulative-snapshot collapse.

Logged conversations often repeat an earlier log with more turns.  Every turn gets the
rolling hash of the turns up to it; a conversation whose whole hash is a turn-prefix hash of a
longer one is dropped by an anti-join, equal conversations keep the least id, and the maximal
ones are rendered.

The rolling hash is a running XOR of 64-bit hashes of (position, role, text), taken twice with
different seeds: XOR joins partial results, so a very long conversation is cut into blocks
of ``BLOCK_TURNS`` and no single task walks it.

Defined results: turns are ordered by turn (nulls last), role, text hash; null roles and texts
are values of their own and render as empty; turns with a null conv_id are one conversation
with a null id, which ranks last among equals; repeated rows are turns; an empty table gives
an empty result.  Extra columns are ignored.

Scale: hashes move without texts; (position, hash) prefixes are distinct before the anti-join,
so a first turn that a third of all conversations share is one row; texts move once, for the
conversations that stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage

BLOCK_TURNS = 1024
# fixed values: markers of the rendered form
OPEN, AFTER_ROLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _key() -> Column:
    return F.coalesce(F.col("conv_id").cast("string"), F.lit(""))


def _marked(value: Column) -> Column:
    """Null and empty differ."""
    return F.coalesce(F.concat(F.lit("="), value), F.lit("-"))


def _turn_hash() -> Column:
    return F.xxhash64(_marked(F.col("role")), _marked(F.col("text")))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """c, conv_id, pos (from 1), a, b (rolling hashes up to pos), n (turns of the conversation)."""
    rows = stage(turns.select(_key().alias("c"), "conv_id", F.col("turn").isNull().alias("late"), "turn", "role", _turn_hash().alias("h"),
                              F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(2**62)).cast("long").alias("block")), "turns")
    inside = W.partitionBy("c", "block").orderBy("late", "turn", F.col("role").asc_nulls_first(), "h")
    blocks = W.partitionBy("c").orderBy("block")
    earlier = blocks.rowsBetween(W.unboundedPreceding, -1)
    sizes = rows.groupBy("c", "block").agg(F.count(F.lit(1)).alias("m"))
    starts = sizes.select("c", "block", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("start"),
                          F.sum("m").over(W.partitionBy("c")).alias("n"))
    placed = (rows.withColumn("i", F.row_number().over(inside)).join(starts, ["c", "block"])
              .withColumn("pos", (F.col("start") + F.col("i")).cast("long"))
              .withColumn("x", F.xxhash64("pos", "h")).withColumn("y", F.xxhash64("h", "pos", F.lit(1))))
    sums = placed.groupBy("c", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    zero = F.lit(0).cast("long")
    before = sums.select("c", "block", F.coalesce(F.bit_xor("x").over(earlier), zero).alias("x0"), F.coalesce(F.bit_xor("y").over(earlier), zero).alias("y0"))
    running = W.partitionBy("c", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    return (placed.join(before, ["c", "block"])
            .select("c", "conv_id", "pos", "n", F.col("x0").bitwiseXOR(F.bit_xor("x").over(running)).alias("a"),
                    F.col("y0").bitwiseXOR(F.bit_xor("y").over(running)).alias("b")))


def maximal(turns: DataFrame) -> DataFrame:
    """c, conv_id, n_turns, n_equal (conversations equal to it) of the conversations that prefix no longer one."""
    hashed = stage(prefix_hashes(turns), "prefixes")
    order = F.struct(F.col("conv_id").isNull(), F.col("conv_id"))
    whole = (hashed.filter("pos = n").groupBy("pos", "a", "b")
             .agg(F.min_by(F.struct("c", "conv_id"), order).alias("k"), F.count(F.lit(1)).alias("n_equal")))
    inner = hashed.filter("pos < n").select("pos", "a", "b").distinct()
    return whole.join(inner, ["pos", "a", "b"], "left_anti").select("k.c", "k.conv_id", F.col("pos").alias("n_turns"), "n_equal")


def render(turns: Column) -> Column:
    one = lambda t: F.concat(F.lit(OPEN), F.coalesce(t["role"], F.lit("")), F.lit(AFTER_ROLE), F.coalesce(t["text"], F.lit("")), F.lit(CLOSE))
    return F.array_join(F.transform(turns, one), "")


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_equal, text (rendered) of every maximal conversation."""
    kept = stage(maximal(turns), "maximal")
    rows = turns.select(_key().alias("c"), F.struct(F.col("turn").isNull().alias("late"), "turn", "role", _turn_hash().alias("h"), "text").alias("t"))
    chats = rows.join(kept, "c").groupBy("c", "conv_id", "n_turns", "n_equal").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return chats.select("conv_id", "n_turns", "n_equal", render(F.col("ts")).alias("text"))
