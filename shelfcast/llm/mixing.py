"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Each source's target: the weighted share of all words, at most ``cap`` times the
   source's own size, the excess reshared by weight (water filling in closed form).
2. ``floor(total / block)`` blocks go to sources by the highest quotients target / (2k - 1),
   then each source's blocks go to its shards the same way (integer quota per shard).
3. A shard is the circular word stream of its documents in seeded order.  Its quota of
   equal blocks is taken from a seeded block onward, all round as often as it takes; what a
   document gives is arithmetic on its word interval, so no row per block is ever made.

Defined results: null text has size 0 and gives 0; a null source is a source of its own and
ranks last; an empty table gives an empty result; repeated rows are separate documents; if
nothing has words, targets and takings are 0.  Extra columns are ignored.

Scale: one shuffle of (doc_id, source, size) rows by (source, shard); shards hold about
``shard_docs`` documents, so a source with a third of all rows is many shards.  Only
per-source rows (and, within a source, per-shard rows) meet in one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import carried, stage, white_words

WEIGHTS = (1, 2, 3)  # by rank of the source, repeating
CAP = 3              # a source gives at most so many times its size
BLOCK = 16           # words in a block
SHARD_DOCS = 4096    # documents in a shard, about
SEED = 17


def seeded_hex(value: Column, seed: int) -> Column:
    """md5 of ``value:seed`` (an order that SQL engines reproduce)."""
    return F.md5(F.concat_ws(":", F.coalesce(value.cast("string"), F.lit("null")), F.lit(str(seed))).cast("binary"))


def unit_interval(hexed: Column) -> Column:
    """The first 32 bits of a hex digest as a number in [0, 1)."""
    return F.conv(F.substring(hexed, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def sainte_lague(units: DataFrame, group: str, order: str, weight: str, seats: str) -> DataFrame:
    """``units`` plus ``quota``: the group's ``seats`` dealt by highest quotients weight / (2k - 1).

    With S units and N seats the final divisor lies between W/(N+S) and W/(N-S), so only
    the quotients in that range, about five per unit, are made and ranked.
    """
    g = W.partitionBy(group)
    share = (F.col(weight) / F.col("__w")) * F.col(seats)
    lean = (F.col("__s") + 1) / F.greatest(F.col(seats), F.lit(1))
    base = (units.withColumn("__w", F.sum(weight).over(g)).withColumn("__s", F.count(F.lit(1)).over(g))
            .withColumn("__q", F.when(F.col("__w") > 0, share).otherwise(F.lit(0.0)))
            .withColumn("__lo", F.greatest(F.lit(0), F.floor(F.col("__q") * (1 - lean) - 0.5)).cast("long"))
            .withColumn("__hi", (F.ceil(F.col("__q") * (1 + lean) + 0.5)).cast("long"))
            .withColumn("__left", F.col(seats) - F.sum("__lo").over(g)))
    some = base.filter((F.col("__hi") > F.col("__lo")) & (F.col(weight) > 0))
    ranked = (some.select(group, order, weight, "__left", F.explode(F.sequence(F.col("__lo") + 1, F.col("__hi"))).alias("__k"))
              .withColumn("__rank", F.row_number().over(
                  W.partitionBy(group).orderBy((F.col(weight) / (2 * F.col("__k") - 1)).desc(), F.col(order), F.col("__k"))))
              .filter(F.col("__rank") <= F.col("__left"))
              .groupBy(group, order).agg(F.count(F.lit(1)).alias("__more")))
    out = base.join(ranked, [group, order], "left").withColumn("quota", F.col("__lo") + F.coalesce(F.col("__more"), F.lit(0)))
    return out.drop("__w", "__s", "__q", "__lo", "__hi", "__left", "__more")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source: source, source_rank, source_size, n_docs, target (see the module)."""
    every = W.partitionBy(F.lit(0))  # one row per source
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("source_rank") - 1) % len(weights) + 1).cast("int"))
    before = W.partitionBy(F.lit(0)).orderBy("__ratio", "source_rank").rowsBetween(W.unboundedPreceding, -1)
    none = lambda c: F.coalesce(c, F.lit(0.0))
    left = (F.col("__t") - none(F.sum("__cap").over(before))) / (F.col("__w") - none(F.sum("__weight").over(before)))
    return (src.withColumn("source_rank", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())))
            .withColumn("__weight", weight.cast("double"))
            .withColumn("__cap", F.col("source_size").cast("double") * cap)
            .withColumn("__ratio", F.col("__cap") / F.col("__weight"))
            .withColumn("__t", F.sum("source_size").over(every).cast("double"))
            .withColumn("__w", F.sum("__weight").over(every))
            .withColumn("__level", left)
            .withColumn("__full", F.col("__ratio") <= F.col("__level"))
            .withColumn("__level", F.max(F.when(~F.col("__full"), F.col("__level"))).over(every))
            .withColumn("target", F.when(F.col("__full"), F.col("__cap")).otherwise(F.col("__weight") * F.col("__level")))
            .withColumn("target", F.coalesce("target", F.lit(0.0)))
            .select("source", "source_rank", "source_size", "n_docs", "target"))


def overlap(lo: Column, hi: Column, a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0), F.least(hi, b) - F.greatest(lo, a))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block: int = BLOCK,
        shard_docs: int = SHARD_DOCS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of ``docs`` (doc_id, text, source)."""
    sizes = stage(docs.select("doc_id", "source", F.size(white_words(F.col("text"))).cast("long").alias("size")), "mix-sizes")
    targets = source_targets(sizes, weights, cap)
    blocks = F.floor(F.sum("source_size").over(W.partitionBy(F.lit(0))) / block).cast("long")
    src = stage(sainte_lague(targets.withColumn("__all", F.lit(0)).withColumn("__n", blocks), "__all", "source_rank", "target", "__n")
                .select("source", "source_rank", "source_size", "target", F.col("quota").alias("source_quota"),
                        F.ceil(F.col("n_docs") / shard_docs).cast("long").alias("n_shards")), "mix-sources")
    keyed = (sizes.join(src, sizes["source"].eqNullSafe(src["source"]))
             .select(sizes["doc_id"], sizes["source"], "size", "source_rank", "source_size", "target", "source_quota", "n_shards",
                     seeded_hex(sizes["doc_id"], seed).alias("__key"))
             .withColumn("shard", F.floor(unit_interval(F.col("__key")) * F.col("n_shards")).cast("long"))
             .withColumn("__key", F.substring("__key", 9, 24)))
    shards = (keyed.groupBy("source_rank", "shard", "source_quota")
              .agg(F.sum("size").alias("shard_size")))
    start_hex = F.md5(F.concat_ws(":", F.col("source_rank").cast("string"), F.col("shard").cast("string"), F.lit(str(seed))).cast("binary"))
    n = F.col("shard_size")
    quotas = (sainte_lague(shards, "source_rank", "shard", "shard_size", "source_quota")
              .withColumn("words", F.least(F.col("quota"), F.floor(n * cap / block)).cast("long") * block)
              .withColumn("passes", F.when(n > 0, F.floor(F.col("words") / n)).otherwise(F.lit(0)).cast("long"))
              .withColumn("arc", F.col("words") - F.col("passes") * n)
              .withColumn("first", (F.floor(unit_interval(start_hex) * F.floor(n / block)) * block).cast("long"))
              .select("source_rank", "shard", "shard_size", "passes", "arc", "first"))
    stream = W.partitionBy("source_rank", "shard").orderBy("__key", "doc_id", "size")
    placed = keyed.withColumn("hi", F.sum("size").over(stream.rowsBetween(W.unboundedPreceding, 0))).withColumn("lo", F.col("hi") - F.col("size"))
    stop = F.col("first") + F.col("arc")
    given = overlap(F.col("lo"), F.col("hi"), F.col("first"), F.least(stop, n)) + overlap(F.col("lo"), F.col("hi"), F.lit(0), stop - n)
    return placed.join(quotas, ["source_rank", "shard"]).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("passes") * F.col("size") + given).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as mixed: every row as often as the mix takes it (nearest whole number), all columns kept."""
    taken = mix(docs.select("doc_id", "text", "source"), **options)
    copies = F.when(F.col("size") > 0, F.floor((F.col("taken") / F.col("size")) + 0.5)).otherwise(0).cast("long")
    wanted = stage(taken.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), copies.alias("c"))
                   .groupBy("__id", "__source", "__size").agg(F.sum("c").alias("__copies"), F.count(F.lit(1)).alias("__rows")).filter("__copies > 0"), "mix-copies")
    rows = docs.select(carried(docs).alias("__row"), F.col("doc_id").alias("__d"), F.col("source").alias("__s"),
                       F.size(white_words(F.col("text"))).cast("long").alias("__n"))
    met = rows.join(wanted, F.col("__d").eqNullSafe(F.col("__id")) & F.col("__s").eqNullSafe(F.col("__source")) & (F.col("__n") == F.col("__size")))
    # rows that share doc_id, source and size share their copies
    same = W.partitionBy("__d", "__s", "__n").orderBy(F.xxhash64("__row"))
    each = F.floor(F.col("__copies") / F.col("__rows")) + (F.row_number().over(same) <= F.col("__copies") % F.col("__rows")).cast("long")
    return (met.withColumn("__each", each.cast("int")).filter("__each > 0")
            .select(F.explode(F.array_repeat("__row", F.col("__each"))).alias("__row")).select("__row.*"))
