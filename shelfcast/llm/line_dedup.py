"""Line dedup by a log-template tree.

Every line is parsed to a fixed depth: token count, then the first ``LEADING`` tokens, with
tokens that hold a digit masked as variable fields.  Lines of a leaf share a template when at
least ``SIMILARITY`` of their tokens equal the leaf's commonest token at that place; the rest are
variable fields.  Lines left over are grouped by the token they most share and meet their own
group's shape, until no group has two documents.  Other lines are templates of their own (masked text).  A template that occurs
in two documents or more is recurring: its lines stay in the first document that holds it
(least doc_id) and are dropped from all others.  Lines of under ``MIN_TOKENS`` tokens are
compared by masked text only.

Defined results: null text stays null with no lines; blank lines are never dropped; repeats of
a line inside its first document stay; equal rows (doc_id and text) are one document here, so
each keeps or loses the same lines; null doc_ids rank last; an empty table gives an empty
result.  Input columns named like the outputs are replaced, other columns are ignored.

Scale: texts are parsed once, to line digests (hashes, no text; 4 bytes a token), which move through partial
aggregates; only lines of leaves that hold different lines of different documents move with their token
hashes, one of each; the text moves once, to be joined with its dropped positions.  A line that a third of all documents
hold is one row after partial aggregation, and its digests meet it in a join that AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, bound, small, stage

LEADING = 3
SIMILARITY = 0.8
MIN_TOKENS = 5
BROADCAST_ROWS = 500_000  # leaf hashes (8 bytes a row)
FIELD = "<*>"
# a token that holds a digit, from its first character on (possessive: linear in the line)
FIELD_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


def masked_tokens(line: Column) -> Column:
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, FIELD_TOKEN, FIELD)).otherwise(line)
    return F.array_remove(F.split(masked, WHITE), "")


def _digest(line: Column) -> Column:
    """Token count, leaf, masked-text hash and (from MIN_TOKENS on) token hashes of a line."""
    return bound(masked_tokens(line), lambda t: F.struct(
        F.size(t).alias("n"),
        F.xxhash64(F.size(t), *[F.coalesce(F.get(t, F.lit(i)), F.lit("")) for i in range(LEADING)]).alias("leaf"),
        F.xxhash64(t).alias("mask"),
        F.when(F.size(t) >= MIN_TOKENS, F.transform(t, lambda x: F.hash(x))).alias("tokens")))


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text", F.lit(7)).alias("key"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def _merged(lines: DataFrame) -> DataFrame:
    """l, m, shared (template) of the lines (leaf, mask, n, tokens, lo, hi, group) that share a shape with others.

    Lines that do not meet their group's shape are grouped again by the token of theirs that most
    of the group's other such lines share; a place more is equal in a group each time, so this ends.
    """
    out, placed = None, ("group", "place", "token")
    while True:
        common = (lines.select("group", F.posexplode("tokens").alias("place", "token")).groupBy(*placed).agg(F.count(F.lit(1)).alias("c"))
                  .groupBy("group", "place").agg(F.max_by("token", F.struct("c", "token")).alias("token"))
                  .groupBy("group").agg(F.sort_array(F.collect_list(F.struct("place", "token"))).alias("shape")))  # a line long
        equal = F.size(F.filter(F.zip_with("tokens", "shape", lambda a, b: a == b["token"]), lambda x: x))
        met = stage(lines.join(common, "group").withColumn("alike", equal >= F.ceil(F.col("n") * SIMILARITY - 1e-9)).drop("shape"), "shape-lines")
        found = met.filter("alike").select(F.col("leaf").alias("l"), F.col("mask").alias("m"), F.xxhash64("group", F.lit("shape")).alias("shared"))
        out = found if out is None else out.unionByName(found)
        rest = met.filter("not alike").drop("alike")
        each = rest.select("group", "mask", "lo", "hi", F.posexplode("tokens").alias("place", "token"))
        held = (each.groupBy(*placed).agg(F.count(F.lit(1)).alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
                .filter("c > 1 and lo <> hi").drop("lo", "hi")
                .join(rest.groupBy("group").agg(F.count(F.lit(1)).alias("total")), "group"))
        best = F.max(F.when(F.col("c") < F.col("total"), F.struct("c", -F.col("place"), "token")))
        support = each.join(held, list(placed)).groupBy("group", "mask").agg(F.count(F.lit(1)).alias("places"), best.alias("best"))
        # two lines of one shape agree in 2 x SIMILARITY - 1 of their places
        again = (rest.join(support, ["group", "mask"]).filter("best is not null").filter(F.col("places") >= F.ceil(F.col("n") * (2 * SIMILARITY - 1) - 1e-9))
                 .withColumn("group", F.xxhash64("group", "best")).select(*lines.columns))
        again = stage(again, "lines-left")
        several = (again.groupBy("group").agg(F.count(F.lit(1)).alias("g"), F.min("lo").alias("x"), F.max("hi").alias("y"))
                   .filter("g > 1 and x <> y").select("group"))
        lines = stage(again.join(several, "group", "left_semi"), "mixed-lines")
        if lines.limit(1).count() == 0:
            return out


def templates(docs: DataFrame) -> DataFrame:
    """doc_id, key, pos, n, template of every line that is not blank."""
    digests = stage(_lines(docs).select("doc_id", "key", "pos", _digest(F.col("line")).alias("d")).select("doc_id", "key", "pos", "d.*").filter("n > 0"), "line-digests")
    by_mask = digests.filter(F.col("n") >= MIN_TOKENS).groupBy("leaf", "mask").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    mixed = stage(by_mask.groupBy("leaf").agg(F.count(F.lit(1)).alias("m"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
                  .filter("m > 1 and lo <> hi").select(F.col("leaf").alias("mixed")), "mixed-leaves")
    mixed = F.broadcast(mixed) if small(mixed, BROADCAST_ROWS) else mixed
    again = (digests.filter(F.col("n") >= MIN_TOKENS).join(mixed, F.col("leaf") == F.col("mixed"), "left_semi")
             .select("leaf", "mask", "n", "tokens").dropDuplicates(["leaf", "mask"]))
    merged = _merged(stage(again.join(by_mask, ["leaf", "mask"]).withColumn("group", F.col("leaf")), "mixed-lines"))
    return digests.join(merged, (F.col("leaf") == F.col("l")) & (F.col("mask") == F.col("m")), "left").select(
        "doc_id", "key", "pos", "n", F.coalesce("shared", F.xxhash64("leaf", "mask")).alias("template"))


def dropped_positions(docs: DataFrame) -> DataFrame:
    """doc_id, key, drops (line positions) of every document that loses lines."""
    lines = stage(templates(docs), "line-templates")
    document = F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id").alias("id"), F.col("key").alias("key"))
    per_doc = lines.groupBy("template", "n", "doc_id", "key").agg(F.lit(1).alias("one"))
    recurring = (per_doc.groupBy("template", "n").agg(F.count(F.lit(1)).alias("docs"), F.min(document).alias("first"))
                 .filter("docs >= 2")
                 .select(F.col("template").alias("t"), "first.id", F.col("first.key").alias("first_key")))
    lost = lines.join(recurring, F.col("template") == F.col("t")).filter(~(F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("first_key"))))
    return lost.groupBy("doc_id", "key").agg(F.collect_set("pos").alias("drops"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text (without recurring lines), n_lines, n_dropped for every row of ``docs``."""
    rows = docs.select("doc_id", "text")
    drops = dropped_positions(rows).select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "drops")
    met = (rows.withColumn("key", F.xxhash64("text", F.lit(7)))
           .join(drops, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
           .withColumn("drops", F.coalesce("drops", F.array().cast("array<int>"))))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("drops"), i)), "\n")
    return met.select("doc_id", F.when(F.size("drops") == 0, F.col("text")).otherwise(kept).alias("text"),
                      F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
                      F.size("drops").cast("long").alias("n_dropped"))
