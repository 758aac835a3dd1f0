"""Merkle dataset manifest with octopus multiproofs.

Every row is a leaf, the hash of its length-prefixed columns.  Leaves of a language, by doc_id,
form a tree of runs of ``FANOUT`` nodes; the languages' roots form the tree of the dataset.

1. Rows are hashed by SQL functions (the text is read once and never moves) and dealt by range
   of (lang, doc_id, leaf) into leaf partitions of about ``PART_LEAVES`` rows; counts of the
   partitions give every leaf its position without a global window.
2. The node table: each level groups the one below by (tree, position / FANOUT).
3. Octopus: a leaf partition holds some positions of some trees.  The nodes its proofs need and
   that it can't derive from its own leaves are the minimal union of missing coordinates:
   at each level the other members of the runs that hold a derived node.
   All partitions' coordinates meet the node table in one join.
4. Each partition derives the interior nodes its leaves share, once, from its own leaves and the
   fetched nodes, and expands the single proofs from them: siblings level by level via the
   language's root to the dataset's root, and the root folded from a (perhaps altered) leaf.

Defined results: a null value is coded as ``-``; null doc_ids come first, rows of one doc_id go by
leaf hash, equal rows are leaves of their own (which of them comes first makes no difference);
a null lang is a language of its own, the first; a dataset of one row is its own root, with an
empty proof; an empty table gives an empty result.  Extra columns are ignored.

Scale: a hot language is many leaf partitions; what moves is two digests and the ids of a row
(about 150 bytes), and per partition at most 2 x (FANOUT - 1) nodes a level and tree.  A task holds
one leaf partition.  The node table has as many jobs as a tree has levels (log8 of the rows).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stage

FANOUT = 8            # nodes of a run
PART_LEAVES = 32_768  # leaves of a partition, about
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# fixed values: the alphabet that tampering lower-cases
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ------------------------------------------------------------------ leaves and positions

def _coded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column) -> Column:
    """Hex digest of a row's coded columns, with ``text`` in the place of its text."""
    return F.sha2(F.concat(*[_coded(text if c == "text" else F.col(c)) for c in COLUMNS]), 256)


def leaves(docs: DataFrame, altered: Column, change: Column) -> DataFrame:
    """Staged (doc_id, lang, leaf, shown, rid); ``shown``: the leaf of the text ``change`` where ``altered``, else the leaf."""
    return stage(docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), leaf_hash(F.col("text")).alias("leaf"),
        F.when(altered, leaf_hash(change)).alias("shown"), F.monotonically_increasing_id().alias("rid"))
        .withColumn("shown", F.coalesce("shown", "leaf")), "merkle-leaves")


def positions(rows: DataFrame, tree: list[str], order: list[str]) -> DataFrame:
    """``rows`` plus part (leaf partition), pos (place in the row's tree) and n (the tree's leaves).

    Dealt by range of (tree, order), which must tell all rows of a tree apart (ties are hot rows).
    """
    keys = [F.col(c).asc_nulls_first() for c in (*tree, *order)]
    parts = max(1, -(-rows.count() // PART_LEAVES))
    ranged = stage(rows.repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id()), "merkle-ranged")
    held = ranged.groupBy("part", *tree).agg(F.count(F.lit(1)).alias("own"))
    of_tree = Window.partitionBy(*tree)
    starts = held.withColumn("start", F.sum("own").over(of_tree.orderBy("part")) - F.col("own")).withColumn("n", F.sum("own").over(of_tree))
    place = F.row_number().over(Window.partitionBy("part", *tree).orderBy(*[F.col(c).asc_nulls_first() for c in order]))
    numbered = ranged.withColumn("place", place).withColumnRenamed("part", "p").withColumnsRenamed({c: f"t_{c}" for c in tree})
    met = F.col("p") == F.col("part")
    for c in tree:
        met &= F.col(c).eqNullSafe(F.col(f"t_{c}"))
    return stage(numbered.join(starts, met).withColumn("pos", F.col("start") + F.col("place") - 1)
                 .select(*rows.columns, "part", "pos", "n"), "merkle-positions")


# ------------------------------------------------------------------ node table

def node_table(level0: DataFrame) -> DataFrame:
    """All nodes (tree, level, i, h, n: nodes of the level) of the trees whose leaves (tree, i, h, n) are given."""
    level, number = level0.select("tree", F.lit(0).alias("level"), "i", "h", "n"), 0
    table = level
    most = level0.agg(F.max("n")).first()[0] or 0
    while most > 1:
        number, most = number + 1, -(-most // FANOUT)
        run = F.transform(F.array_sort(F.collect_list(F.struct("i", "h"))), lambda x: x["h"])
        level = stage(level.filter("n > 1").groupBy("tree", F.expr(f"i div {FANOUT}").alias("up"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("above"))
                      .agg(F.sha2(F.concat_ws("", run), 256).alias("h"))
                      .select("tree", F.lit(number).alias("level"), F.col("up").alias("i"), "h", F.col("above").alias("n")), "merkle-level")
        table = table.unionByName(level)
    return table


# ------------------------------------------------------------------ octopus

def missing(known: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """(level, nodes) that proofs of the leaves ``known`` (of ``n``) need beside what those leaves give."""
    out, level = [], 0
    known = np.unique(known)
    while n > 1:
        runs = np.unique(known // FANOUT)
        members = (runs[:, None] * FANOUT + np.arange(FANOUT)).reshape(-1)
        lacking = np.setdiff1d(members[members < n], known, assume_unique=True)
        if len(lacking):
            out.append((level, lacking))
        known, n, level = runs, -(-n // FANOUT), level + 1
    return out


def interiors(leaf: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> list[dict[int, tuple[str, str, str]]]:
    """Per level the derived nodes: place -> (digest, digests left of it in its run, those right of it).

    The last level holds the root alone.
    """
    levels, known, level = [], leaf, 0
    while n > 1:
        here, above = {}, {}
        for run in dict.fromkeys(i // FANOUT for i in known):
            first = run * FANOUT
            places = range(first, min(first + FANOUT, n))
            digests = [known[i] if i in known else fetched[level, i] for i in places]
            above[run] = sha256("".join(digests).encode()).hexdigest()
            for k, i in enumerate(places):
                if i in known:
                    here[i] = digests[k], "".join(digests[:k]), "".join(digests[k + 1:])
        levels.append(here)
        known, n, level = above, -(-n // FANOUT), level + 1
    levels.append({i: (h, "", "") for i, h in known.items()})
    return levels


def paths(levels: list[dict[int, tuple[str, str, str]]], above: tuple[str, tuple]) -> dict[int, tuple[str, tuple]]:
    """Per leaf its siblings up to the dataset's root as one text, and its steps ((left, right), ...).

    ``above``: the same of the tree's root.  Every inner node's path is made once.
    """
    found = {i: above for i in levels[-1]}
    for level in reversed(levels[:-1]):
        found = {i: (left + right + found[i // FANOUT][0], ((left, right), found[i // FANOUT][1])) for i, (_, left, right) in level.items()}
    return found


def fold(leaf: str, steps: tuple) -> str:
    """The root that a leaf and its steps give."""
    while steps:
        (left, right), steps = steps
        leaf = sha256((left + leaf + right).encode()).hexdigest()
    return leaf


def _of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """(part, its batches) of rows sorted by part."""
    current, held = None, []
    for batch in batches:
        part = batch.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(part)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if part[a] != current and held:
                yield current, held
                held = []
            current = part[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield current, held


def _wanted_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (part, tree, pos, n, rank, trees) -> the part's missing coordinates (part, tree, level, i); tree null is the top tree."""
    for part, held in _of_parts(batches):
        rows = pa.Table.from_batches(held).to_pandas()
        tops = rows.drop_duplicates("tree")
        found = [(None, level, i) for level, i in missing(tops["rank"].to_numpy(), int(tops["trees"].iloc[0]))]
        for tree, own in rows.groupby("tree"):
            found += [(tree, level, i) for level, i in missing(own["pos"].to_numpy(), int(own["n"].iloc[0]))]
        for tree, level, i in found:
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(i), pa.int32()), pa.array([tree] * len(i), pa.string()),
                                              pa.array([level] * len(i), pa.int32()), pa.array(i, pa.int64())], names=["part", "tree", "level", "i"])


def _expand_batches(doc_type: pa.DataType, with_siblings: bool):
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _of_parts(batches):
            rows = pa.Table.from_batches(held)
            fetched: dict = {}
            for tree, level, i, h in zip(*[rows.filter(pc.is_valid(rows["level"]))[c].to_pylist() for c in ("tree", "level", "i", "h")], strict=True):
                fetched.setdefault(tree, {})[level, i] = h
            rows = rows.filter(pc.is_null(rows["level"]))
            tree, pos, n, rank, leaf, shown = (rows[c].to_pylist() for c in ("tree", "i", "n", "rank", "h", "shown"))
            own: dict = {}
            for t, i, h in zip(tree, pos, leaf, strict=True):
                own.setdefault(t, {})[i] = h
            about = dict(zip(tree, zip(n, rank, strict=True), strict=True))
            inner = {t: interiors(of, fetched.get(t, {}), about[t][0]) for t, of in own.items()}
            subroot = {t: next(iter(levels[-1].values()))[0] for t, levels in inner.items()}
            top = interiors({about[t][1]: h for t, h in subroot.items()}, fetched.get(None, {}), rows["trees"][0].as_py())
            root = next(iter(top[-1].values()))[0]
            above = paths(top, ("", ()))
            every = {t: paths(levels, above[about[t][1]]) for t, levels in inner.items()}
            proofs = [every[t][i] for t, i in zip(tree, pos, strict=True)]
            folded = [fold(h, steps) for h, (_, steps) in zip(shown, proofs, strict=True)]
            columns = [rows["doc_id"].combine_chunks().cast(doc_type), rows["h"].combine_chunks(), pa.array([subroot[t] for t in tree]), pa.array([root] * len(tree)),
                       pa.array([sha256(text.encode()).hexdigest() for text, _ in proofs]), pa.array(folded), pa.array([f == root for f in folded])]
            names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
            if with_siblings:
                columns.append(pa.array([[text[k:k + 64] for k in range(0, len(text), 64)] for text, _ in proofs], pa.list_(pa.string())))
                names.append("siblings")
            for at in range(0, len(tree), 4096):
                yield pa.RecordBatch.from_arrays([c.slice(at, 4096) for c in columns], names=names)

    return expand


def manifest(docs: DataFrame, altered: Column | None = None, change: Column | None = None, with_siblings: bool = False) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified (and siblings, the proof itself).

    ``folded_root`` is folded from the row as it is shown to the verifier: with the text ``change`` where ``altered``.
    """
    rows = leaves(docs, F.lit(False) if altered is None else altered, F.col("text") if change is None else change)
    # null and text languages apart: a tree's name is '-' or '=' and the language
    named = rows.select("doc_id", F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-")).alias("tree"), "leaf", "shown", "rid")
    placed = positions(named, ["tree"], ["doc_id", "leaf", "rid"])
    nodes = node_table(placed.select("tree", F.col("pos").alias("i"), F.col("leaf").alias("h"), "n"))
    subroots = stage(nodes.filter("n = 1").select("tree", "h"), "merkle-subroots")
    ranked = positions(subroots.withColumn("all", F.lit(0)), ["all"], ["tree"]).select("tree", "h", F.col("pos").alias("rank"), F.col("n").alias("trees"))
    top = node_table(ranked.select(F.lit(None).cast("string").alias("tree"), F.col("rank").alias("i"), "h", F.col("trees").alias("n")))
    placed = placed.join(ranked.select("tree", "rank", "trees"), "tree")
    width = max(1, placed.select("part").distinct().count())
    of_part = placed.repartition(width, "part")
    wanted = stage(of_part.select("part", "tree", "pos", "n", "rank", "trees").sortWithinPartitions("part")
                   .mapInArrow(_wanted_batches, "part int, tree string, level int, i long"), "merkle-wanted")
    table = nodes.unionByName(top).select(F.col("tree").alias("t"), F.col("level").alias("l"), F.col("i").alias("at"), "h")
    got = wanted.join(table, F.col("tree").eqNullSafe(F.col("t")) & (F.col("level") == F.col("l")) & (F.col("i") == F.col("at")))
    none = F.lit(None).cast("long")
    id_type = docs.select("doc_id").schema[0].dataType
    both = got.select("part", "tree", "level", "i", "h", none.alias("n"), none.alias("rank"), none.alias("trees"), F.lit(None).cast("string").alias("shown"),
                      F.lit(None).cast(id_type).alias("doc_id")).unionByName(
        placed.select("part", "tree", F.lit(None).cast("int").alias("level"), F.col("pos").alias("i"), F.col("leaf").alias("h"), "n", "rank", "trees", "shown", "doc_id"))
    schema = f"doc_id {id_type.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return both.repartition(width, "part").sortWithinPartitions("part").mapInArrow(
        _expand_batches(to_arrow_type(id_type), with_siblings), schema + (", siblings array<string>" if with_siblings else ""))


def tampered() -> tuple[Column, Column]:
    """(which rows, their text) of the audit that the query runs: 3 divides crc32 of the id; A-Z are lower-cased."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.translate("text", UPPER, LOWER)
