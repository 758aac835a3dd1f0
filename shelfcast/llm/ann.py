"""Approximate nearest neighbours by balanced posting lists.

1. Equal vectors are one node that keeps its k + 1 least ids: no more can be among the k
   nearest of any query, so a vector that a third of all rows hold costs one node.
2. Centroids come from hierarchical balanced k-means on a bounded seeded sample
   (``SAMPLE_VALUES`` numbers); every node is indexed.
3. A neighbour graph over the centroids, held in memory (at most ``MAX_CENTROIDS``), is searched
   best-first for batches of vectors.  A node goes to its nearest list and, near a boundary, to
   up to ``REPLICAS`` lists whose distance ratio is within ``BOUNDARY`` (unless an already chosen
   centroid is nearer to the new one than the node is).
4. A query reads its nearest lists until they hold k + 1 nodes for sure (a node is in
   ``REPLICAS`` lists at most), and on to ``PROBE_RATIO`` times the distance of the last of
   those, to ``probes`` lists: their number grows with the square root of the lists, so the share
   of the table that a query reads falls as it grows.  Queries that still find fewer than k rows read all lists.
   Lists over ``LIST_MAX`` nodes are split by hash, and each part meets the queries on its own.
5. Scores are cosines in double precision on the original vectors; ties go to the least id.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components
take no part, nor do vectors of another length than the commonest one, nor null ids; repeated
(id, vector) rows count once; with fewer candidates than k all are returned; an empty table
gives an empty result.  Extra columns are ignored.

Recall against brute force is measured in the tests and the README (at least 0.9).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage

SAMPLE_VALUES = 2_000_000  # numbers in the sample that the centroids are fitted on
LIST_ROWS = 256            # nodes of a list, about
LIST_MAX = 4096            # nodes of a list that one task holds
MAX_CENTROIDS = 8192
REPLICAS = 4
BOUNDARY = 1.10            # distance ratio within which a node is replicated
PROBES, PROBE_ROOT = 48, 3.2  # lists that a query reads: at least, and for each root of the number of lists
PROBE_RATIO = 1.5          # distance ratio within which a query reads a list
DEGREE = 16
BEAM = 64
SEED = 41


# ------------------------------------------------------------------ index (driver, bounded sample)

def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that the largest component is near one: squares neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0))
    return np.ldexp(x, -exponent)


def probes(lists: int) -> int:
    return max(PROBES, int(np.ceil(PROBE_ROOT * np.sqrt(lists))))


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _balanced_split(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 8) -> np.ndarray:
    """Cluster numbers of ``x`` (unit rows) after k-means steps with a penalty on full clusters."""
    centres = x[rng.choice(len(x), k, replace=False)]
    sizes, owner = np.zeros(k), np.zeros(len(x), dtype=np.int64)
    for _ in range(steps):
        owner = np.argmax(x @ centres.T - 0.05 * sizes / (len(x) / k), axis=1)
        sizes = np.bincount(owner, minlength=k).astype(float)
        sums = np.zeros((k, x.shape[1]))
        np.add.at(sums, owner, x)
        full = sizes > 0
        centres[full] = _unit(sums[full])
    return owner


def balanced_centroids(sample: np.ndarray, lists: int, seed: int = SEED) -> np.ndarray:
    """About ``lists`` unit centroids: clusters over the mean size are split until none is left."""
    rng, x = np.random.default_rng(seed), _unit(sample.astype(np.float64))
    limit = max(1.0, 1.5 * len(x) / max(lists, 1))
    todo, done = [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= limit:
            done.append(rows)
            continue
        k = int(min(8, max(2, round(len(rows) / limit)), len(rows)))
        owner = _balanced_split(x[rows], k, rng)
        parts = [rows[owner == c] for c in range(k) if np.any(owner == c)]
        if len(parts) == 1:
            done.append(rows)
        else:
            todo.extend(parts)
    return _unit(np.stack([x[rows].mean(axis=0) for rows in done])).astype(np.float32)


def neighbour_graph(centroids: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Nearest centroids of each centroid, the last links random (so that the graph hangs together)."""
    n = len(centroids)
    rng = np.random.default_rng(SEED)
    near = min(degree, n - 1)
    out = np.zeros((n, near + 4), dtype=np.int32)
    for a in range(0, n, 1024):
        sims = centroids[a:a + 1024] @ centroids.T
        sims[np.arange(len(sims)), np.arange(a, a + len(sims))] = -np.inf
        out[a:a + 1024, :near] = np.argsort(-sims, axis=1, kind="stable")[:, :near]
    out[:, near:] = rng.integers(0, n, (n, 4))
    return out


def graph_search(x: np.ndarray, centroids: np.ndarray, graph: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of the centroid graph for a batch: (ids, cosines) of ``beam`` centroids, best first; -1 pads."""
    rows, n = len(x), len(centroids)
    every, none = np.arange(rows), np.float32(-9)
    starts = np.unique(np.linspace(0, n - 1, min(n, 16)).astype(np.int64))
    ids = np.full((rows, beam + graph.shape[1] + len(starts)), -1, dtype=np.int64)
    sims = np.full(ids.shape, none, dtype=np.float32)
    open_ = np.zeros(ids.shape, dtype=bool)
    seen = np.zeros((rows, n), dtype=bool)
    ids[:, :len(starts)], sims[:, :len(starts)], open_[:, :len(starts)] = starts, x @ centroids[starts].T, True
    seen[:, starts] = True
    for _ in range(4 * beam):
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims, open_ = (np.take_along_axis(z, order, 1) for z in (ids, sims, open_))
        sims[:, beam:], ids[:, beam:], open_[:, beam:] = none, -1, False
        live = open_.any(axis=1)
        if not live.any():
            break
        best = np.argmax(open_, axis=1)
        node = np.where(live, ids[every, best], 0)
        open_[every, best] = False
        links = graph[node]
        fresh = live[:, None] & ~seen[every[:, None], links]
        for j in range(1, links.shape[1]):  # a link listed twice counts once
            fresh[:, j] &= ~(links[:, :j] == links[:, j:j + 1]).any(axis=1)
        seen[every[:, None], links] |= fresh
        got = np.einsum("rd,rjd->rj", x, centroids[links])
        spot = slice(beam, beam + links.shape[1])
        ids[:, spot], sims[:, spot], open_[:, spot] = np.where(fresh, links, -1), np.where(fresh, got, none), fresh
    return ids[:, :beam], sims[:, :beam]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), -1)


def _assign(centroids: np.ndarray, graph: np.ndarray, most: int, ratio: float, spread: bool,
            sizes: np.ndarray | None = None, least_nodes: int = 0, beam: int = BEAM) -> Callable:
    """Batches (key, vec, ...) to one row per chosen list; the ratio counts from the list with which ``least_nodes`` (by ``sizes``) are met."""
    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                x = _unit(_matrix(part.column("vec"))).astype(np.float32)
                ids, sims = graph_search(x, centroids, graph, beam)
                distance = np.sqrt(np.maximum(2 - 2 * sims, 0))
                needed = np.zeros(ids.shape, dtype=bool)
                needed[:, 0] = True
                if sizes is not None:
                    held = np.where(ids >= 0, sizes[ids], 0)
                    needed |= (ids >= 0) & (np.cumsum(held, axis=1) - held < least_nodes)
                last = np.max(np.where(needed, distance, 0), axis=1, keepdims=True)
                take = (ids >= 0) & (distance <= np.maximum(last * ratio, 1e-6))
                take[:, most * 4:] = False
                if spread:  # skip a centroid that an already chosen one stands nearer to than the vector does
                    for j in range(1, min(most * 4, take.shape[1])):
                        between = np.einsum("rjd,rd->rj", centroids[ids[:, :j]], centroids[ids[:, j]])
                        nearer = take[:, :j] & (np.sqrt(np.maximum(2 - 2 * between, 0)) < distance[:, j:j + 1])
                        take[:, j] &= ~nearer.any(axis=1)
                take &= np.cumsum(take, axis=1) <= most
                take |= needed
                row, slot = np.nonzero(take)
                picked = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(ids[row, slot].astype(np.int32))],
                                                 names=[*part.schema.names, "list"])

    return chosen


# ------------------------------------------------------------------ search

def _lists(k: int) -> Callable:
    """Rows sorted by (list, part, asks): the list's nodes, then its queries; best k + 1 nodes per query."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, block = None, [], None
        for batch in batches:
            group = np.stack([batch.column("list").to_numpy(), batch.column("part").to_numpy()], axis=1)
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            change = np.flatnonzero(np.any(group[1:] != group[:-1], axis=1) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *change], [*change, batch.num_rows], strict=True):
                if a == b:
                    continue
                if current != tuple(group[a]):
                    current, held, block = tuple(group[a]), [], None
                rows = batch.slice(a, b - a)
                if not asks[a]:
                    held.append(rows)
                    continue
                if not held:
                    continue
                if block is None:
                    keys = pa.concat_arrays([r.column("key") for r in held])
                    vectors = _scaled(np.concatenate([_matrix(r.column("vec")) for r in held]))
                    block = keys, np.concatenate([r.column("least").to_numpy() for r in held]), vectors, np.linalg.norm(vectors, axis=1)
                yield from _best(rows, *block, k + 1)

    return search


def _best(rows: pa.RecordBatch, keys: pa.Array, least: np.ndarray, vectors: np.ndarray, norms: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    for a in range(0, rows.num_rows, 256):
        part = rows.slice(a, 256)
        q = _scaled(_matrix(part.column("vec")))
        own = np.linalg.norm(q, axis=1)
        rough = (q @ vectors.T) / own[:, None] / norms[None, :]
        kth = np.partition(rough, -min(most, rough.shape[1]), axis=1)[:, -min(most, rough.shape[1])]
        row, col = np.nonzero(rough >= kth[:, None] - 1e-9)
        # the same summation order for every pair: equal vectors get equal scores
        score = (q[row] * vectors[col]).sum(axis=1) / (own[row] * norms[col])
        order = np.lexsort((least[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        begin = np.searchsorted(row, row, side="left")
        keep = np.arange(len(row)) - begin < most
        yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(row[keep])), keys.take(pa.array(col[keep])), pa.array(score[keep])],
                                         names=["query", "node", "score"])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vec (array<double>), key of the rows that take part."""
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
            .filter("vec_id is not null and vec is not null").filter(~bad).filter(F.exists("vec", lambda v: v != 0)).withColumn("dim", F.size("vec")))
    dims = rows.groupBy("dim").count().orderBy(F.col("count").desc(), "dim").limit(1).select("dim")
    key = F.concat(F.hex(F.xxhash64("vec")), F.lit("-"), F.hex(F.xxhash64("vec", F.lit(SEED))))
    return rows.join(F.broadcast(dims), "dim").select("vec_id", "vec", key.alias("key"), "dim")


def nearest(vectors: DataFrame, asks: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest other rows of every row for which ``asks`` (on vec_id) holds."""
    spark = vectors.sparkSession
    rows = stage(usable(vectors), "vectors")
    by_id = W.partitionBy("key").orderBy("vec_id")
    ids = (rows.select("key", "vec_id").withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
           .groupBy("key").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")))  # at most k + 1 a key
    nodes = stage(rows.groupBy("key").agg(F.first("vec").alias("vec")).join(ids, "key")
                  .select("key", "vec", "ids", F.col("ids")[0].alias("least")), "nodes")
    n = nodes.count()
    if n == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = rows.select("dim").first()[0]
    bound = max(1, SAMPLE_VALUES // dim)
    share = min(1.0, 0.95 * bound / n)
    sample = (nodes.filter(F.xxhash64("key", F.lit(SEED)).cast("double") / float(2**64) + 0.5 <= share)
              .select("key", "vec").limit(bound).toPandas().sort_values("key"))  # bounded by SAMPLE_VALUES
    sampled = np.stack(sample["vec"].to_numpy()) if len(sample) else np.ones((1, dim))
    lists = int(min(max(1, -(-n // LIST_ROWS)), MAX_CENTROIDS, max(1, len(sampled) // 8)))
    centroids = balanced_centroids(sampled, lists)
    graph = neighbour_graph(centroids)
    held = stage(nodes.select("key", "vec", "least").mapInArrow(
        _assign(centroids, graph, REPLICAS, BOUNDARY, True), "key string, vec array<double>, least long, list int"), "postings")
    wanted = rows.filter(asks).select("vec_id", "key")
    parts = held.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / LIST_MAX).cast("int").alias("parts"), F.count(F.lit(1)).alias("n"))
    parts = stage(parts, "lists")  # a row per list, at most MAX_CENTROIDS
    sizes = np.zeros(len(centroids), dtype=np.int64)
    for r in parts.collect():
        sizes[r["list"]] = r["n"]
    parts = F.broadcast(parts.drop("n"))
    postings = held.join(parts, "list").select("key", "vec", "least", "list", F.pmod(F.xxhash64("key"), "parts").cast("int").alias("part"), F.lit(False).alias("asks"))

    def search(asked: DataFrame) -> DataFrame:
        """query, score, node, least, ids of the k + 1 best nodes of every query among the lists that it reads."""
        each = asked.select("key", "vec", "least", "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("asks"))
        met = (postings.unionByName(each).repartition("list", "part").sortWithinPartitions("list", "part", "asks")
               .mapInArrow(_lists(k), "query string, node string, score double"))
        best = W.partitionBy("query").orderBy(F.col("score").desc(), "least")
        return (met.groupBy("query", "node").agg(F.max("score").alias("score")).join(nodes.select(F.col("key").alias("node"), "least", "ids"), "node")
                .withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n"))

    def answers(found: DataFrame) -> DataFrame:
        answer = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return (wanted.distinct().select(F.col("vec_id").alias("query_id"), F.col("key").alias("query"))
                .join(found.select("query", "score", F.explode("ids").alias("vec_id")), "query")
                .filter(F.col("vec_id") != F.col("query_id"))
                .withColumn("rank", F.row_number().over(answer)).filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))

    queries = nodes.join(wanted.select("key").distinct(), "key", "left_semi").select("key", "vec", "least")
    asked = queries.mapInArrow(_assign(centroids, graph, probes(len(centroids)), PROBE_RATIO, False, sizes, REPLICAS * (k + 1), max(BEAM, probes(len(centroids)) * 3 // 2)),
                               "key string, vec array<double>, least long, list int").join(parts, "list")
    found = stage(search(asked), "found")
    first = stage(answers(found), "answers")
    full = first.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == k)
    short = stage(wanted.join(full, "vec_id", "left_anti").select("key").distinct(), "short")
    if short.limit(1).count() == 0:
        return first
    every = queries.join(short, "key", "left_semi").crossJoin(parts)  # few queries: the lists around them are all but empty
    rest = found.join(short, F.col("query") == F.col("key"), "left_anti")
    return answers(rest.unionByName(stage(search(every), "found-again")))
