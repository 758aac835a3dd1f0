"""Quality classifier: a weak-label model trains a hashed linear scorer.

Two tasks, ``junk`` and ``toxic``; a document is kept when neither score reaches its
cut (``CUTS``).

1. Heuristic labellers vote on every document (fire / don't fire): letter case, symbol tails,
   repeated words, separator tokens; an insult list, a linear cue model learned from a
   bounded sample of ``labels`` (``SAMPLE_ROWS``; one vote of three levels); and the label itself where there is one.
2. Expectation-maximisation (Dawid and Skene) over the counts of vote patterns of all
   documents estimates the rates of each labeller's votes per class and each pattern's posterior.
   Patterns are few (at most 3 to the number of labellers), whatever the number of documents.
3. Posterior labels of a bounded seeded sample (``SAMPLE_ROWS``) train the scorer: a logistic
   regression over hashed features (words, word stems, style bins) that are significant.
4. The scorer alone decides, in one pass over the documents, without a join.

Defined results: null text counts as empty; documents without words are rejected as junk;
without labels the cue model never fires and the other labellers carry the model; documents
with several labels take the worst; a doc_id of several texts enters a fit with one of them;
repeated rows get equal results; an empty table gives an
empty result.  Extra columns are kept by ``reject`` and ignored otherwise.

Scale: text is read four times; only the texts and feature counts of the bounded samples (after
partial aggregation to one text a doc_id), and (doc_id, votes) rows joined with labels, move.  The broadcasts are the samples (two
numbers a row, at most ``SAMPLE_ROWS``) and the weights: every significant feature of a sample
has one.  Arrow batches are bounded in bytes.  The driver holds 4 bytes a feature hit of a sample; gradients go in blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, id_kind, stage
from .wordhash import U, byte_slices, mix, span_hashes, text_bytes

SAMPLE_ROWS = 50_000   # bound of the rows that cues and scorer are fitted on
BLOCK_HITS = 1 << 20   # feature hits of a gradient's temporary arrays
CHUNK_BYTES = 1 << 20  # text handled at once
SLICE_BYTES = 4 << 20  # text copied at once
HASH_BITS = 30
STEMS = (4, 5)         # bytes of the word stems
MIN_DOCS, MIN_Z = 5, 6.0  # when a feature may carry weight
L2, TRAIN_STEPS = 0.1, 400
EM_STEPS = 50
CUE_LEVELS = (0.0, 2.0)  # log odds from which the cue model votes 1, and 2
SEED = 31
TASKS = ("junk", "toxic")
CUTS = {"junk": -1.0, "toxic": -2.0}  # log odds from which a document is rejected: a miss costs more than a false alarm

# fixed values: a general English insult list
INSULTS = ("idiot idiots moron morons stupid scum loser losers pathetic worthless trash clown disgusting imbecile "
           "vermin retard bastard filthy degenerate subhuman bitch whore slut cretin dumbass asshole").split()
# fixed values: firing points of the style labellers (shares of letters or tokens)
STYLE_POINTS = {"caps": 0.4, "symbols": 0.3, "repeats": 0.3, "bars": 0.15}
STYLE = tuple(STYLE_POINTS)


def _hash_words(words: list[str]) -> np.ndarray:
    data, _ = text_bytes(pa.array([" ".join(words)]), lower=True)
    starts, ends = _letter_spans(data, np.array([0, len(data)]))
    return np.sort(span_hashes(data, starts, ends) >> U(64 - HASH_BITS))


def _runs(inside: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true, broken at row bounds."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = rows[:-1] < rows[1:]
    first[rows[:-1][full]] = inside[rows[:-1][full]]
    last[rows[1:][full] - 1] = inside[rows[1:][full] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _letters(data: np.ndarray) -> np.ndarray:
    return ((data >= 97) & (data <= 122)) | (data >= 128)


def _letter_spans(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _runs(_letters(data), rows)


def _chunk_rows(rows: np.ndarray) -> Iterator[tuple[int, int]]:
    a = 0
    while a < len(rows) - 1:
        b = max(a + 1, int(np.searchsorted(rows, rows[a] + CHUNK_BYTES, side="right")) - 1)
        yield a, b
        a = b


def _features(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word and stem features, their row numbers, and the style shares (rows x STYLE, -1 without words)."""
    n = len(rows) - 1
    upper = (raw >= 65) & (raw <= 90)
    data = raw + (upper.view(np.uint8) << 5)
    c3 = np.zeros(len(data), dtype=bool)
    c3[1:] = data[:-1] == 0xC3
    high = c3 & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)  # upper-case Latin-1 letters in UTF-8
    data = data + (high.view(np.uint8) << 5)
    starts, ends = _letter_spans(data, rows)
    row = np.searchsorted(rows, starts, side="right") - 1
    hashes, owners = [span_hashes(data, starts, ends) >> U(64 - HASH_BITS)], [row]
    for size in STEMS:
        long = np.flatnonzero(ends - starts > size)
        hashes.append(mix(span_hashes(data, starts[long], starts[long] + size) + U(size)) >> U(64 - HASH_BITS))
        owners.append(row[long])
    # style shares
    total = lambda flags: np.bincount(np.searchsorted(rows, np.flatnonzero(flags), side="right") - 1, minlength=n)
    white = (raw == 32) | ((raw >= 9) & (raw <= 13))
    ws, we = _runs(~white, rows)
    of = np.searchsorted(rows, ws, side="right") - 1
    words = np.bincount(of, minlength=n)
    cased = total(upper | high)
    lettered = total(_letters(data) & ~((data >= 0x80) & (data < 0xC0)))  # continuation bytes are no letters of their own
    symbol = ((raw > 32) & (raw < 127)) & ~(upper | _letters(raw) | ((raw >= 48) & (raw <= 57)))
    lengths = we - ws
    double = np.zeros(len(ws), dtype=bool)
    two = lengths >= 2
    double[two] = symbol[we[two] - 1] & symbol[we[two] - 2] & (raw[we[two] - 1] == raw[we[two] - 2]) & (raw[we[two] - 1] != ord("."))
    bar = (lengths == 1) & symbol[ws] if len(ws) else np.zeros(0, bool)
    plain = span_hashes(data, ws, we)
    again = np.zeros(len(ws), dtype=bool)
    again[1:] = (plain[1:] == plain[:-1]) & (of[1:] == of[:-1])
    per_word = np.maximum(words, 1)
    share = np.stack([cased / np.maximum(lettered, 1), np.bincount(of[double], minlength=n) / per_word,
                      np.bincount(of[again], minlength=n) / per_word, np.bincount(of[bar], minlength=n) / per_word], axis=1)
    share[words == 0] = -1.0
    share[:, 0] = np.where((words > 0) & (lettered < 8), 0.0, share[:, 0])
    return np.concatenate(hashes), np.concatenate(owners), share


def _style_features(share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashed features per style and row: its tenth, and whether its labeller's point is reached (or "no words")."""
    bins = np.where(share < 0, 15, np.minimum(9, (share * 10).astype(np.int64)))
    points = np.array([STYLE_POINTS[x] for x in STYLE])
    over = np.where(share < 0, 18, 16 + (share >= points))
    both = np.concatenate([bins, over], axis=1)
    codes = mix((both + 32 * (np.arange(both.shape[1])[None, :] % len(STYLE)) + (1 << 40)).astype(U)) >> U(64 - HASH_BITS)
    return codes.reshape(-1), np.repeat(np.arange(len(share)), both.shape[1])


def _all_style_features() -> np.ndarray:
    levels = [[x / 10 + 0.01] * len(STYLE) for x in range(10)] + [[0.99] * len(STYLE), [-1.0] * len(STYLE)]
    return np.unique(_style_features(np.array(levels))[0])


def _hits(sorted_set: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_set) or not len(values):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (part for whole in batches for part in byte_slices(whole, SLICE_BYTES))


def _each_chunk(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    raw, rows = text_bytes(texts, lower=False)
    for a, b in _chunk_rows(rows):
        yield a, b, *_features(raw[rows[a]:rows[b]], rows[a:b + 1] - rows[a])


# ------------------------------------------------------------------ counting and weights

def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per feature, weighted by the two posteriors: (feature, docs, junk, toxic)."""
    for batch in _slices(batches):
        weight = np.stack([batch.column(t).to_numpy(zero_copy_only=False).astype(float) for t in TASKS], axis=1)
        for a, b, features, owner, share in _each_chunk(batch.column("text")):
            codes, who = _style_features(share)
            pairs = np.unique(np.concatenate([owner, who]).astype(np.int64) << HASH_BITS | np.concatenate([features, codes]).astype(np.int64))
            ids, inverse = np.unique(pairs & ((1 << HASH_BITS) - 1), return_inverse=True)
            w = weight[a:b][pairs >> HASH_BITS]
            docs = np.bincount(inverse, minlength=len(ids)).astype(float)
            sums = [np.bincount(inverse, weights=w[:, t], minlength=len(ids)) for t in range(len(TASKS))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, docs, *sums)], names=["feature", "docs", *TASKS])


def _candidates(counts: DataFrame, task: str, total: float, positive: float) -> np.ndarray:
    """Sorted features whose document frequency is significantly raised in the task's class."""
    if positive <= 0 or positive >= total:
        return np.zeros(0, dtype=U)
    negative = total - positive
    rate = F.col("docs") / total
    z = (F.col(task) - rate * positive) / F.sqrt(F.greatest(rate * (1 - rate) * positive * negative / total, F.lit(1e-12)))
    got = counts.filter(F.col("docs") >= MIN_DOCS).filter(z >= MIN_Z).select("feature").toArrow()  # features of a bounded sample
    return np.sort(got["feature"].to_numpy().astype(U))


def _hit_batches(known: np.ndarray) -> Callable:
    """Per document: its posteriors and the numbers of the known features that it holds."""
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            for a, b, features, owner, share in _each_chunk(batch.column("text")):
                row, at = _known(known, features, owner, share)
                bounds = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*[batch.column(t).slice(a, b - a) for t in TASKS],
                                                  pa.ListArray.from_arrays(pa.array(bounds), pa.array(at.astype(np.int32)))], names=[*TASKS, "hits"])

    return hits


def _known(known: np.ndarray, features: np.ndarray, owner: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number of the known feature), distinct, by row."""
    codes, who = _style_features(share)
    every, of = np.concatenate([features, codes]), np.concatenate([owner, who]).astype(np.int64)
    hit = _hits(known, every)
    pairs = np.unique(of[hit] << HASH_BITS | np.searchsorted(known, every[hit]).astype(np.int64))
    return pairs >> HASH_BITS, pairs & ((1 << HASH_BITS) - 1)


def logistic(starts: np.ndarray, col: np.ndarray, target: np.ndarray, features: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft targets over 0/1 features (L2, Adam, full batches).

    Row i holds the features ``col[starts[i]:starts[i + 1]]`` (one at least).
    """
    w = np.zeros(features + 1)
    m, v = np.zeros(features + 1), np.zeros(features + 1)
    bounds = np.append(starts, len(col))
    cuts = np.unique(np.append(np.searchsorted(bounds, np.arange(0, len(col), BLOCK_HITS)), len(starts)))
    for step in range(1, TRAIN_STEPS + 1):
        grad = np.append(L2 * w[:-1], 0.0)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            hits = col[bounds[a]:bounds[b]]
            margin = w[-1] + np.add.reduceat(w[hits], bounds[a:b] - bounds[a])
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target[a:b]
            grad[:-1] += np.bincount(hits, weights=np.repeat(error, np.diff(bounds[a:b + 1])), minlength=features)
            grad[-1] += error.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return w[:-1], float(w[-1])


def _key() -> Column:
    return F.xxhash64("text")


def _fit(docs: DataFrame, rows: DataFrame, name: str) -> dict[str, tuple[np.ndarray, np.ndarray, float]]:
    """Sorted features, weights and bias per task; ``rows``: at most SAMPLE_ROWS (doc_id, key, junk, toxic), one a doc_id.

    The sample holds one text of each doc_id: that of hash ``key``, any (the least) if it is null.
    """
    met = (docs.select(F.col("doc_id").cast(id_kind(docs)).alias("doc_id"), _key().alias("own"), "text").join(F.broadcast(rows), "doc_id")
           .filter("key is null or key = own"))
    sample = stage(met.groupBy("doc_id").agg(F.min("text").alias("text"), *[F.max(t).alias(t) for t in TASKS]).select("text", *TASKS), f"{name}-sample")
    counts = stage(sample.mapInArrow(_count_batches, "feature long, docs double, junk double, toxic double")
                   .groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("docs", *TASKS)]), f"{name}-counts")
    sums = sample.agg(F.count(F.lit(1)), *[F.sum(t) for t in TASKS]).first()
    style = _all_style_features()
    model = {}
    for t, task in enumerate(TASKS):
        known = np.unique(np.concatenate([_candidates(counts, task, float(sums[0]), sums[1 + t] or 0.0), style]))
        got = sample.mapInArrow(_hit_batches(known), "junk double, toxic double, hits array<int>").select(task, "hits").toArrow()  # bounded by SAMPLE_ROWS
        if not got.num_rows:
            model[task] = (known, np.zeros(len(known)), -1.0)
            continue
        lists, target = got["hits"].chunks, got[task].to_numpy().astype(float)
        lengths = np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False) for x in lists])
        col = np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in lists])
        del got, lists
        starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)[:-1]])  # every document holds style features, so no list is empty
        weights, bias = logistic(starts, col, target, len(known))
        model[task] = (known, weights, bias)
    return model


# ------------------------------------------------------------------ votes and EM

def _vote_batches(cues: dict) -> Callable:
    insults = _hash_words(list(INSULTS))
    points = np.array([STYLE_POINTS[x] for x in STYLE])

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            for a, b, features, owner, share in _each_chunk(batch.column("text")):
                n = b - a
                junk = (share < 0).any(axis=1).astype(np.int64) << len(STYLE)
                for i in range(len(STYLE)):
                    junk |= (share[:, i] >= points[i]).astype(np.int64) << i
                listed = np.bincount(owner[_hits(insults, features)], minlength=n)
                cued = _margins(cues["toxic"], features, owner, share)
                toxic = (listed > 0).astype(np.int64) | np.searchsorted(CUE_LEVELS, cued, side="right") << 1
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, n), batch.column("key").slice(a, n), pa.array(junk.astype(np.int32)), pa.array(toxic.astype(np.int32))],
                                                 names=["doc_id", "key", "junk_votes", "toxic_votes"])

    return votes


def _margins(model: tuple, features: np.ndarray, owner: np.ndarray, share: np.ndarray) -> np.ndarray:
    known, weights, bias = model
    row, at = _known(known, features, owner, share)
    return bias + np.bincount(row, weights=weights[at], minlength=len(share))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, steps: int = EM_STEPS) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of class 1 per pattern, rates of each labeller's votes (2 x all their levels) and the class share.

    ``patterns``: a column per labeller, its vote 0, 1, ... or -1 for none; ``counts``: documents per pattern.
    Starts from "any labeller votes over 0"; rates are smoothed by half a document per vote.
    """
    levels = [max(2, int(patterns[:, j].max(initial=0)) + 1) for j in range(patterns.shape[1])]
    cast = np.concatenate([patterns[:, j:j + 1] == np.arange(n) for j, n in enumerate(levels)], axis=1).astype(float)
    voted = np.repeat(patterns >= 0, levels, axis=1).astype(float)
    room = 0.5 * np.repeat(levels, levels)
    posterior = np.where((patterns >= 1).any(axis=1), 0.9, 0.05)
    last = patterns[:, -1]  # the label, where there is one
    posterior = np.where(last == 1, 0.99, np.where(last == 0, 0.01, posterior))
    rates, share = np.full((2, cast.shape[1]), 0.5), 0.5
    for _ in range(steps):
        for c, mass in enumerate((counts * (1 - posterior), counts * posterior)):
            rates[c] = (mass @ cast + 0.5) / (mass @ voted + room)
        share = (counts @ posterior + 1.0) / (counts.sum() + 2.0)
        logs = [np.log(p) + cast @ np.log(rates[c]) for c, p in ((0, 1 - share), (1, share))]
        posterior = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
    return posterior, rates, share


def _posteriors(votes: DataFrame, task: str, places: tuple[tuple[int, int], ...]) -> DataFrame:
    """(votes, label, posterior) of every pattern that occurs; ``places``: each labeller's first bit and largest vote."""
    column = f"{task}_votes"
    found = votes.groupBy(column, f"{task}_label").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per pattern
    if not found:
        return votes.sparkSession.createDataFrame([], f"{column} int, {task}_label int, {task} double")
    patterns = np.array([[r[0] >> first & most for first, most in places] + [-1 if r[1] is None else r[1]] for r in found])
    posterior, _, _ = expectation_maximisation(patterns, np.array([float(r[2]) for r in found]))
    return votes.sparkSession.createDataFrame([(r[0], r[1], float(p)) for r, p in zip(found, posterior, strict=True)],
                                              f"{column} int, {task}_label int, {task} double")


def _bounded(rows: DataFrame) -> DataFrame:
    """At most SAMPLE_ROWS rows (doc_id, ...): those whose seeded hash is below the bound's share, by doc_id."""
    total = rows.count()
    if total <= SAMPLE_ROWS:
        return rows
    share = 0.95 * SAMPLE_ROWS / total
    return rows.filter(F.xxhash64("doc_id", F.lit(SEED)).cast("double") / float(2**64) + 0.5 < share).limit(SAMPLE_ROWS)


def train(docs: DataFrame, labels: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, float]]:
    """The scorer: per task sorted feature hashes, weights, bias."""
    gold = stage(labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast(id_kind(docs)).alias("doc_id")).agg(
        (1 - F.min("quality")).cast("int").alias("junk_label"), F.max("toxic").cast("int").alias("toxic_label")), "gold")
    both = gold.filter("junk_label in (0, 1) and toxic_label in (0, 1)")
    cues = _fit(docs, _bounded(both.select("doc_id", F.lit(None).cast("long").alias("key"), F.col("junk_label").cast("double").alias("junk"), F.col("toxic_label").cast("double").alias("toxic"))), "cues")
    votes = stage(docs.select(F.col("doc_id").cast(id_kind(docs)).alias("doc_id"), _key().alias("key"), "text")
                  .mapInArrow(_vote_batches(cues), f"doc_id {id_kind(docs)}, key long, junk_votes int, toxic_votes int"), "votes")
    known = votes.join(both, "doc_id", "left")
    weak = known
    for task, places in (("junk", tuple((i, 1) for i in range(len(STYLE) + 1))), ("toxic", ((0, 1), (1, 3)))):
        p = _posteriors(known, task, places)
        weak = weak.join(F.broadcast(p.withColumnsRenamed({f"{task}_votes": f"{task}_v", f"{task}_label": f"{task}_l"})),
                         (F.col(f"{task}_votes") == F.col(f"{task}_v")) & F.col(f"{task}_label").eqNullSafe(F.col(f"{task}_l"))).drop(f"{task}_v", f"{task}_l")
    worst = F.max(F.struct(F.greatest(*TASKS).alias("most"), *TASKS, "key"))  # of the texts of a doc_id: the worst, with its own posteriors
    rows = weak.filter("doc_id is not null").groupBy("doc_id").agg(worst.alias("w")).select("doc_id", "w.key", *[f"w.{t}" for t in TASKS])
    return _fit(docs, _bounded(stage(rows, "posteriors")), "counts")


def _score_batches(model: dict) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = batch.column("text")
            out = np.zeros((len(texts), len(TASKS)))
            for a, b, features, owner, share in _each_chunk(texts):
                for t, task in enumerate(TASKS):
                    out[a:b, t] = _margins(model[task], features, owner, share)
                out[a:b, 0] = np.where(share[:, 0] < 0, np.maximum(out[a:b, 0], 1.0), out[a:b, 0])
            columns = [pa.array(out[:, t]) for t in range(len(TASKS))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "__junk", "__toxic"])

    return score


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of ``docs`` plus __junk and __toxic (log odds; ``CUTS`` decide)."""
    bound_batches(docs)
    schema = T.StructType([*docs.schema.fields, T.StructField("__junk", T.DoubleType()), T.StructField("__toxic", T.DoubleType())])
    return docs.mapInArrow(_score_batches(train(docs, labels)), schema)


def _kept() -> Column:
    return (F.col("__junk") < CUTS["junk"]) & (F.col("__toxic") < CUTS["toxic"])


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, junk_score, toxic_score, keep for every row."""
    return scored(docs.select("doc_id", "text"), labels).select(
        "doc_id", F.col("__junk").alias("junk_score"), F.col("__toxic").alias("toxic_score"),
        _kept().alias("keep"))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that both scores keep; all columns stay."""
    return scored(docs, labels).filter(_kept()).drop("__junk", "__toxic")
