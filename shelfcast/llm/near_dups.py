"""Near duplicates by Order MinHash, verified by banded alignment.

Two texts are linked when their word edit similarity (1 - edits / words of the longer one) is 0.8
or more; classes are the connected components, and equal texts are always of one class.

1. Equal texts are one node (md5).  Each node's 5-word shingles get occurrence labels; each of
   ``SKETCHES`` seeded orders picks the ``PICKS`` smallest labelled shingles, kept in text order:
   a bucket key.  For words changed at random places the chance that two texts share a bucket is
   above 0.999 up to 9 % of changed words, 0.99 at 12 %, 0.93 at 15 % and 0.73 at 20 %; changes in regular
   steps leave fewer shingles (one word in 10: 0.98, one in 8: 0.82).
2. Every bucket is a star: its hub (the member with most bucket mates) is paired with the other
   members, so a bucket of n texts gives n - 1 pairs.  Verified links give components.
3. What the hubs missed: buckets that still hold several components are compared in blocks of
   ``BLOCK`` members, those outside the bucket's main component against all, by counting shared
   occurrence-labelled runs of ``RUN`` words in a task: an edit takes at most ``RUN`` of them, so every
   link has at least n - RUN + 1 - RUN * edits (exact up to ``SAMPLE`` words a text, else bottom-k
   samples with a six-sigma margin).  Texts of up to ``SAMPLE`` words are aligned there too.  A task only
   returns pairs that join components, so a family of n copies gives in the order of n pairs; buckets of
   refused pairs are compared again.

Verification: texts of candidate nodes only; members meet their hub in groups of about
``GROUP_WORDS`` words (a hot hub is many groups), words are hashed per Arrow batch, pairs below the
shared-word bound go, and the alignment is a furthest-reaching search over a band of diagonals that
grows with the edits; its memory is linear in the texts.  Blocks align texts of up to ``SAMPLE`` words
bit-parallel, with a text's bit masks made once for all its candidates.

Defined results: null text counts as empty; texts without words equal only their like; texts
under five words are one shingle; null doc_ids are classed by text, with the least doc_id of
the class (null if it has none); ids that are no whole numbers are compared as text; repeated rows appear as often as in the input; empty tables
give empty results.  Extra columns are ignored by ``classes`` and kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, carried, id_kind, stage
from .wordhash import U, byte_slices, mix, shingle_hashes, word_hashes

SHINGLE = 5
THRESHOLD = 0.8       # edit similarity
SKETCHES = 32
PICKS = 2
RUN = 3               # words of a run that block comparisons count
SAMPLE = 4096         # words, or runs of a longer text, that represent it in block comparisons
BLOCK = 1024          # members compared with as many others in one task
SHARED_IDS = 1024     # shared runs of a block counted at once (bounds the dense matrices)
GROUP_WORDS = 200_000
SLICE_BYTES = 4 << 20   # text hashed at once (bounds the temporary arrays)
RUN_CELLS = 1 << 16    # words compared at once in an alignment
CHUNK_WORDS = 1 << 18  # words sketched at once (bounds the temporary arrays)
SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=U) * U(0x632BE59BD9B4E019))


def text_key():
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


# ------------------------------------------------------------------ sketches

def _labelled_hashes(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes of (value, the how-manieth of its like it is within its row)."""
    own = values ^ mix(row.astype(U) + U(77))
    order = np.argsort(own, kind="stable")
    fresh = np.ones(len(own), dtype=bool)
    fresh[1:] = own[order][1:] != own[order][:-1]
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(own)), 0))
    occurrence = np.empty(len(own), dtype=U)
    occurrence[order] = (np.arange(len(own)) - begin).astype(U)
    return mix(values + occurrence * U(0xD6E8FEB86659FD93))


def _sketch(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order MinHash keys (rows x SKETCHES) and shingle counts."""
    rows = len(bounds) - 1
    sh, at = shingle_hashes(words, bounds, SHINGLE)
    counts = np.diff(at)
    keys = np.zeros((rows, SKETCHES), dtype=U)
    full = np.flatnonzero(counts > 0)
    if not len(full):
        return keys, counts
    labelled = _labelled_hashes(sh, np.repeat(np.arange(rows), counts))
    starts, where, top = at[:-1][full], np.arange(len(labelled)), U(0xFFFFFFFFFFFFFFFF)
    inner = np.repeat(np.arange(len(full)), counts[full])
    for j, seed in enumerate(SEEDS):
        v = mix(labelled ^ seed)
        values, places = np.zeros((PICKS, len(full)), dtype=U), np.zeros((PICKS, len(full)), dtype=np.int64)
        for k in range(PICKS):
            least = np.minimum.reduceat(v, starts)
            hit = np.flatnonzero(v == least[inner])
            places[k, inner[hit][::-1]] = where[hit][::-1]
            spent = counts[full] <= k  # a text with fewer shingles has no k-th pick
            values[k], places[k] = np.where(spent, U(0), least), np.where(spent, len(labelled) + k, places[k])
            v[places[k][~spent]] = top
        text_order = np.argsort(places, axis=0, kind="stable")
        key = np.full(len(full), j + 1, dtype=U)
        for k in range(PICKS):
            key = mix(key * U(3) + np.take_along_axis(values, text_order[k:k + 1], 0)[0])
        keys[full, j] = key
    return keys, counts


def _chunks(bounds: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` words (a longer row is a range of its own)."""
    a = 0
    while a < len(bounds) - 1:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + size, side="right")) - 1)
        yield a, b
        a = b


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in byte_slices(whole, SLICE_BYTES)):
        words, bounds = word_hashes(batch.column("text"))
        for a, b in _chunks(bounds, CHUNK_WORDS):
            keys, counts = _sketch(words[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
            rows = b - a
            keys_list = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(counts > 0, SKETCHES, 0))]).astype(np.int32)),
                pa.array(keys[counts > 0].reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, rows), batch.column("key").slice(a, rows),
                 pa.array((bounds[a + 1:b + 1] - bounds[a:b]).astype(np.int64)), keys_list],
                names=["doc_id", "key", "n_words", "buckets"])


def sketches(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, key, n_words, buckets."""
    bound_batches(docs)
    kind = id_kind(docs)
    keyed = docs.select(F.col("doc_id").cast(kind), text_key().alias("key"), "text")
    return keyed.mapInArrow(_sketch_batches, f"doc_id {kind}, key binary, n_words long, buckets array<long>")


# ------------------------------------------------------------------ verification

def edit_similarity(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """1 - edit distance / longer length by a banded furthest-reaching search; 0 if surely below ``threshold``."""
    n, m = len(a), len(b)
    longest = max(n, m)
    if longest == 0:
        return 1.0
    limit = int(np.floor(longest * (1 - threshold) + 1e-9))
    if abs(n - m) > limit:
        return 0.0
    d = _banded_distance(a, b, limit)
    return 1 - d / longest if d <= limit else 0.0


def _extend(a: np.ndarray, b: np.ndarray, x: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Where the runs of equal words end that begin at a[x], b[x + k]: compared in growing chunks."""
    x, end = x.copy(), np.minimum(len(a), len(b) - k)
    open_, width = np.flatnonzero(x < end), 1
    while len(open_):
        width = max(1, min(width, RUN_CELLS // len(open_)))
        at = x[open_, None] + np.arange(width)
        same = at < end[open_, None]
        same &= a[np.minimum(at, len(a) - 1)] == b[np.minimum(at + k[open_, None], len(b) - 1)]
        whole = same.all(axis=1)
        x[open_] += np.where(whole, width, np.argmin(same, axis=1))
        open_ = open_[whole & (x[open_] < end[open_])]
        width *= 8
    return x


def _banded_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Edit distance, or limit + 1: furthest-reaching steps over the diagonals that ``limit`` edits can still use.

    After d edits those are -d..d, and at most limit - d away from the last word's; memory is linear in ``limit``.
    """
    n, m = len(a), len(b)
    target, low = m - n, -(1 << 40)
    reach = np.full(2 * limit + 3, low, dtype=np.int64)  # of diagonal k at k + limit + 1
    for d in range(limit + 1):
        first, last = max(-d, target - (limit - d)), min(d, target + (limit - d))
        if first > last:
            break
        k = np.arange(first, last + 1)
        i = first + limit + 1
        j = i + len(k)
        if d == 0:
            got = np.zeros(1, dtype=np.int64)
        else:  # insertion: same x, one diagonal up; deletion: x + 1, one diagonal down; other word: x + 1
            got = np.maximum(np.maximum(reach[i - 1:j - 1], reach[i + 1:j + 1] + 1), reach[i:j] + 1)
            got = np.minimum(got, np.minimum(n, m - k))
        live = np.flatnonzero(got >= np.maximum(0, -k))
        row = np.full(len(k), low, dtype=np.int64)
        row[live] = _extend(a, b, got[live], k[live])
        reach[i:j] = row
        if first <= target <= last and row[target - first] >= n:
            return d
    return limit + 1


def _bit_masks(a: np.ndarray) -> dict[int, int]:
    """For each word of ``a`` the places where it stands, as the bits of a number."""
    masks: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def _bit_distance(masks: dict[int, int], n: int, b: list[int], limit: int) -> int:
    """Edit distance of the ``n`` words of ``masks`` and ``b`` (Myers' bit vectors), or limit + 1."""
    if not n or not b:
        return min(max(n, len(b)), limit + 1)
    every, last, d, left = (1 << n) - 1, 1 << (n - 1), n, len(b)
    up, down, none = every, 0, masks.get
    for w in b:
        eq = none(w, 0)
        x = eq | down
        eq |= ((eq & up) + up) ^ up
        more, less = down | (every & ~(eq | up)), up & eq
        if more & last:
            d += 1
        elif less & last:
            d -= 1
        left -= 1
        if d - left > limit:  # no later word can bring it down enough
            return limit + 1
        more = more << 1 | 1
        up, down = (less << 1 | ~(x | more)) & every, more & x & every
    return d


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (centre, part, member first null): the centre's text, then its members'."""
    centre = None
    for batch in (part for whole in batches for part in byte_slices(whole, SLICE_BYTES)):
        words, bounds = word_hashes(batch.column("text"))
        labelled = _labelled_hashes(words, np.repeat(np.arange(len(batch)), np.diff(bounds)))
        left, member = batch.column("centre").to_pylist(), batch.column("member").to_pylist()
        out: tuple[list, list, list] = ([], [], [])
        for i, m in enumerate(member):
            w, s = words[bounds[i]:bounds[i + 1]].copy(), np.sort(labelled[bounds[i]:bounds[i + 1]])
            if m is None:
                centre = (left[i], w, s)
                continue
            name, cw, cs = centre
            longest = max(len(cw), len(w))
            if longest == 0 or min(len(cw), len(w)) < THRESHOLD * longest - 1e-9 or len(np.intersect1d(cs, s)) < THRESHOLD * longest - 1e-9:
                continue
            similarity = edit_similarity(cw, w, THRESHOLD)
            if similarity >= THRESHOLD - 1e-9:
                for column, value in zip(out, (name, m, similarity), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.float64())],
                                         names=["a", "b", "similarity"])


def verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b, similarity) among ``pairs`` (centre, member); nodes: key, n_words; texts: key, text."""
    sized = pairs.join(nodes.select(F.col("key").alias("member"), "n_words"), "member")
    parts = sized.groupBy("centre").agg(F.ceil(F.sum("n_words") / GROUP_WORDS).cast("int").alias("parts"))
    members = sized.join(parts, "centre").select(
        "centre", F.pmod(F.xxhash64("member"), F.greatest("parts", F.lit(1))).cast("int").alias("part"), "member")
    centres = members.select("centre", "part").distinct().withColumn("member", F.lit(None).cast("binary"))
    wanted = members.select("centre", "part", "member", F.col("member").alias("key")).unionByName(
        centres.withColumn("key", F.col("centre")))
    rows = (wanted.join(texts, "key").select("centre", "part", "member", "text")
            .repartition("centre", "part").sortWithinPartitions("centre", "part", F.col("member").asc_nulls_first()))
    return rows.mapInArrow(_verify_batches, "a binary, b binary, similarity double")


# ------------------------------------------------------------------ components

def components(links: DataFrame) -> DataFrame:
    """node, label (least node of its component) of every linked node: min-label steps with pointer jumps."""
    edges = stage(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                  .unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "edges")
    labels = stage(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
                   .select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        heard = (edges.join(labels.select(F.col("node").alias("v"), "label"), "v")
                 .groupBy(F.col("u").alias("node")).agg(F.min("label").alias("heard")))
        step = labels.join(heard, "node").select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        after = stage(step.join(up, "label").select("node", "old", F.least("label", "jump").alias("label")), "labels")
        labels = after.select("node", "label")
        if after.filter("old <> label").limit(1).count() == 0:
            return labels


def _joined(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels`` after further links: steps are made over the components that these join, not over all links."""
    ends = found.select("a", "b")
    for c in ("a", "b"):
        ends = ends.join(labels.select(F.col("node").alias(c), "label"), c, "left").withColumn(c, F.coalesce("label", c)).drop("label")
    moved = components(stage(ends.filter("a <> b").distinct(), "joined")).select(F.col("node").alias("label"), F.col("label").alias("least"))
    fresh = found.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti")
    known = labels.unionByName(fresh.withColumn("label", F.col("node")))
    return stage(known.join(moved, "label", "left").select("node", F.coalesce("least", "label").alias("label")), "labels")


def _labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """nodes plus ``comp``: their component, themselves when unlinked."""
    return nodes.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("label", "key")).drop("label")


def _star_pairs(members: DataFrame) -> DataFrame:
    """(centre, member) over buckets (bucket, key, n mates): the member with most mates in all its buckets is the hub."""
    degree = members.groupBy("key").agg(F.sum("n").alias("degree"))
    ranked = members.join(degree, "key")
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("degree", "key")).alias("hub")).select("bucket", F.col("hub.key").alias("centre"))
    return members.join(hubs, "bucket").filter(F.col("key") != F.col("centre")).select("centre", F.col("key").alias("member")).distinct()


def _sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words of each text, and its words in order (31 bits each), or its least ``SAMPLE`` runs (two halves each) if there are more."""
    for batch in (part for whole in batches for part in byte_slices(whole, SLICE_BYTES)):
        words, bounds = word_hashes(batch.column("text"))
        codes = (words >> U(33)).astype(np.int32)
        sent = [codes[a:b] if b - a <= SAMPLE else _run_sets([codes[a:b]])[0][:SAMPLE].view(np.int32) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(sent, pa.list_(pa.int32()))],
                                         names=["key", "n", "sample"])


def _run_sets(lists: list[np.ndarray], run: int = RUN) -> list[np.ndarray]:
    """Sorted hashes (63 bits) of each text's occurrence-labelled runs of ``run`` words."""
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    runs, at = shingle_hashes(np.concatenate(lists).astype(U), bounds, run)
    labelled = (_labelled_hashes(runs, np.repeat(np.arange(len(lists)), np.diff(at))) >> U(1)).astype(np.int64)
    return [np.sort(labelled[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def _shared(sets: list[np.ndarray], u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """How many members each set of ``u`` shares with each of ``v`` (places in ``sets``)."""
    ids, at = np.unique(np.concatenate(sets), return_inverse=True)
    shared_ids = np.bincount(at, minlength=len(ids)) > 1
    column = np.where(shared_ids, np.cumsum(shared_ids) - 1, -1)[at]
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    keep = column >= 0
    column, owner = column[keep], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common, width = np.zeros((len(u), len(v)), dtype=np.float32), SHARED_IDS
    for c in range(0, int(shared_ids.sum()), width):
        a, b = np.searchsorted(column, [c, c + width])
        dense = np.zeros((len(sets), width), dtype=np.float32)
        dense[owner[a:b], column[a:b] - c] = 1
        common += dense[u] @ dense[v].T
    return common


def _likely(rows: list[dict], u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared runs of each pair, and whether they (and the shared words) are as many as a link has."""
    short = [r["n"] <= SAMPLE for r in rows]
    made = iter(_run_sets([np.zeros(0, np.int32), *(r["sample"] for r, s in zip(rows, short, strict=True) if s)])[1:])
    sets = [next(made) if s else r["sample"].view(np.int64) for r, s in zip(rows, short, strict=True)]
    common, near = _shared(sets, u, v), np.zeros((len(u), len(v)), dtype=bool)
    whole, sizes = np.array(short), np.array([r["n"] for r in rows])

    def bounds(i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        longest = np.maximum(sizes[i], sizes[v])
        return longest, np.minimum(sizes[i], sizes[v]), np.floor(longest * (1 - THRESHOLD) + 1e-9)

    for x, i in enumerate(u):
        longest, shortest, edits = bounds(i)
        needed, exact = longest - RUN + 1 - RUN * edits, whole[v] & whole[i]
        near[x] = (shortest >= THRESHOLD * longest - 1e-9) & (~exact | (common[x] >= needed))
        for y in np.flatnonzero(near[x] & ~exact):  # only up to the smaller of the two largest sampled hashes
            pair = sets[i], sets[v[y]]
            top = min(p[-1] for p, k in zip(pair, (i, v[y]), strict=True) if not whole[k])
            union = max(sum(int(np.searchsorted(p, top, "right")) for p in pair) - common[x, y], 1)
            least = needed[y] / (longest[y] + shortest[y] - 2 * (RUN - 1) - needed[y])
            near[x, y] = common[x, y] / union >= least - 6 * np.sqrt(least * (1 - least) / union)
    # what is left, by single words: an edit takes one
    us, vs = np.flatnonzero((near & whole[v]).any(axis=1) & whole[u]), np.flatnonzero((near & whole[u][:, None]).any(axis=0) & whole[v])
    if len(us) and len(vs):
        some = np.unique(np.concatenate([u[us], v[vs]]))
        words = _shared(_run_sets([rows[k]["sample"] for k in some], 1), np.searchsorted(some, u[us]), np.searchsorted(some, v[vs]))
        for x, got in zip(us, words, strict=True):
            longest, _, edits = bounds(u[x])
            near[x, vs] &= got >= (longest - edits)[vs]
    return common, near


def _joining_pairs(rows: list[dict]) -> list[tuple[bytes, bytes]]:
    """Pairs (u, v) of a block that share the runs that a link needs, and that join components."""
    u = np.array([i for i, r in enumerate(rows) if r["asks"] or (r["asks"] is None and r["rest"])], dtype=np.int64)
    v = np.array([i for i, r in enumerate(rows) if not r["asks"]], dtype=np.int64)  # a row stands on one side, or on both
    if not len(u) or not len(v):
        return []
    common, near = _likely(rows, u, v)
    parent = {r["comp"]: r["comp"] for r in rows}

    def root(c: bytes) -> bytes:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out = []
    for x, i in enumerate(u):
        a, masks = rows[i], None
        refused, found = a["refused"] or (), np.flatnonzero(near[x])
        for y in found[np.argsort(-common[x, found], kind="stable")].tolist():
            b = rows[v[y]]
            ra, rb = root(a["comp"]), root(b["comp"])
            if ra == rb or b["key"] in refused or (b["rest"] and a["key"] > b["key"]):
                continue
            exact = a["n"] <= SAMPLE and b["n"] <= SAMPLE
            if exact:
                masks = masks or _bit_masks(a["sample"])
                limit = int(max(a["n"], b["n"]) * (1 - THRESHOLD) + 1e-9)
                if _bit_distance(masks, a["n"], b["sample"].tolist(), limit) > limit:
                    continue
                parent[ra] = rb
            out.append((a["key"], b["key"]))
    return out


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, ub, vb): the pairs of each block."""
    current, rows = None, []

    def pairs() -> pa.RecordBatch:
        got = _joining_pairs(rows)
        return pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], pa.binary()) for i in (0, 1)], names=["centre", "member"])

    for batch in batches:
        lists = batch.column("sample")
        words, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        for i, row in enumerate(batch.drop_columns(["sample"]).to_pylist()):
            row["sample"] = words[ends[i]:ends[i + 1]].copy()
            name = row["bucket"], row["ub"], row["vb"]
            if name != current and rows:
                yield pairs()
                rows = []
            current = name
            rows.append(row)
    if rows:
        yield pairs()


def _rest_pairs(members: DataFrame, texts: DataFrame, refused: DataFrame) -> DataFrame:
    """Pairs that join components of a bucket: (bucket, key, comp) outside the bucket's main component against all.

    A bucket of one block sends each member once; in larger ones the two sides are sent apart.
    """
    split = members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("m"))
    main = (split.groupBy("bucket").agg(F.max(F.struct("m", "comp")).alias("x"), F.count(F.lit(1)).alias("comps"), F.sum("m").alias("all"))
            .filter("comps > 1").select("bucket", F.col("x.comp").alias("main"), F.ceil((F.col("all") - F.col("x.m")) / BLOCK).cast("int").alias("us"),
                                        F.ceil(F.col("all") / BLOCK).cast("int").alias("vs")))
    held = stage(members.join(main, "bucket").withColumn("rest", F.col("comp") != F.col("main")), "rest")
    samples = stage(texts.join(held.select("key").distinct(), "key", "left_semi").mapInArrow(_sample_batches, "key binary, n long, sample array<int>"), "samples")
    no = refused.groupBy(F.col("a").alias("key")).agg(F.collect_set("b").alias("refused"))
    full = held.join(samples, "key").join(no, "key", "left")
    spot = lambda n, salt: F.pmod(F.xxhash64("key", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    same = ["key", "comp", "n", "sample", "rest", "refused"]
    one, zero = (F.col("us") == 1) & (F.col("vs") == 1), F.lit(0)
    single = full.filter(one).select("bucket", zero.alias("ub"), zero.alias("vb"), F.lit(None).cast("boolean").alias("asks"), *same)
    u = full.filter(~one & F.col("rest")).select("bucket", spot("us", 1).alias("ub"), every("vs").alias("vb"), F.lit(True).alias("asks"), *same)
    v = full.filter(~one).select("bucket", every("us").alias("ub"), spot("vs", 2).alias("vb"), F.lit(False).alias("asks"), *same)
    return (single.unionByName(u).unionByName(v).repartition("bucket", "ub", "vb").sortWithinPartitions("bucket", "ub", "vb")
            .mapInArrow(_block_batches, "centre binary, member binary").distinct())


def links_and_labels(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches per document; (key, doc_id, n_words, comp) per distinct text; links."""
    rows = stage(sketches(docs), "sketches")
    nodes = stage(rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("buckets").alias("buckets")), "nodes")
    buckets = nodes.select("key", F.explode("buckets").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stage(buckets.join(shared, "bucket"), "buckets")
    ids = members.select("key").distinct().join(nodes.select("key", F.col("doc_id").alias("rep")), "key")
    # one text per node of a shared bucket
    texts = stage(docs.select(text_key().alias("key"), F.col("doc_id").cast(id_kind(docs)).alias("rep"), F.coalesce("text", F.lit("")).alias("text"))
                  .join(ids.withColumnsRenamed({"key": "want", "rep": "want_rep"}), (F.col("key") == F.col("want")) & F.col("rep").eqNullSafe(F.col("want_rep")), "left_semi")
                  .select("key", "text").dropDuplicates(["key"]), "texts")
    links = stage(verified(stage(_star_pairs(members), "pairs"), nodes, texts), "links")
    labels = components(links)
    open_, refused = members.select("bucket", "key"), links.select("a", "b").limit(0)
    while True:
        pairs = stage(_rest_pairs(_labelled(open_, labels), texts, refused), "pairs")
        if pairs.limit(1).count() == 0:
            break
        found = stage(verified(pairs, nodes, texts), "links")
        links = links.unionByName(found)
        labels = _joined(labels, found)
        # a pair that a task took for a link may have hidden others of its bucket: those buckets are compared again without it
        wrong = stage(pairs.join(found, (F.col("centre") == F.col("a")) & (F.col("member") == F.col("b")), "left_anti"), "refused")
        if wrong.limit(1).count() == 0:
            break
        refused = refused.unionByName(wrong.select(F.col("centre").alias("a"), F.col("member").alias("b"))).unionByName(
            wrong.select(F.col("member").alias("a"), F.col("centre").alias("b")))
        again = members.join(refused.select(F.col("a").alias("key")).distinct(), "key", "left_semi").select("bucket").distinct()
        open_ = members.join(again, "bucket", "left_semi").select("bucket", "key")
    return rows, _labelled(nodes.select("key", "doc_id", "n_words"), labels), links


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), class_size (documents) for every row of ``docs``."""
    rows, nodes, _ = links_and_labels(docs)
    least = nodes.groupBy("comp").agg(F.min("doc_id").alias("class_id"))
    named = stage(nodes.join(least, "comp").select("key", "comp", "class_id"), "classes")
    counted = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(named, "key")
    sizes = counted.groupBy("comp").agg(F.sum("n").alias("class_size"))
    per_key = named.join(sizes, "comp").select("key", "class_id", "class_size")
    return rows.select("doc_id", "key").join(per_key, "key").select("doc_id", "class_id", "class_size")


def dedup(docs: DataFrame) -> DataFrame:
    """One row per class: the row with the least doc_id (all columns kept); text is shuffled once."""
    _, nodes, _ = links_and_labels(docs)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    keep = stage(nodes.groupBy("comp").agg(F.min_by("key", order).alias("key")).select("key"), "kept-texts")
    row = docs.select(text_key().alias("__key"), carried(docs).alias("__row"), F.col("doc_id").alias("__id"))
    first = row.groupBy("__key").agg(F.min_by("__row", F.struct(F.col("__id").isNull(), F.col("__id"), F.xxhash64("__row"))).alias("__row"))
    return first.join(keep, F.col("__key") == keep["key"], "left_semi").select("__row.*")
