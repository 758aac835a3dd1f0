"""LM scoring: a Katz backoff bigram model over all documents.

P(w | h) = d(c(h w)) c(h w) / c(h) when the bigram was seen in training, else
alpha(h) P(w); P(w) = d(c(w)) c(w) / N when the word was seen, else the mass that the discounts
leave to the one unknown type.  d is the Good-Turing discount for counts up to ``K`` (absolute
discounting where the count-of-counts are irregular, ``LARGE`` above K, so that every context
keeps some mass); alpha(h) makes P(. | h) sum to exactly 1 over the training types and the
unknown type.  Each text ends with an end token and starts after a start context.

1. Texts become blocks of about ``BLOCK_TOKENS`` tokens: a bucketed table of sorted distinct word
   hashes and token numbers, so that later steps meet a block's rows without moving it.
2. Blocks send their distinct words with training counts to hash buckets, which add up
   counts, number the words and answer every block with its words' totals and numbers (and
   the count-of-counts).
3. Blocks send their distinct bigrams, grouped by context, to buckets by context hash (frequent
   contexts are spread by bigram), which add up counts and answer with totals and, for contexts
   with unseen bigrams, the sums that alpha needs.
4. Each block evaluates its tokens recursively from those answers.
Counts and answers are staged tables partitioned by bucket.

Defined results: null text is empty (its end token alone); null doc_ids train; repeated rows are
separate texts; with no training text at all every probability is that of the unknown type
(score 0); an empty table gives an empty result.  Extra columns are ignored.

Scale: every n-gram moves once per block that holds it, packed; hot n-grams have at most one
entry per block and hot contexts are dealt by bigram.  The driver sees sums and at most
``HOT_CONTEXTS`` contexts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_root
from .common import id_kind, stage
from .wordhash import U, byte_slices, mix, word_hashes

BLOCK_TOKENS = 400_000
BUCKET_TOKENS = 1_500_000   # training and held-out tokens per hash bucket, about
TABLE_BLOCKS = 4            # blocks per bucket of the block table
K = 5                       # counts up to K are Good-Turing discounted
LARGE = 0.999               # discount of larger counts
HOT_CONTEXTS = 65_536       # contexts over 1 / HOT_CONTEXTS of all tokens are spread
HOT_TOKENS = 50_000         # and over so many tokens
END = U(0xE0D)              # hash of the end token
STATS = K + 3               # types, tokens, number of types with count 1 .. K + 1
CODEC = pa.Codec("zstd", 1)


def pack(values: np.ndarray, kind: type) -> bytes:
    """Compressed bytes of an array, bytes of equal rank side by side."""
    raw = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize)
    return len(values).to_bytes(8, "little") + CODEC.compress(np.ascontiguousarray(raw.T), asbytes=True)


def unpack(data: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    raw = np.frombuffer(CODEC.decompress(data[8:], n * width, asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(width, n).T).view(kind).reshape(-1) if n else np.zeros(0, kind)


# ------------------------------------------------------------------ discounts

def discounts(of_count: np.ndarray) -> np.ndarray:
    """Factors for counts 0 .. K + 1 (the last for all larger ones) from the numbers of types with count 1 .. K + 1."""
    n = np.asarray(of_count, dtype=float)
    out = np.full(K + 2, LARGE)
    out[0] = 0.0
    absolute = min(max(n[0] / (n[0] + 2 * n[1]), 0.1), 0.9) if n[0] > 0 else 0.5
    common = (K + 1) * n[K] / n[0] if n[0] > 0 else 1.0
    for r in range(1, K + 1):
        d = 0.0
        if n[r - 1] > 0 and common < 1:
            d = ((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common)
        out[r] = d if 0.0 < d < 1.0 else (r - absolute) / r
    return out


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * d[np.minimum(counts, K + 1).astype(np.int64)]


class Unigrams:
    """P(w) from counts: discounted relative frequency, the rest of the mass to the one unknown type."""

    def __init__(self, tokens: int, of_count: np.ndarray, mass_large: float) -> None:
        self.tokens, self.d = tokens, discounts(of_count)
        ranks = np.arange(1, K + 1)
        seen = float((self.d[1:K + 1] * ranks * of_count[:K]).sum()) + LARGE * mass_large
        self.unknown = 1.0 - seen / tokens if tokens else 1.0

    def p(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.d) / max(self.tokens, 1), self.unknown)


# ------------------------------------------------------------------ blocks

def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    serial = TaskContext.get().partitionId() << 32
    for batch in (part for whole in batches for part in byte_slices(whole, 6 * BLOCK_TOKENS)):
        words, bounds = word_hashes(batch.column("text"))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(bounds + np.arange(len(bounds)), bounds[a] + a + BLOCK_TOKENS, side="right")) - 1)
            sizes = np.diff(bounds[a:b + 1]) + 1  # with the end token
            tokens = np.insert(words[bounds[a]:bounds[b]], bounds[a + 1:b + 1] - bounds[a], END)
            vocabulary, ids = np.unique(tokens, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([serial]), pa.array([batch.column("doc_id").slice(a, b - a).to_pylist()], pa.list_(batch.schema.field("doc_id").type)),
                 pa.array([batch.column("held").slice(a, b - a).to_pylist()], pa.list_(pa.bool_())),
                 pa.array([sizes.tolist()], pa.list_(pa.int32())),
                 pa.array([pack(vocabulary, np.uint64)], pa.binary()), pa.array([pack(ids, np.uint32)], pa.binary())],
                names=["block", "doc_ids", "held", "sizes", "vocabulary", "ids"])
            serial, a = serial + 1, b


class Block:
    """A block's tokens: vocabulary hashes, token numbers, bigrams as (context, word) numbers."""

    def __init__(self, row: dict) -> None:
        self.number, self.doc_ids, self.held, self.sizes = row["block"], row["doc_ids"], np.array(row["held"], dtype=bool), np.array(row["sizes"])
        self.vocabulary, self.ids = unpack(row["vocabulary"], np.uint64), unpack(row["ids"], np.uint32).astype(np.int64)
        self.trains = np.repeat(~self.held, self.sizes)
        self.types = len(self.vocabulary)

    def counts(self) -> np.ndarray:
        return np.bincount(self.ids[self.trains], minlength=self.types)

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Context numbers (the start context is ``types``), word numbers, training counts, and each token's bigram."""
        before = np.empty_like(self.ids)
        before[1:] = self.ids[:-1]
        before[np.concatenate([[0], np.cumsum(self.sizes)[:-1]])] = self.types
        pairs, at = np.unique(before * (self.types + 1) + self.ids, return_inverse=True)
        return pairs // (self.types + 1), pairs % (self.types + 1), np.bincount(at[self.trains], minlength=len(pairs)), at


def block_table(docs: DataFrame) -> tuple[str, int, int]:
    """Name of the bucketed block table, its buckets, and the number of tokens."""
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast(id_kind(docs)).alias("doc_id"), "text", held.alias("held")).mapInArrow(
        _block_batches, f"block long, doc_ids array<{id_kind(docs)}>, held array<boolean>, sizes array<int>, vocabulary binary, ids binary")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = int(max(1, -(-size // (6 * BLOCK_TOKENS * TABLE_BLOCKS))))
    name = f"llm_blocks_{uuid.uuid4().hex[:12]}"
    rows.write.bucketBy(width, "block").option("path", f"{work_root(spark)}/shelfcast-llm/{name}").saveAsTable(name)
    tokens = spark.table(name).agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0] or 0
    return name, width, int(tokens)


def _with_answers(blocks: str, width: int, *answers: DataFrame) -> DataFrame:
    """The block table joined with each block's answers (one list per answer table), without moving the blocks."""
    out = answers[0].sparkSession.table(blocks)
    for i, a in enumerate(answers):
        fields = [c for c in a.columns if c != "block"]
        mine = a.repartition(width, "block").groupBy("block").agg(F.collect_list(F.struct(*fields)).alias(f"answers_{i}"))
        out = out.join(mine, "block")
    return out


def _per_bucket(batches: Iterator[pa.RecordBatch], work: Callable[[int, list[dict]], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Calls ``work(bucket, rows)`` for each run of rows of equal bucket."""
    current, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != current and rows:
                yield from work(current, rows)
                rows = []
            current = row["bucket"]
            rows.append(row)
    if rows:
        yield from work(current, rows)


# ------------------------------------------------------------------ words

def _word_requests(bits: int) -> Callable:
    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                counts, bucket = block.counts(), _bucket(block.vocabulary, bits)
                names, starts = np.unique(bucket, return_index=True)  # the vocabulary is sorted, so buckets are runs
                ends = np.append(starts[1:], len(bucket))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.astype(np.int64)), pa.array([block.number] * len(names), pa.int64()),
                     pa.array([pack(block.vocabulary[s:e], np.uint64) for s, e in zip(starts, ends, strict=True)], pa.binary()),
                     pa.array([pack(counts[s:e], np.uint32) for s, e in zip(starts, ends, strict=True)], pa.binary())],
                    names=["bucket", "block", "keys", "counts"])

    return requests


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _stats(totals: np.ndarray) -> list[int]:
    """Types, tokens, types with count 1 .. K + 1."""
    seen = totals[totals > 0].astype(np.int64)
    return [len(seen), int(seen.sum()), *np.bincount(np.minimum(seen, K + 2), minlength=K + 3)[1:K + 2].tolist()]


def _add_words(bucket: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
    keys = [unpack(r["keys"], np.uint64) for r in rows]
    types, at = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(at, weights=np.concatenate([unpack(r["counts"], np.uint32) for r in rows])).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    answers = [pack(totals[at[e - len(k):e]], np.uint64) for k, e in zip(keys, ends, strict=True)]
    # numbers within the bucket rise with the sorted keys: steps pack well
    numbers = [pack(np.diff(at[e - len(k):e], prepend=0), np.uint32) for k, e in zip(keys, ends, strict=True)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, *(r["block"] for r in rows)], pa.int64()), pa.array([bucket] * (len(rows) + 1), pa.int64()),
         pa.array([None, *answers], pa.binary()), pa.array([None, *numbers], pa.binary()),
         pa.array([[*_stats(totals), len(types)], *[None] * len(rows)], pa.list_(pa.int64()))],
        names=["block", "bucket", "totals", "numbers", "stats"])


def _sums(answers: DataFrame) -> np.ndarray:
    row = answers.filter("block = -1").agg(*[F.sum(F.col("stats")[i]) for i in range(STATS)]).first()
    return np.array([x or 0 for x in row], dtype=np.int64)


class Types:
    """Numbers of all words of the corpus: where each bucket's begin, and the packed type that holds them."""

    def __init__(self, words: DataFrame) -> None:
        rows = sorted(words.filter("block = -1").select("bucket", F.col("stats")[STATS].alias("n")).collect())  # a row per bucket
        self.buckets = np.array([r[0] for r in rows], dtype=np.int64)
        ends = np.cumsum([r[1] for r in rows]).astype(np.int64)
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.start_context = int(ends[-1]) if len(ends) else 0
        self.kind = np.uint32 if self.start_context < 2**32 - 1 else np.uint64

    def of(self, answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """Totals and numbers of a block's words from its answers in bucket order: aligned with its vocabulary."""
        answers = sorted(answers, key=lambda a: a["bucket"])
        totals = [unpack(a["totals"], np.uint64) for a in answers]
        numbers = [np.cumsum(unpack(a["numbers"], np.uint32).astype(np.int64)) + self.starts[np.searchsorted(self.buckets, a["bucket"])] for a in answers]
        return np.concatenate(totals).astype(np.int64), np.concatenate(numbers).astype(U)


# ------------------------------------------------------------------ bigrams

def _bigram_order(block: Block, types: Types, word_totals: np.ndarray, numbers: np.ndarray, starts: int, tokens: int, bits: int) -> tuple:
    """Bigrams and their order by (bucket, context): context and word number, both totals, training count, bucket, order."""
    context, word, count, at = block.bigrams()
    names, totals = np.append(numbers, U(types.start_context)), np.append(word_totals, starts)
    h, w = names[context], numbers[word]
    hot = totals[context] > max(HOT_TOKENS, tokens // HOT_CONTEXTS)
    bucket = _bucket(np.where(hot, mix(mix(h + U(1)) + w), mix(h + U(1))), bits)
    order = np.lexsort((context, bucket))
    return h, w, totals[context], word_totals[word], count, hot, bucket, order, at


def _bigram_requests(types: Types, starts: int, tokens: int, bits: int) -> Callable:
    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                h, w, ch, cw, count, hot, bucket, order, _ = _bigram_order(block, types, *types.of(row["answers_0"]), starts, tokens, bits)
                h, w, ch, cw, count, hot, bucket = (x[order] for x in (h, w, ch, cw, count, hot, bucket))
                names, first = np.unique(bucket, return_index=True)
                out = []
                for s, e in zip(first, np.append(first[1:], len(bucket)), strict=True):
                    run = np.flatnonzero(np.append(True, h[s + 1:e] != h[s:e - 1])) + s
                    out.append((pack(h[run], types.kind), pack(np.diff(np.append(run, e)), np.uint32), pack(hot[run], np.uint8), pack(w[s:e], types.kind),
                                pack(cw[s:e], np.uint64), pack(count[s:e], np.uint32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.astype(np.int64)), pa.array([block.number] * len(names), pa.int64()), *[pa.array(list(c), pa.binary()) for c in zip(*out, strict=True)]],
                    names=["bucket", "block", "contexts", "runs", "hot", "words", "word_counts", "counts"])

    return requests


BIGRAM_SCHEMA = "bucket long, block long, contexts binary, runs binary, hot binary, words binary, word_counts binary, counts binary"
MASS = K + 2  # of a context: types with count 1 .. K, the sum of larger counts, the sum of P(w) over its types


def _add_bigrams(unigrams: Unigrams, kind: type) -> Callable:
    def add(bucket: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        parts = [(unpack(r["contexts"], kind).astype(U), unpack(r["runs"], np.uint32).astype(np.int64), unpack(r["hot"], np.uint8).astype(bool),
                  unpack(r["words"], kind).astype(U), unpack(r["word_counts"], np.uint64), unpack(r["counts"], np.uint32)) for r in rows]
        h = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        hot = np.concatenate([np.repeat(p[2], p[1]) for p in parts])
        words, cw, counts = (np.concatenate([p[i] for p in parts]) for i in (3, 4, 5))
        _, first, at = np.unique(mix(h + U(1)) + mix(words * U(2) + U(1)) * U(3), return_index=True, return_inverse=True)
        totals = np.bincount(at, weights=counts).astype(np.int64)
        # per context: what its seen bigrams hold
        contexts, of = np.unique(h[first], return_inverse=True)
        seen = totals > 0
        mass = np.zeros((len(contexts), MASS))
        small = seen & (totals <= K)
        np.add.at(mass, (of[small], totals[small] - 1), 1.0)
        big = seen & (totals > K)
        mass[:, K] = np.bincount(of[big], weights=totals[big], minlength=len(contexts))
        mass[:, K + 1] = np.bincount(of[seen], weights=unigrams.p(cw[first][seen].astype(np.int64)), minlength=len(contexts))
        ends, blocks, answers, masses = 0, [], [], []
        for r, p in zip(rows, parts, strict=True):
            n = len(p[3])
            mine = totals[at[ends:ends + n]]
            ends += n
            run = np.concatenate([[0], np.cumsum(p[1])[:-1]]).astype(np.int64)
            unseen = np.add.reduceat((mine == 0).astype(np.int64), run) > 0  # only these back off
            need = np.searchsorted(contexts, p[0][unseen])
            blocks.append(r["block"])
            answers.append(pack(mine, np.uint64))
            masses.append(pack(mass[need].reshape(-1), np.float64))
        spread = np.unique(h[hot])
        rows_hot = mass[np.searchsorted(contexts, spread)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *blocks], pa.int64()), pa.array([bucket] * (len(rows) + 1), pa.int64()), pa.array([None, *answers], pa.binary()),
             pa.array([None, *masses], pa.binary()), pa.array([_stats(totals), *[None] * len(rows)], pa.list_(pa.int64())),
             pa.array([spread.view(np.int64).tolist(), *[None] * len(rows)], pa.list_(pa.int64())),
             pa.array([rows_hot.reshape(-1).tolist(), *[None] * len(rows)], pa.list_(pa.float64()))],
            names=["block", "bucket", "totals", "masses", "stats", "hot_contexts", "hot_masses"])

    return add


ANSWER_SCHEMA = "block long, bucket long, totals binary, masses binary, stats array<long>, hot_contexts array<long>, hot_masses array<double>"


# ------------------------------------------------------------------ scores

def _score(unigrams: Unigrams, d: np.ndarray, names: Types, types: int, starts: int, tokens: int, bits: int, hot_table: dict, kind: str) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                word_totals, numbers = names.of(row["answers_0"])
                h, _, ch, cw, _, hot, bucket, order, at = _bigram_order(block, names, word_totals, numbers, starts, tokens, bits)
                replies = sorted(row["answers_1"], key=lambda a: a["bucket"])
                totals = np.empty(len(h), dtype=np.int64)
                totals[order] = np.concatenate([unpack(a["totals"], np.uint64) for a in replies]).astype(np.int64)
                with np.errstate(divide="ignore", invalid="ignore"):
                    p = discounted(totals, d) / ch
                lower = unigrams.p(cw)
                # alpha of contexts with unseen bigrams, in (bucket, context) order
                so, sb, st = h[order], bucket[order], totals[order]
                run = np.flatnonzero(np.append(True, (so[1:] != so[:-1]) | (sb[1:] != sb[:-1])))
                unseen = np.add.reduceat((st == 0).astype(np.int64), run) > 0
                mass = np.concatenate([unpack(a["masses"], np.float64) for a in replies]).reshape(-1, MASS)
                sizes = np.diff(np.append(run, len(so)))
                per_run = np.zeros((len(run), MASS))
                per_run[unseen] = mass
                for i in np.flatnonzero(unseen & hot[order][run]):
                    per_run[i] = hot_table[int(so[run[i]])]
                held = (per_run[:, :K] * d[1:K + 1] * np.arange(1, K + 1)).sum(axis=1) + LARGE * per_run[:, K]
                total = ch[order][run]
                alpha = np.where(total > 0, (1 - held / np.maximum(total, 1)) / (1 - per_run[:, K + 1]), 1.0)
                back = np.empty(len(h))
                back[order] = np.repeat(alpha, sizes)
                p = np.where(totals > 0, p, back * lower)
                each = np.log10(p)[at]
                base = np.log10((word_totals + 1) / (tokens + types + 1))[block.ids]
                ends = np.concatenate([[0], np.cumsum(block.sizes)[:-1]])
                n = len(block.sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.doc_ids, pa.int64() if kind == "long" else pa.string()), pa.array(block.held), pa.array(block.sizes.astype(np.int64)),
                     pa.array(np.add.reduceat((word_totals > 0)[block.ids].astype(np.int64), ends)), pa.array([tokens] * n, pa.int64()),
                     pa.array(np.add.reduceat(base, ends)), pa.array(np.add.reduceat(each, ends))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return score


def _bits(tokens: int) -> int:
    return max(0, int(np.ceil(np.log2(max(1, tokens / BUCKET_TOKENS)))))


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    blocks, width, every = block_table(docs)
    bits = _bits(every)
    table = spark.table(blocks)
    starts = table.agg(F.sum(F.size(F.filter("held", lambda x: ~x)))).first()[0] or 0  # start contexts: training texts

    def by_bucket(requests: DataFrame) -> DataFrame:
        return requests.repartition(1 << bits, "bucket").sortWithinPartitions("bucket")

    asked = table.mapInArrow(_word_requests(bits), "bucket long, block long, keys binary, counts binary")
    words = stage(by_bucket(asked).mapInArrow(lambda b: _per_bucket(b, _add_words), "block long, bucket long, totals binary, numbers binary, stats array<long>"), "word-counts")
    names = Types(words)
    sums = _sums(words)
    types, tokens, of_count = int(sums[0]), int(sums[1]), sums[2:]
    large = tokens - int((of_count[:K] * np.arange(1, K + 1)).sum())
    unigrams = Unigrams(tokens, of_count, float(large))
    word_answers = words.filter("block >= 0").select("block", "bucket", "totals", "numbers")
    asked = _with_answers(blocks, width, word_answers).mapInArrow(_bigram_requests(names, starts, tokens, bits), BIGRAM_SCHEMA)
    bigrams = stage(by_bucket(asked).mapInArrow(lambda b: _per_bucket(b, _add_bigrams(unigrams, names.kind)), ANSWER_SCHEMA), "bigram-counts")
    d = discounts(_sums(bigrams)[2:])
    # masses of spread contexts (at most HOT_CONTEXTS of them), summed over their buckets
    hot = (bigrams.filter("block = -1").select(F.posexplode("hot_contexts").alias("i", "h"), "hot_masses")
           .groupBy("h").agg(*[F.sum(F.get("hot_masses", F.col("i") * MASS + j)).alias(f"m{j}") for j in range(MASS)]).collect())
    hot_table = {int(r[0]) & 0xFFFFFFFFFFFFFFFF: np.array(r[1:], dtype=float) for r in hot}
    both = _with_answers(blocks, width, word_answers, bigrams.filter("block >= 0").select("block", "bucket", "totals", "masses"))
    out = stage(both.mapInArrow(_score(unigrams, d, names, types, starts, tokens, bits, hot_table, id_kind(docs)),
                                f"doc_id {id_kind(docs)}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"), "lm-scores")
    spark.sql(f"DROP TABLE IF EXISTS {blocks}")
    return out
