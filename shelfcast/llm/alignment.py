"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Tokenizer A is a byte-level BPE (space + text), tokenizer B a byte-fallback piece model (which adds the
space); both give the same bytes.

1. Texts are encoded whole; a text over ``SLICE_BYTES`` characters goes in parts cut before single spaces,
   which no token of either side spans.
2. Per slice, ``pandas.merge_asof`` keyed by document gives every A token the B token that covers its
   start, and every B token the A token that covers its start; the union is all overlapping pairs.
   Pairs of equal ends close a group.
3. A document gives its links (all A-B pairs of a group) as distinct id pairs with their numbers;
   blocks of documents give the distinct pairs of the block with the documents that hold them.
4. The blocks' pairs are added up to corpus-wide counts, which go back to the blocks that asked;
   each document looks its pairs up there.

Defined results: null and empty texts, and texts whose tokens don't give their bytes back (such as those that
hold U+2581), have no tokens: zeros and an empty digest; repeated rows count as documents of their
own; a null doc_id is kept; any id type; an empty table gives an empty result.  Extra columns are ignored.

Scale: no text is shuffled.  Links move as distinct pairs of a block (8 bytes and a count), once to the counts
and once back, and as a document's distinct pairs (8 bytes each) to its block's counts.  A task holds a
slice (a long text: a part of it), and one block's pairs; a pair of all documents has a row per block.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stage
from .wordhash import byte_slices

SLICE_BYTES = 1 << 19    # text aligned at once
BLOCK_PAIRS = 200_000    # distinct pairs after which a block of documents is closed
ROW_PAIRS = 10_000       # pairs of a block in one row
B_BITS = 20              # an id pair is (A id << B_BITS) + B id
# a space, and all up to the next space that follows a non-space and is itself followed by one
UNIT = re.compile(r" .*?\S(?= +[^ ])| .*", re.S)
SPACE_MARK = "▁"


# ------------------------------------------------------------------ tokens

def _byte_alphabet() -> dict[str, int]:
    """The byte-level code: printable Latin-1 stands for itself, the other bytes follow from U+0100 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """The two tokenizers: ids of texts, and the bytes of every id.

    A is run from its file's vocabulary as byte-pair ranks, which are its merges in order (checked).
    """

    def __init__(self, path_a: str, path_b: str):
        import public_tokenizers
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        with open(path_a, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary, code = file["model"]["vocab"], _byte_alphabet()
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        ranks = {bytes(code[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in file["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"{path_a}: ids are not in the order of the merges")
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
        for token, i in (*special.items(), *ranks.items()):
            self.bytes_a[i] = token if isinstance(token, bytes) else token.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE_MARK, " ").encode())
            if SPACE_MARK in piece.lstrip(SPACE_MARK):
                raise ValueError(f"{path_b}: a piece spans a word's end")
        self.size_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """A and B ids of texts that begin with the space which B adds; None where their bytes aren't the text's."""
        out = []
        for text, b in zip(texts, self.b.encode([t[1:] for t in texts], num_threads=1), strict=True):
            a, raw = self.a.encode_ordinary(text), text.encode()
            same = b"".join([self.bytes_a[i] for i in a]) == raw and b"".join([self.bytes_b[i] for i in b]) == raw
            out.append((np.array(a, np.int64), np.array(b, np.int64)) if same else None)
        return out


def parts(text: str) -> Iterator[str]:
    """A text cut before spaces that no token of either side spans, in parts of about ``SLICE_BYTES`` characters."""
    at, end = 0, 0
    for unit in UNIT.finditer(text):
        end = unit.end()
        if end - at >= SLICE_BYTES:
            yield text[at:end]
            at = end
    if at < len(text):
        yield text[at:]


# ------------------------------------------------------------------ alignment of a slice

@dataclass
class Aligned:
    """A document (or a part of one): numbers of tokens, groups, links; groups as text; distinct link pairs and their numbers."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: bytes
    pairs: np.ndarray
    times: np.ndarray


NOTHING = Aligned(0, 0, 0, 0, b"", np.zeros(0, np.int64), np.zeros(0, np.int64))


def overlaps(start_a: np.ndarray, start_b: np.ndarray, doc_a: np.ndarray, doc_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (A place, B place) of overlapping tokens, in order.  Starts ascend over the whole slice; every document's first tokens start together."""
    left = pd.DataFrame({"start": start_a, "doc": doc_a, "a": np.arange(len(start_a))})
    right = pd.DataFrame({"start": start_b, "doc": doc_b, "b": np.arange(len(start_b))})
    covers_a = pd.merge_asof(left, right, on="start", by="doc")
    covers_b = pd.merge_asof(right, left, on="start", by="doc")
    both = np.unique(np.concatenate([covers_a["a"].to_numpy() * len(start_b) + covers_a["b"].to_numpy(),
                                     covers_b["a"].to_numpy() * len(start_b) + covers_b["b"].to_numpy()]))
    return both // len(start_b), both % len(start_b)


def _runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. within each run of the given lengths."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _links(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, times), distinct, of the groups with ``n_a`` and ``n_b`` tokens and their documents; ids in group order."""
    at_a, at_b, links = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b, n_a * n_b
    large = links > BLOCK_PAIRS
    small = np.flatnonzero(~large)
    group = np.repeat(small, links[small])
    k = _runs(links[small])
    found = [(doc[group], (a[at_a[group] + k // n_b[group]] << B_BITS) + b[at_b[group] + k % n_b[group]], np.ones(len(group), np.int64))]
    for g in np.flatnonzero(large):  # its distinct ids with their numbers, instead of all its links
        ids_a, times_a = np.unique(a[at_a[g]:at_a[g] + n_a[g]], return_counts=True)
        ids_b, times_b = np.unique(b[at_b[g]:at_b[g] + n_b[g]], return_counts=True)
        pairs = ((ids_a << B_BITS)[:, None] + ids_b).reshape(-1)
        found.append((np.full(len(pairs), doc[g]), pairs, np.outer(times_a, times_b).reshape(-1)))
    of, pair, times = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((pair, of))
    of, pair, times = of[order], pair[order], times[order]
    new = np.ones(len(of), dtype=bool)
    new[1:] = (of[1:] != of[:-1]) | (pair[1:] != pair[:-1])
    first = np.flatnonzero(new)
    return of[first], pair[first], np.add.reduceat(times, first) if len(first) else times


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.pair = Pair(path_a, path_b)
        # a token in the groups' text, with what follows it inside its group and at the end of its side
        text = lambda n, end: np.array([f"{i}{end}" for i in range(n)], dtype=object)
        self.text_a, self.last_a = text(len(self.pair.bytes_a), ","), text(len(self.pair.bytes_a), "|")
        self.text_b, self.last_b = text(len(self.pair.bytes_b), ","), text(len(self.pair.bytes_b), ";")

    def together(self, texts: list[str]) -> list[Aligned | None]:
        """The alignment of some texts (with the space before them); None where the tokens don't give the text's bytes back."""
        ids = self.pair.ids(texts)
        out: list[Aligned | None] = [None] * len(texts)
        rows = [i for i, x in enumerate(ids) if x is not None]
        if not rows:
            return out
        per_a, per_b = ([ids[i][side] for i in rows] for side in (0, 1))
        a, b = np.concatenate(per_a), np.concatenate(per_b)
        doc_a, doc_b = (np.repeat(np.arange(len(rows)), [len(x) for x in per]) for per in (per_a, per_b))
        end_a, end_b = np.cumsum(self.pair.size_a[a]), np.cumsum(self.pair.size_b[b])
        over_a, over_b = overlaps(end_a - self.pair.size_a[a], end_b - self.pair.size_b[b], doc_a, doc_b)
        close = end_a[over_a] == end_b[over_b]
        last_a, last_b = over_a[close], over_b[close]
        n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        doc = doc_a[last_a]
        groups = np.bincount(doc, minlength=len(rows))
        links = np.bincount(doc, weights=(n_a * n_b).astype(float), minlength=len(rows)).astype(np.int64)
        of, pairs, times = _links(a, b, n_a, n_b, doc)
        cuts = np.searchsorted(of, np.arange(len(rows) + 1))
        # the groups' text: each group's A tokens, then its B tokens
        shown = np.empty(len(a) + len(b), dtype=object)
        group_a, group_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
        at_a = np.arange(len(a)) + (np.cumsum(n_b) - n_b)[group_a]
        at_b = np.arange(len(b)) + np.cumsum(n_a)[group_b]
        shown[at_a], shown[at_b] = self.text_a[a], self.text_b[b]
        shown[at_a[last_a]], shown[at_b[last_b]] = self.last_a[a[last_a]], self.last_b[b[last_b]]
        ends = np.cumsum([len(x) + len(y) for x, y in zip(per_a, per_b, strict=True)])
        for k, i in enumerate(rows):
            n_tokens = len(per_a[k]) + len(per_b[k])
            text = "".join(shown[ends[k] - n_tokens:ends[k]].tolist())
            out[i] = Aligned(len(per_a[k]), len(per_b[k]), int(groups[k]), int(links[k]), text.encode(),
                             pairs[cuts[k]:cuts[k + 1]], times[cuts[k]:cuts[k + 1]])
        return out

    def long(self, text: str) -> Aligned | None:
        """A long text, part by part: no group spans a part's end."""
        found = []
        for part in parts(text):
            found += self.together([part])
            if found[-1] is None:
                return None
        pairs, place = np.unique(np.concatenate([p.pairs for p in found]), return_inverse=True)
        times = np.bincount(place, weights=np.concatenate([p.times for p in found]).astype(float), minlength=len(pairs)).astype(np.int64)
        total = [sum(getattr(p, f) for p in found) for f in ("n_a", "n_b", "n_groups", "n_links")]
        return Aligned(*total, b"".join(p.groups for p in found), pairs, times)

    def __call__(self, texts: list[str | None]) -> Iterator[Aligned]:
        """The alignment of each text of a slice."""
        short = iter(self.together([f" {t}" for t in texts if t and len(t) <= SLICE_BYTES]))
        for t in texts:
            yield (NOTHING if not t else self.long(f" {t}") if len(t) > SLICE_BYTES else next(short)) or NOTHING


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """A worker process's aligner (reading the two tokenizers takes a second)."""
    return Aligner(path_a, path_b)


# ------------------------------------------------------------------ tasks

def _align_batches(path_a: str, path_b: str, id_type: pa.DataType):
    names = ["block", "is_doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    lists = lambda arrays: pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int64),
                                                         pa.array(np.concatenate([np.zeros(0, np.int64), *arrays]))).cast(pa.list_(pa.int64()))

    def of_docs(block: int, ids: pa.Array, docs: list[Aligned]) -> pa.RecordBatch:
        digests = [sha256(d.groups[:-1]).hexdigest() if d.groups else "" for d in docs]
        return pa.RecordBatch.from_arrays([
            pa.array([block] * len(docs), pa.int64()), pa.array([True] * len(docs)), ids, *[pa.array([getattr(d, c) for d in docs], pa.int64()) for c in names[3:7]],
            pa.array(digests, pa.string()), lists([d.pairs for d in docs]), lists([d.times for d in docs])], names=names)

    def of_block(block: int, pairs: np.ndarray, held: np.ndarray) -> pa.RecordBatch:
        cuts = np.arange(ROW_PAIRS, len(pairs), ROW_PAIRS)
        n = len(cuts) + 1
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([block] * n, pa.int64()), pa.array([False] * n), pa.nulls(n, id_type), none, none, none, none, pa.nulls(n, pa.string()),
                                           lists(np.split(pairs, cuts)), lists(np.split(held, cuts))], names=names)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = aligner(path_a, path_b)
        block, pairs, held = TaskContext.get().partitionId() << 32, NOTHING.pairs, NOTHING.times
        for batch in (part for whole in batches for part in byte_slices(whole, SLICE_BYTES)):
            docs = list(aligned(batch.column("text").to_pylist()))
            yield of_docs(block, batch.column("doc_id"), docs)
            own, n = np.unique(np.concatenate([d.pairs for d in docs]), return_counts=True)
            merged, place = np.unique(np.concatenate([pairs, own]), return_inverse=True)
            pairs, held = merged, np.bincount(place, weights=np.concatenate([held, n]).astype(float), minlength=len(merged)).astype(np.int64)
            if len(pairs) >= BLOCK_PAIRS:
                yield of_block(block, pairs, held)
                block, pairs, held = block + 1, NOTHING.pairs, NOTHING.times
        if len(pairs):
            yield of_block(block, pairs, held)

    return align


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (block, pair with the documents last): every document's n_best and count_sum."""
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    block, known = None, ([], [], [])
    for batch in batches:
        blocks, is_doc = batch.column("block").to_numpy(), batch.column("is_doc").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (is_doc[1:] != is_doc[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if blocks[a] != block:
                block, known = blocks[a], ([], [], [])
            if not is_doc[a]:
                for column, name in zip(known, ("pair", "count", "best"), strict=True):
                    column.append(part.column(name).to_numpy(zero_copy_only=False))
                continue
            if len(known[0]) > 1:
                known = tuple([np.concatenate(x)] for x in known)
            lists, times = part.column("pairs"), part.column("times").flatten().to_numpy()
            pairs, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            n_best = total = np.zeros(len(part), np.int64)
            if len(pairs):
                at = np.searchsorted(known[0][0], pairs)
                sums = np.concatenate([[0], np.cumsum(times * known[2][0][at])]), np.concatenate([[0], np.cumsum(times * known[1][0][at])])
                ends = np.cumsum(sizes)
                n_best, total = (s[ends] - s[ends - sizes] for s in sums)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(n_best), pa.array(total)], names=[*kept, "n_best", "count_sum"])


def align(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """(documents, counts).

    documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row of ``docs``;
    counts: a_id, b_id, count (documents that hold the pair linked), best (the A id's highest).
    """
    field_type = docs.select("doc_id").schema[0].dataType
    doc_id = f"doc_id {field_type.simpleString()}"
    made = stage(docs.select("doc_id", "text").mapInArrow(
        _align_batches(path_a, path_b, to_arrow_type(field_type)),
        f"block long, is_doc boolean, {doc_id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"), "aligned")
    asked = made.filter("not is_doc").select("block", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("block", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    totals = stage(asked.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    a_id = F.shiftright("pair", B_BITS)
    most = totals.groupBy(a_id.alias("a_id")).agg(F.max("count").alias("most"))
    counts = stage(totals.withColumn("a_id", a_id).join(most, "a_id").select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "pair-best")
    told = asked.select("block", "pair").join(counts, "pair").withColumn("is_doc", F.lit(False))
    rows = told.unionByName(made.filter("is_doc"), allowMissingColumns=True)
    found = (rows.repartition("block").sortWithinPartitions("block", F.col("pair").asc_nulls_last())
             .mapInArrow(_count_batches, f"{doc_id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"))
    return (found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"),
            counts.select(F.shiftright("pair", B_BITS).alias("a_id"), F.col("pair").bitwiseAND((1 << B_BITS) - 1).alias("b_id"), "count", "best"))
