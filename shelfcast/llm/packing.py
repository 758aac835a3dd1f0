"""Packing documents into training sequences: bounded-space online best fit.

1. A task streams its partition's documents.  A document is its token ids and one end id.  Whole
   windows of ``WINDOW`` ids are cut off its front; the rest is a piece.
2. The task keeps at most ``OPEN`` windows open.  A piece goes where the least room is left
   over (best fit), else into a new window.  When none fits and none may be opened, the fullest
   is emitted; if its room is ``MIN_PIECE`` ids or more, the piece's front fills it first.
3. At its end a task merges its open windows until one is left that is not full.  These are
   merged in rounds of ``MERGED`` tasks' leftovers per task, by the same rules, down to one
   window.  That one is cut into sequences of powers of two, which take no padding.

So each emitted sequence lacks fewer than ``MIN_PIECE`` ids of ``WINDOW``.

Token ids: the tokenizer's words never span ASCII white space, so texts are encoded word by word.
Plain words (``PLAIN``) are cut into runs of letters, single digits and runs of other signs, as the
tokenizer cuts them, and each distinct lower-case piece of a slice is encoded once by its model; other
words go whole through the whole tokenizer, once each (a memo of about ``MEMO_WORDS`` entries per task).

Defined results: a null or empty text is its end id alone; repeated rows are packed each; a null
doc_id is kept; an empty table gives an empty result; any id type; extra columns are ignored.
Placement follows the order of the input's partitions and rows, and is equal in a retried task.

Scale: no document is shuffled; a task holds its open windows (8 KB each), one slice of texts and the
memo.  The leftovers are one window per task.
"""

from __future__ import annotations

import itertools
import json
import re
import struct
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import one_thread, stage
from .wordhash import byte_slices, text_bytes, word_spans

WINDOW = 2048
OPEN = 64               # windows that a task keeps open
MIN_PIECE = 16          # a window is not filled up by a cut that leaves a piece under this
MERGED = 1000           # leftover windows merged by one task
END_ID = 1              # fixed value: the id after each document
ID_BYTES = 4            # ids are little-endian unsigned 32-bit
MEMO_WORDS, MEMO_CHARS = 300_000, 64  # bounds of the memo: pieces and words, and characters of one
SLICE_BYTES = 4 << 20   # text handled at once
PART_CHARS, ENCODED = 1 << 20, 20_000  # characters of a long text, and words, encoded at once
ROWS_OUT, BYTES_OUT = 4096, 8 << 20   # bounds of an emitted batch
PAD_ID = 0
# fixed value: ASCII white space, which this tokenizer drops
WORD = re.compile(r"[^ \t\n\x0b\x0c\r]+")
# fixed value: how this tokenizer splits lower-cased words into pieces
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# plain words: printable ASCII and Latin-1 letters, without "<" (no added token) and "'" (no contraction)
PLAIN = re.compile(r"[!-&(-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


# ------------------------------------------------------------------ token ids

def _bare(tokenizer):
    """The tokenizer's model and byte alphabet alone, for pieces of plain words; None if it does not cut and fold as `_pieces` does."""
    from tokenizers import Tokenizer, pre_tokenizers

    state = json.loads(tokenizer.to_str())
    steps = (state["normalizer"] or {}).get("normalizers", []), (state["pre_tokenizer"] or {}).get("pretokenizers", [])
    same = (tuple(x["type"] for x in steps[0]) == ("NFC", "Replace", "Lowercase") and tuple(x["type"] for x in steps[1]) == ("Split", "ByteLevel")
            and steps[0][1]["pattern"] == {"Regex": r"\s+"} and steps[1][0]["pattern"] == {"Regex": SPLIT} and state["post_processor"] is None
            and all("<" in x["content"] for x in state["added_tokens"]))
    if not same:
        return None
    bare = Tokenizer(tokenizer.model)
    bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return bare


def _ids(tokenizer, items: list[str]) -> Iterator[bytes]:
    for a in range(0, len(items), ENCODED):
        for e in tokenizer.encode_batch_fast(items[a:a + ENCODED], add_special_tokens=False):
            own = e.ids
            yield struct.pack(f"<{len(own)}I", *own)


def _pieces(data: np.ndarray, rows: np.ndarray, plain: bool) -> tuple[pa.LargeStringArray, np.ndarray]:
    """What is encoded on its own, in order, and each row's bounds: pieces of plain words (lower-cased), other words whole."""
    starts, ends, _ = word_spans(data, rows)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.zeros(len(data), dtype=bool)
    if plain and len(starts):
        after = np.zeros(len(data), dtype=bool)  # second byte of a Latin-1 letter
        after[1:] = data[:-1] == 0xC3
        cross = after & ((data == 0x97) | (data == 0xB7))
        wide = (after & ~cross) | (data == 0xC3)
        bad = np.flatnonzero(~white & ~wide & ((data <= 32) | (data >= 127) | (data == 0x27) | (data == 0x3C)))
        odd = np.zeros(len(starts), dtype=bool)
        odd[np.searchsorted(starts, bad, side="right") - 1] = True
        step = np.zeros(len(data) + 1, dtype=np.int8)
        step[starts[odd]] = 1
        step[ends[odd]] -= 1
        kept = np.cumsum(step[:-1], dtype=np.int8).view(bool)
        upper = ~kept & (((data >= 65) & (data <= 90)) | (after & (data <= 0x9E)))
        data = data + (upper.view(np.uint8) << 5)
        digit = (data >= 48) & (data <= 57)
        letter = ((data >= 97) & (data <= 122)) | (data >= 128)
        first[1:] = digit[1:] | digit[:-1] | (letter[1:] != letter[:-1])
        first &= ~(white | kept)
    first[starts] = True
    begins = np.flatnonzero(first)
    inside = ~white
    offsets = np.append(np.cumsum(inside)[begins] - 1, inside.sum()).astype(np.int64)
    spelled = pa.py_buffer(data[inside].tobytes())
    return pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(offsets), spelled), np.searchsorted(begins, rows)


class Encoder:
    """Token ids (packed bytes) of texts by a tokenizer whose tokens never span ASCII white space."""

    def __init__(self, path: str):
        one_thread()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bare = _bare(self.tokenizer)
        self.memo: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        """Puts the pieces into the memo; past its bound only these stay."""
        if len(self.memo) > MEMO_WORDS:
            self.memo = {x: self.memo[x] for x in pieces if x in self.memo}
        fresh = [x for x in pieces if x not in self.memo]
        plain = [x for x in fresh if PLAIN.fullmatch(x)] if self.bare else []
        self.memo.update(zip(plain, _ids(self.bare, plain), strict=True))
        odd = [x for x in fresh if x not in self.memo]
        self.memo.update(zip(odd, _ids(self.tokenizer, odd), strict=True))

    def together(self, texts: list[str]) -> list[bytes]:
        """Ids of some short texts, whose pieces are learned at once."""
        every, bounds = _pieces(*text_bytes(pa.array(texts, pa.large_string()), lower=False), self.bare is not None)
        every = every.dictionary_encode()
        pieces, code = every.dictionary.to_numpy(zero_copy_only=False).tolist(), every.indices.to_numpy()
        self._learn(pieces)
        ids = [self.memo[x] for x in pieces]
        for x in [x for x in pieces if len(x) > MEMO_CHARS]:
            del self.memo[x]
        sizes, known = np.array([len(x) // ID_BYTES for x in ids], dtype=np.int64), np.frombuffer(b"".join(ids), dtype="<u4")
        lengths = sizes[code]
        at = np.concatenate([[0], np.cumsum(lengths)])
        begin = np.concatenate([[0], np.cumsum(sizes)])[code]
        out = known[np.repeat(begin - at[:-1], lengths) + np.arange(at[-1])]
        return [out[a:b].tobytes() for a, b in itertools.pairwise(at[bounds].tolist())]

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of texts of about a slice; a text over PART_CHARS goes alone, in parts that end where a word does."""
        short = [t or "" for t in texts]
        long = {i for i, t in enumerate(short) if len(t) > PART_CHARS}
        got = iter(self.together([t for i, t in enumerate(short) if i not in long]))
        for i, text in enumerate(short):
            yield b"".join(self.together([part])[0] for part in parts(text)) if i in long else next(got)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """A worker process's encoder: its memo serves the tasks that follow."""
    return Encoder(path)


def parts(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        rest = WORD.match(text, at + PART_CHARS)
        end = rest.end() if rest else at + PART_CHARS
        yield text[at:end]
        at = end


# ------------------------------------------------------------------ windows

@dataclass
class Piece:
    doc_id: object
    start: int
    ids: bytes
    doc_tokens: int

    def __len__(self) -> int:
        return len(self.ids) // ID_BYTES

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc_id, self.start, self.ids[:n * ID_BYTES], self.doc_tokens),
                Piece(self.doc_id, self.start + n, self.ids[n * ID_BYTES:], self.doc_tokens))


@dataclass(order=True)
class Window:
    room: int
    number: int
    pieces: list[Piece] = field(compare=False)


class Packer:
    """Open windows, by room; ``emit`` takes the pieces of each window that is done."""

    def __init__(self, emit: Callable[[list[Piece]], None], window: int = WINDOW, limit: int = OPEN, least: int = MIN_PIECE):
        self.emit, self.window, self.limit, self.least = emit, window, limit, least
        self.open: list[Window] = []
        self.made = 0

    def _put(self, at: int | None, pieces: list[Piece]) -> None:
        if at is None:
            w, self.made = Window(self.window, self.made, []), self.made + 1
        else:
            w = self.open.pop(at)
        w.pieces += pieces
        w.room -= sum(map(len, pieces))
        if w.room == 0:
            self.emit(w.pieces)
        else:
            insort(self.open, w)

    def fitting(self, size: int) -> int | None:
        at = bisect_left(self.open, size, key=lambda w: w.room)
        return at if at < len(self.open) else None

    def add(self, piece: Piece) -> None:
        while len(piece) >= self.window:
            head, piece = piece.cut(self.window)
            self.emit([head])
        while len(piece):
            at = self.fitting(len(piece))
            if at is not None or len(self.open) < self.limit:
                self._put(at, [piece])
                return
            fullest = self.open.pop(0)
            if fullest.room >= self.least and len(piece) - fullest.room >= self.least:
                head, piece = piece.cut(fullest.room)
                fullest.pieces.append(head)
            self.emit(fullest.pieces)

    def merge(self) -> list[Piece]:
        """Empties the open windows into each other; the pieces of the one that stays unfilled."""
        left, self.open = sorted(self.open), []
        for w in left:  # fullest first, each whole where it fits best
            at = self.fitting(self.window - w.room)
            if at is None:
                insort(self.open, w)
            else:
                self._put(at, w.pieces)
        while len(self.open) > 1:  # the emptiest one's pieces fill up the others
            rest = self.open.pop()
            for piece in rest.pieces:
                while len(piece) and self.open:
                    head, piece = piece.cut(min(len(piece), self.open[0].room))
                    self._put(0, [head])
                if len(piece):
                    self._put(None if not self.open else 0, [piece])
        last = self.open.pop().pieces if self.open else []
        return last


def powers(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces in sequences of powers of two (the binary digits of their ids' number), the longest first."""
    total, out = sum(map(len, pieces)), []
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        room, taken = 1 << bit, []
        while room:
            head, rest = pieces[0].cut(min(room, len(pieces[0])))
            taken.append(head)
            pieces = [rest, *pieces[1:]] if len(rest) else pieces[1:]
            room -= len(head)
        out.append(taken)
    return out


# ------------------------------------------------------------------ tasks

NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "stream", "open"]


class _Out:
    """Rows of emitted windows; sequence ids are the task's number and a counter."""

    def __init__(self, stream: int, id_type: pa.DataType):
        self.stream, self.id_type, self.rows, self.bytes, self.made = stream, id_type, [], 0, 0

    def window(self, pieces: list[Piece], is_open: bool = False) -> None:
        at = 0
        for p in pieces:
            self.rows.append((p.doc_id, p.start, len(p), p.ids, p.doc_tokens, (self.stream << 32) + self.made, at, self.stream, is_open))
            at += len(p)
            self.bytes += len(p.ids)
        self.made += 1

    def full(self) -> bool:
        return len(self.rows) >= ROWS_OUT or self.bytes >= BYTES_OUT

    def take(self) -> pa.RecordBatch:
        types = [self.id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(types)
        batch = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=NAMES)
        self.rows, self.bytes = [], 0
        return batch


def _pack_batches(tokenizer: str, id_type: pa.DataType):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = encoder(tokenizer), struct.pack("<I", END_ID)
        out = _Out(TaskContext.get().partitionId(), id_type)
        packer = Packer(out.window)
        for batch in (part for whole in batches for part in byte_slices(whole, SLICE_BYTES)):
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), ids_of(batch.column("text").to_pylist()), strict=True):
                ids = own + end
                packer.add(Piece(doc_id, 0, ids, len(ids) // ID_BYTES))
                if out.full():
                    yield out.take()
        out.window(packer.merge(), is_open=True)
        yield out.take()

    return pack


def _merge_batches(first: int, last_round: bool, id_type: pa.DataType):
    """Rows of leftover windows, sorted by (stream, offset): packed again; stream ids from ``first`` on."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(first + TaskContext.get().partitionId(), id_type)
        packer = Packer(out.window)
        for batch in batches:
            for row in batch.to_pylist():
                packer.add(Piece(row["doc_id"], row["start"], row["ids"], row["doc_tokens"]))
                if out.full():
                    yield out.take()
        left = packer.merge()
        if last_round:
            for pieces in powers(left):
                out.window(pieces)
        else:
            out.window(left, is_open=True)
        yield out.take()

    return merge


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (packed), doc_tokens, sequence_id, offset."""
    field_type = docs.select("doc_id").schema[0].dataType
    id_type = to_arrow_type(field_type)
    schema = (f"doc_id {field_type.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, "
              "offset long, stream long, open boolean")
    made = stage(docs.select("doc_id", "text").mapInArrow(_pack_batches(tokenizer, id_type), schema), "packed")
    done, number = made.filter("not open"), 0
    while True:
        left = made.filter("open")
        streams = left.select("stream").distinct().count()
        groups = -(-streams // MERGED)
        if not groups:
            break
        number += 1
        ranked = left.repartitionByRange(groups, "stream").sortWithinPartitions("stream", "offset")
        made = stage(ranked.mapInArrow(_merge_batches(number << 24, groups == 1, id_type), schema), "merged")
        done = done.unionByName(made.filter("not open"))
    return done.drop("stream", "open")


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids (packed): the padded sequences (to WINDOW, but for lengths that are powers of two)."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(own, F.lit("").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    pad = F.lit(struct.pack("<I", PAD_ID))
    size = F.col("n_tokens")
    room = F.when(size.bitwiseAND(size - 1) == 0, F.lit(0)).otherwise(F.lit(WINDOW) - size)
    return (pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
            .select("sequence_id", "n_tokens", F.concat("ids", F.unhex(F.repeat(F.hex(pad), room.cast("int")))).alias("ids")))


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids in the place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
