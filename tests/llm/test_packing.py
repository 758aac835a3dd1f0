"""Packing against the contract, a sequential packer and the tokenizer itself."""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.llm import packing

from .helpers import awkward_docs, no_docs, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def _ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def _check(docs, tokenizer, window=2048):
    """Each id in exactly one piece, gapless sequences of at most a window, crc32 of the ids; returns sequence lengths."""
    texts = sorted(((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()), key=repr)
    pieces = packing.digest(packing.pack(docs, PATH)).collect()
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_seq[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"]].append(p)
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= window
    want, got = defaultdict(list), {k: sorted((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in v) for k, v in by_doc.items()}
    for doc_id, text in texts:
        want[doc_id].append(_ids(tokenizer, text))
    assert set(want) == set(got)
    for doc_id, lists in want.items():
        if len(lists) == 1:
            ids, at = lists[0], 0
            for start, length, crc, total in got[doc_id]:
                assert start == at and total == len(ids)
                assert crc == zlib.crc32(struct.pack(f"<{length}I", *ids[start:start + length]))
                at += length
            assert at == len(ids)
        else:
            assert sum(x[1] for x in got[doc_id]) == sum(map(len, lists))
    return [sum(n for _, n in spans) for spans in by_seq.values()]


def _padding(lengths, window=2048):
    return sum(0 if n & (n - 1) == 0 else window - n for n in lengths)


def test_awkward_rows(spark, tokenizer):
    lengths = _check(awkward_docs(spark).repartition(3), tokenizer)
    assert _padding(lengths) <= packing.MIN_PIECE * len(lengths)


def test_padding_over_many_partitions_and_merge_rounds(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "MERGED", 3)
    docs = spark.createDataFrame([(i, prose(i, 5 + i * 37 % 900)) for i in range(120)], "doc_id long, text string").repartition(11)
    lengths = _check(docs, tokenizer)
    assert _padding(lengths) <= packing.MIN_PIECE * len(lengths)
    assert sum(n < 2048 - packing.MIN_PIECE for n in lengths) <= 11


def test_empty_table_and_text_ids(spark, tokenizer):
    assert packing.pack(no_docs(spark), PATH).collect() == []
    _check(spark.createDataFrame([("a", "one Two"), ("b", None)], "doc_id string, text string"), tokenizer)


def test_sequences_hold_the_ids_and_the_padding(spark, tokenizer):
    docs = spark.createDataFrame([(i, prose(i, 700)) for i in range(5)], "doc_id long, text string").coalesce(1)
    pieces = packing.pack(docs, PATH).cache()
    rows = {r["sequence_id"]: r for r in packing.sequences(pieces).collect()}
    for r in rows.values():
        padded = len(r["ids"]) // 4
        assert padded == (r["n_tokens"] if r["n_tokens"] & (r["n_tokens"] - 1) == 0 else 2048)
    for p in pieces.collect():
        assert rows[p["sequence_id"]]["ids"][p["offset"] * 4:(p["offset"] + p["length"]) * 4] == p["ids"]
    pieces.unpersist()
    one = spark.createDataFrame([(7, struct.pack("<3I", 5, 6, 7), 0, 3)], "sequence_id long, ids binary, offset long, length long")
    got = packing.sequences(one).first()
    assert got["ids"] == struct.pack("<3I", 5, 6, 7) + bytes(4 * 2045)


def test_reruns_agree(spark):
    docs = awkward_docs(spark).repartition(4, F.xxhash64("text", "doc_id"))
    first, second = (sorted(map(tuple, packing.digest(packing.pack(docs, PATH)).collect()), key=repr) for _ in range(2))
    assert first == second


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_words_give_the_ids_of_whole_texts(texts):
    _encoder = _ENCODERS.setdefault("e", packing.Encoder(PATH))
    assert list(_encoder(texts)) == [struct.pack(f"<{len(i)}I", *i) for i in (_encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts)]


_ENCODERS: dict = {}


def test_words_of_awkward_scripts(tokenizer, monkeypatch):
    texts = ["áb é ́x", "İ ΟΔΟΣ Σ ΣΣ ß", "x\x1cy\x85z q r", "<|endoftext|>a <|startoftext|> <|endoftext|>", "don't 've 12345 3.14", " \t\n", "",
             "日本語テキスト " * 50, "w" * 5000, "🙂🙃 a🙂b"]
    monkeypatch.setattr(packing, "PART_CHARS", 40)
    monkeypatch.setattr(packing, "MEMO_WORDS", 3)
    encoder = packing.Encoder(PATH)
    for _ in range(2):
        assert list(encoder(texts)) == [struct.pack(f"<{len(i)}I", *i) for i in (tokenizer.encode(t, add_special_tokens=False).ids for t in texts)]
    assert all(len(w) <= packing.MEMO_CHARS for w in encoder.memo)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abZÀéÉßÞþÿ×÷µ019.,!~-'<|>_\x7f\x85\x1c\u0301İΣ \t\n", max_size=40), max_size=5))
def test_pieces_give_the_ids_of_whole_texts(texts):
    if "e" not in _ENCODERS:
        _ENCODERS["e"] = packing.Encoder(PATH)
    encoder = _ENCODERS["e"]
    assert encoder.bare is not None
    assert list(encoder(texts)) == [struct.pack(f"<{len(i)}I", *i) for i in (encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts)]


def test_a_piece_is_encoded_once_whatever_stands_beside_it(tokenizer):
    ends = ["", ".", ",", "!", "...", "?!", "7", "%%%"]
    stems = ["zauber", "Zauber", "ZAUBER", "été", "Été"]
    texts = [" ".join(s + e for s in stems for e in ends), " ".join(e + s for s in stems for e in ends), "don't <|endoftext|> 日本"]
    encoder = packing.Encoder(PATH)
    assert list(encoder(texts)) == [struct.pack(f"<{len(i)}I", *i) for i in (tokenizer.encode(t, add_special_tokens=False).ids for t in texts)]
    assert set(encoder.memo) == {"zauber", "été", *ends[1:], "don't", "<|endoftext|>", "日本"}
    encoder.bare = None  # a tokenizer of another make: every word goes through it whole
    encoder.memo.clear()
    assert list(encoder(texts)) == [struct.pack(f"<{len(i)}I", *i) for i in (tokenizer.encode(t, add_special_tokens=False).ids for t in texts)]
    assert "Zauber?!" in encoder.memo


def _plain(sizes, window, limit, least):
    """The same rules over a plain list of windows: the emitted fills, before merging, and the open ones."""
    open_, done, made = [], [], 0
    for size in sizes:
        while size >= window:
            done.append(window)
            size -= window
        while size:
            fits = [w for w in open_ if w[0] >= size]
            if fits or len(open_) < limit:
                w = min(fits) if fits else (window, made)
                made += not fits
                if fits:
                    open_.remove(w)
                if w[0] == size:
                    done.append(window)
                else:
                    open_.append((w[0] - size, w[1]))
                break
            w = min(open_)
            open_.remove(w)
            if w[0] >= least and size - w[0] >= least:
                done.append(window)
                size -= w[0]
            else:
                done.append(window - w[0])
    return done, open_


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 150), max_size=150), st.integers(1, 6), st.integers(1, 9))
def test_best_fit_against_a_plain_list(sizes, limit, least):
    done: list = []
    packer = packing.Packer(done.append, window=64, limit=limit, least=least)
    most = 0
    for i, n in enumerate(sizes):
        packer.add(packing.Piece(i, 0, bytes(4 * n), n))
        most = max(most, len(packer.open))
    want, open_ = _plain(sizes, 64, limit, least)
    assert [sum(map(len, w)) for w in done] == want
    assert [(w.room, w.number) for w in packer.open] == sorted(open_) and most <= limit
    total = sum(w.window - w.room if hasattr(w, "window") else 64 - w.room for w in packer.open)
    before = len(done)
    left = packer.merge()
    assert sum(map(len, left)) < 64 and not packer.open
    assert sum(len(p) for w in done[before:] for p in w) + sum(map(len, left)) == total
    assert all(sum(map(len, w)) == 64 for w in done[before:])
    tails = packing.powers(left)
    assert sum(len(p) for t in tails for p in t) == sum(map(len, left))
    assert all((n := sum(map(len, t))) & (n - 1) == 0 for t in tails)
