"""Alignment against whole-text encodes, plain group cutting and dictionary counts."""

from __future__ import annotations

from collections import Counter
from functools import lru_cache
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfcast.llm import alignment

from .helpers import awkward_docs, no_docs, prose

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TRICKY = ["x  y   z", "trailing  ", " lead", "a \n b\n\n  c", "tab\t x", "a\x1c b\x85 c  d　 e", "mark ▁ here", "x▁ y", "don't it's", "<|endoftext|> <s> </s> <0x0A> <unk>",
          "日本語 テキスト", "\U0001f642\U0001f643 a\U0001f642", "é ́x", "0 12 345 3.14", " ", "   ", "\n", "ﬁ ½", "\x00 \x01", "a" * 3000, "!!  !! ??"]


@pytest.fixture(scope="module")
def aligner():
    return alignment.aligner(*PATHS)


@lru_cache
def _tokenizer():
    t = Tokenizer.from_file(PATHS[0])
    t.encode_special_tokens = True
    return t


def _whole(aligner, text):
    """Groups [(A ids, B ids)] of a text encoded in one piece."""
    if not text:
        return []
    p = aligner.pair
    a, b, raw = _tokenizer().encode(" " + text, add_special_tokens=False).ids, p.b.encode(text), (" " + text).encode()
    if b"".join(p.bytes_a[i] for i in a) != raw or b"".join(p.bytes_b[i] for i in b) != raw:
        return []
    end_a, end_b = (np.cumsum([len(table[i]) for i in ids]).tolist() for table, ids in ((p.bytes_a, a), (p.bytes_b, b)))
    groups, i, j = [], 0, 0
    at_a, at_b = ({end: k for k, end in enumerate(ends)} for ends in (end_a, end_b))
    for end in sorted(at_a.keys() & at_b.keys()):
        i2, j2 = at_a[end] + 1, at_b[end] + 1
        groups.append((a[i:i2], b[j:j2]))
        i, j = i2, j2
    return groups


def _links(groups):
    return Counter((x, y) for a, b in groups for x in a for y in b)


def _digest(groups):
    return sha256(";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups).encode()).hexdigest() if groups else ""


def _plain(aligner, rows):
    whole = [(i, _whole(aligner, t)) for i, t in rows]
    counts = Counter(pair for _, g in whole for pair in _links(g))
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for doc_id, g in whole:
        links = _links(g)
        out.append((doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(links.values()),
                    sum(n for p, n in links.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in links.items()), _digest(g)))
    return sorted(out, key=repr), counts, most


def _equal(docs, aligner):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want, counts, most = _plain(aligner, rows)
    found, table = alignment.align(docs, *PATHS)
    assert sorted(map(tuple, found.collect()), key=repr) == want
    assert {(r["a_id"], r["b_id"]): (r["count"], r["best"]) for r in table.collect()} == {p: (n, n == most[p[0]]) for p, n in counts.items()}


def test_awkward_rows_and_blocks(spark, aligner, monkeypatch):
    """Nulls, empty and long texts, repeated rows, clashing columns, unusual scripts and spaces; many blocks."""
    extra = [(30 + i, t, "en", "s") for i, t in enumerate(TRICKY)]
    _equal(awkward_docs(spark, extra).repartition(3), aligner)


def test_text_ids_and_empty_table(spark, aligner):
    _equal(spark.createDataFrame([("a", "one Two one"), (None, "one"), ("c", None)], "doc_id string, text string"), aligner)
    found, counts = alignment.align(no_docs(spark), *PATHS)
    assert found.collect() == [] and counts.collect() == []


def test_parts_of_long_texts(aligner, monkeypatch):
    text = "\n".join([prose(3, 900), " ".join(TRICKY[:5]), prose(4, 300)])
    (want,) = aligner.together([" " + text])
    monkeypatch.setattr(alignment, "SLICE_BYTES", 500)
    assert "".join(alignment.parts(" " + text)) == " " + text
    (got,) = aligner([text])
    assert (got.n_a, got.n_b, got.n_groups, got.n_links, got.groups) == (want.n_a, want.n_b, want.n_groups, want.n_links, want.groups)
    assert got.pairs.tolist() == want.pairs.tolist() and got.times.tolist() == want.times.tolist()
    assert list(aligner([text + " ▁"])) == [alignment.NOTHING]


def test_large_groups_by_distinct_ids(aligner, monkeypatch):
    texts = [prose(5, 60), *TRICKY]
    want = [x for x in aligner(texts)]
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 1)  # every group of more than one link is large
    for x, y in zip(want, aligner(texts), strict=True):
        assert x.pairs.tolist() == y.pairs.tolist() and x.times.tolist() == y.times.tolist()


@pytest.mark.parametrize("slice_bytes", [alignment.SLICE_BYTES, 1])
@settings(max_examples=50, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t ▁ab'.1́"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=5))
def test_parts_give_the_groups_of_whole_texts(slice_bytes, texts):
    """With a slice of one character every text is cut wherever it may be."""
    for text in texts:
        with pytest.MonkeyPatch.context() as m:
            m.setattr(alignment, "SLICE_BYTES", slice_bytes)
            (got,) = alignment.aligner(*PATHS)([text])
        aligner = alignment.aligner(*PATHS)
        want = _whole(aligner, text)
        assert (got.n_groups, got.n_links) == (len(want), sum(_links(want).values()))
        assert _digest(want) == (sha256(got.groups[:-1]).hexdigest() if got.groups else "")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 5), min_size=1, max_size=12), st.data()), min_size=1, max_size=4))
def test_overlaps_against_all_pairs(parts):
    size_a, size_b, doc_a, doc_b = [], [], [], []
    for d, (sizes, data) in enumerate(parts):
        left, total = [], sum(sizes)
        while sum(left) < total:
            left.append(data.draw(st.integers(1, min(6, total - sum(left)))))
        size_a += sizes
        size_b += left
        doc_a += [d] * len(sizes)
        doc_b += [d] * len(left)
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    got = alignment.overlaps(end_a - size_a, end_b - size_b, np.array(doc_a), np.array(doc_b))
    want = [(i, j) for i in range(len(end_a)) for j in range(len(end_b)) if max(end_a[i] - size_a[i], end_b[j] - size_b[j]) < min(end_a[i], end_b[j])]
    assert list(zip(*(x.tolist() for x in got), strict=True)) == want
