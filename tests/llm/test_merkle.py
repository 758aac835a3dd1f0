"""The Merkle manifest against a sequential tree."""

from __future__ import annotations

import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import merkle

from .helpers import awkward_docs, no_docs


def _h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _code(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and per leaf its (left, right) sibling texts from the bottom up."""
    steps: list[list] = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, held = [], []
        for a in range(0, len(nodes), 8):
            run = nodes[a:a + 8]
            for k in range(len(run)):
                for leaf in under[a + k]:
                    steps[leaf].append(("".join(run[:k]), "".join(run[k + 1:])))
            above.append(_h(*run))
            held.append([x for u in under[a:a + 8] for x in u])
        nodes, under = above, held
    return nodes[0], steps


def _plain(rows: list[dict]) -> list[tuple]:
    def leaf(r, text):
        return _h(*[_code(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])

    trees: dict = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append((r["doc_id"], leaf(r, r["text"]), r["text"], r))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for n in names:
        trees[n].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    subs = {n: _tree([x[1] for x in trees[n]]) for n in names}
    root, above = _tree([subs[n][0] for n in names])
    out = []
    for k, n in enumerate(names):
        for i, (doc, digest, text, r) in enumerate(trees[n]):
            steps = subs[n][1][i] + above[k]
            shown = digest
            if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0 and text is not None:
                shown = leaf(r, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
            folded = shown
            for left, right in steps:
                folded = _h(left, folded, right)
            out.append((doc, digest, subs[n][0], root, _h(*[a + b for a, b in steps]), folded, folded == root))
    return out


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def _equal(docs):
    want = _plain([r.asDict() for r in docs.select(*merkle.COLUMNS).collect()])
    got = merkle.manifest(docs, *merkle.tampered())
    assert _sorted(got.collect()) == _sorted(want)


def test_awkward_rows(spark, monkeypatch):
    """Nulls, empty texts, ties of doc_id, repeated rows, clashing extra columns; several leaf partitions."""
    monkeypatch.setattr(merkle, "PART_LEAVES", 4)
    extra = [(20 + i, f"Text {i} É", lang, "s") for i in range(90) for lang in (["en", None, "de"] if i < 20 else ["en"])]
    _equal(awkward_docs(spark, extra))


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65])
def test_sizes_of_one_language(spark, n):
    rows = [(i, f"Doc {i}", "en", "s") for i in range(n)]
    _equal(spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, lang string, source string, n_chars long"))


def test_text_ids_and_many_languages(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PART_LEAVES", 8)
    docs = spark.createDataFrame([(f"id{i:03}", f"T{i}", f"l{i % 13}", None, None) for i in range(60)],
                                 "doc_id string, text string, lang string, source string, n_chars long")
    rows = merkle.manifest(docs, with_siblings=True).collect()
    assert len(rows) == 60 and all(r["verified"] and r["folded_root"] == r["root"] for r in rows)
    assert all(_h(*r["siblings"]) == r["proof_sha256"] for r in rows)


def test_empty_table(spark):
    assert merkle.manifest(no_docs(spark), *merkle.tampered()).collect() == []


def test_hot_doc_id(spark, monkeypatch):
    """Half of the rows share an id (and their text): they spread over the leaf partitions."""
    monkeypatch.setattr(merkle, "PART_LEAVES", 16)
    docs = spark.createDataFrame([(7 if i % 2 else i, "Same" if i % 2 else f"T{i}", "en", "s", 4) for i in range(200)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    _equal(docs)
    placed = merkle.positions(merkle.leaves(docs, merkle.F.lit(False), merkle.F.col("text")).withColumnRenamed("lang", "tree"), ["tree"], ["doc_id", "leaf", "rid"])
    assert max(r["count"] for r in placed.groupBy("part").count().collect()) <= 64


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700), st.data())
def test_multiproof_is_minimal_and_enough(n, data):
    """From the leaves held and the missing nodes alone every proof folds to the root; no missing node can be derived."""
    held = sorted(data.draw(st.sets(st.integers(0, n - 1), min_size=1, max_size=40)))
    leaf = [_h(str(i)) for i in range(n)]
    root, steps = _tree(leaf)
    by_level, level = {}, list(leaf)
    for k in range(10):
        by_level.update({(k, i): h for i, h in enumerate(level)})
        if len(level) == 1:
            break
        level = [_h(*level[a:a + 8]) for a in range(0, len(level), 8)]
    lacking = {(k, int(i)) for k, places in merkle.missing(np.array(held), n) for i in places}
    derived = {(k, i // 8**k) for i in held for k in range(10)}
    assert not lacking & derived
    levels = merkle.interiors({i: leaf[i] for i in held}, {c: by_level[c] for c in lacking}, n)
    assert next(iter(levels[-1].values()))[0] == root
    found = merkle.paths(levels, ("", ()))
    for i in held:
        assert merkle.fold(leaf[i], found[i][1]) == root
        assert found[i][0] == "".join(a + b for a, b in steps[i])
