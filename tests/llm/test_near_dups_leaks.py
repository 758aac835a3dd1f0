import random
import re

import numpy as np

from shelfcast.llm import decontaminate, near_dups
from shelfcast.llm.wordhash import U, word_hashes

from .helpers import awkward_docs, changed, no_docs, prose, tokens, words


def _distance(a, b):
    """Edit distance of word lists, row by row."""
    codes = {w: i for i, w in enumerate({*a, *b})}
    x, y = (np.array([codes[w] for w in t], dtype=np.int64) for t in (a, b))
    row, places = np.arange(len(y) + 1), np.arange(len(y) + 1)
    for i, c in enumerate(x):
        step = np.minimum(row[1:] + 1, row[:-1] + (y != c))
        row = np.minimum.accumulate(np.concatenate([[i + 1], step]) - places) + places  # insertions
    return int(row[-1])


def _similar(a, b):
    """Word edit similarity of 0.8 or more."""
    longest = max(len(a), len(b))
    return longest > 0 and min(len(a), len(b)) >= 0.8 * longest - 1e-9 and _distance(a, b) <= 0.2 * longest + 1e-9


def _classes(rows):
    """Connected components over equal texts and pairs with a word edit similarity of 0.8 or more."""
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = [tokens(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or (root(i) != root(j) and _similar(lists[i], lists[j])):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [least[root(i)] for i in range(len(rows))]


def _family(seed):
    """A base text and copies with one to many words changed (up to 15 % at random places), longer and shorter ones."""
    base, out = prose(seed, 250), []
    for n, every in enumerate((250, 120, 60, 40, 25, 15)):
        out.append((1000 * seed + n, changed(base, every), "en", "f"))
    r = random.Random(seed)
    for n, share in enumerate((0.05, 0.08, 0.1, 0.12, 0.15)):
        out.append((1000 * seed + 10 + n, " ".join(f"y{n}x{i}" if r.random() < share else w for i, w in enumerate(base.split())), "en", "f"))
    out.append((1000 * seed + 50, base + " " + " ".join(words(seed + 1, 12)), "en", "f"))
    out.append((1000 * seed + 51, " ".join(base.split()[9:]), "en", "f"))
    return out


def test_classes_equal_brute_force(spark):
    docs = awkward_docs(spark, [r for s in (21, 22, 23) for r in _family(s)])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted(map(str, zip((d for d, _ in rows), _classes(rows), strict=True)))
    got = near_dups.classes(docs).collect()
    assert sorted(str((r["doc_id"], r["class_id"])) for r in got) == want


def test_links_are_decided_by_the_alignment(spark):
    """Spread edits leave few shingles but a high edit similarity; moved passages the other way round."""
    w = prose(77, 1000).split()
    spread = [f"x{i}" if i % 12 == 5 else x for i, x in enumerate(w)]
    moved = w[400:] + w[:400]
    half = w[:500] + prose(78, 500).split()
    rows = [(1, " ".join(w)), (2, " ".join(spread)), (3, " ".join(moved)), (4, " ".join(half))]
    got = {r["doc_id"]: r["class_id"] for r in near_dups.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_blocks_find_what_the_hubs_miss():
    """Members of one bucket in two families and alone: the pairs that join them, by shared shingles and alignment, none twice."""
    texts = [prose(s, 300).split() for s in (1, 2, 3)]
    lists = [texts[0], [*texts[0][:290], "end"], texts[1], ["start", *texts[1][5:]], texts[2], texts[2][150:] + texts[2][:150]]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([bytes([i]) for i in range(6)]), pa.array([" ".join(x) for x in lists])], names=["key", "text"])
    (sampled,) = near_dups._sample_batches([batch])
    rows = [{**r, "sample": np.array(r["sample"], np.int32), "comp": r["key"], "asks": None, "rest": True, "refused": None} for r in sampled.to_pylist()]
    pairs = near_dups._joining_pairs(rows)
    assert sorted(tuple(sorted(p)) for p in pairs) == [(b"\x00", b"\x01"), (b"\x02", b"\x03")]


def test_blocks_find_links_that_share_few_shingles():
    """Every pair of a bucket with an edit similarity of 0.8 or more is joined, short and long texts, however the changes are spread."""
    import pyarrow as pa

    lists = []
    for seed, n in ((41, 300), (42, 12), (43, near_dups.SAMPLE + 500)):
        w = prose(seed, n).split()
        lists += [w, [f"x{i}" if i % 7 == 3 else x for i, x in enumerate(w)], [f"y{i}" if i % 4 == 3 else x for i, x in enumerate(w)], [f"z{i}" if i < 0.3 * n else x for i, x in enumerate(w)]]
    batch = pa.RecordBatch.from_arrays([pa.array([bytes([i]) for i in range(len(lists))]), pa.array([" ".join(x) for x in lists])], names=["key", "text"])
    (sampled,) = near_dups._sample_batches([batch])
    rows = [{**r, "sample": np.array(r["sample"], np.int32), "comp": r["key"], "asks": None, "rest": True, "refused": None} for r in sampled.to_pylist()]
    pairs = {tuple(sorted((a[0], b[0]))) for a, b in near_dups._joining_pairs(rows)}
    links = {(i, j) for j in range(len(lists)) for i in range(j) if _similar(lists[i], lists[j])}
    assert links == {(0, 1), (4, 5), (8, 9)}
    assert links <= pairs and not any(j < 8 for _, j in pairs - links)  # long ones are aligned later


def test_links_beside_the_hub_are_found(spark):
    """Two texts of 86 % edit similarity share buckets with a text that is like neither: it is the hub, their link stays."""
    w = prose(51, 200).split()
    spread = [f"x{i}" if i % 7 == 3 else x for i, x in enumerate(w)]
    hub = w + prose(52, 70).split()
    rows = [(1, " ".join(w)), (2, " ".join(spread)), *((3 + k, " ".join(hub + [f"h{k}"] * 20)) for k in range(6))]
    got = {r["doc_id"]: r["class_id"] for r in near_dups.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, **{3 + k: 3 for k in range(6)}}


def test_labels_after_further_links_equal_those_of_all(spark):
    rng = random.Random(6)
    links = [tuple(bytes([x]) for x in rng.sample(range(60), 2)) for _ in range(36)]
    some, more = (spark.createDataFrame(x, "a binary, b binary") for x in (links[:24], links[24:]))
    want = near_dups.components(some.unionByName(more)).collect()
    got = near_dups._joined(near_dups.components(some), more).collect()
    assert sorted((bytes(r["node"]), bytes(r["label"])) for r in got) == sorted((bytes(r["node"]), bytes(r["label"])) for r in want)


def test_bit_parallel_distance_equals_full_edit_distance():
    rng = random.Random(8)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(40))] for _ in range(2))
        want = _distance(a, b) if a and b else max(len(a), len(b))
        for limit in (want - 1, want, 100):
            got = near_dups._bit_distance(near_dups._bit_masks(np.array(a, np.int64)), len(a), b, limit)
            assert got == want if want <= limit else got > limit


def test_dedup_keeps_one_row_of_each_class(spark):
    docs = awkward_docs(spark, _family(31))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = near_dups.dedup(docs)
    assert out.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert sorted(str(d) for d, _ in kept) == sorted(str(c) for c in {str(x): x for x in _classes(rows)}.values())


def test_many_different_copies_make_pairs_in_proportion(spark):
    base = prose(5, 300).split()
    rows = []
    for i in range(400):
        w = list(base)
        w[i % 300] = f"z{i}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dups.classes(docs).collect()
    assert {r["class_id"] for r in got} == {0} and {r["class_size"] for r in got} == {400}


def test_banded_alignment_equals_full_edit_distance():
    rng = random.Random(3)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(150):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 60))]
        b = list(a)
        for _ in range(rng.randrange(0, 9)):
            k = rng.randrange(len(b) + 1)
            b[k:k + rng.randrange(2)] = [rng.randrange(6)] * rng.randrange(2)
        longest = max(len(a), len(b))
        want = 1 - distance(a, b) / longest
        got = near_dups.edit_similarity(np.array(a, dtype=U), np.array(b, dtype=U), 0.8)
        assert abs(got - want) < 1e-12 if want >= 0.8 else got == 0.0


def test_alignment_of_long_texts_takes_linear_memory():
    import tracemalloc

    rng = np.random.default_rng(4)
    a = rng.integers(0, 50_000, 20_000).astype(U)
    b = np.insert(a, np.sort(rng.choice(20_000, 2_000, replace=False)), U(60_000))  # 10% more words
    c = a.copy()
    c[::8] = 70_000  # every eighth word is another
    tracemalloc.start()
    assert near_dups.edit_similarity(a, b, 0.8) == 1 - 2_000 / 22_000
    assert near_dups.edit_similarity(b, a, 0.8) == 1 - 2_000 / 22_000
    assert near_dups.edit_similarity(a, c, 0.8) == 1 - 2_500 / 20_000
    assert near_dups.edit_similarity(a, a[::-1].copy(), 0.8) == 0.0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20


def test_word_hashes_depend_on_the_word_alone():
    import pyarrow as pa

    texts = ["Ab c\td\n", None, "", "c  ab", "é É x" * 3, "d" * 700_000 + " ab"]
    hashes, bounds = word_hashes(pa.array(texts))
    seen = {}
    for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        w = tokens(t)
        assert len(w) == b - a
        for x, h in zip(w, hashes[a:b], strict=True):
            assert seen.setdefault(x, h) == h
    assert len(set(map(int, seen.values()))) == len(seen)


def _normal(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def test_leaks_equal_brute_force(spark):
    items = [(i, " ".join(words(500 + i, n))) for i, n in enumerate((5, 6, 9, 14, 30, 55, 56, 200))]
    items += [(20, None), (21, ""), (22, "Only four words, here"), (23, items[3][1]), (24, "two plus two"), (25, "one TWO"), (26, "zyx!"), (27, "not there at all")]
    rng = random.Random(1)
    extra = []
    for k in range(40):
        w = words(900 + k, rng.choice((10, 300, 4000)))
        cut = rng.randrange(len(w))
        _, text = items[k % 8]
        part = text.split()
        part[rng.randrange(len(part))] = "other" if k % 3 else part[0]
        if k % 5 == 0:
            part += [["only", "four", "words", "here"], ["two", "plus", "two", "and"], ["zyx"]][k // 5 % 3]
        extra.append((2000 + k, " ".join([*w[:cut], *(", ".join(part).upper() if k % 2 else " ".join(part)).split(), *w[cut:]]), "en", "x"))
    docs = awkward_docs(spark, extra)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for r in docs.collect():
        w = _normal(r["text"])
        held = {tuple(w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1)}
        for i, t in items:
            v = _normal(t)
            s = {tuple(v[j:j + 5]) for j in range(len(v) - 4)} or ({tuple(v)} if v else set())
            if s and len(s & held) >= 0.8 * len(s) - 1e-9:
                want.add((r["doc_id"], i, len(s), len(s & held)))
    got = {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == want and len(want) > 15
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    bad = {d for d, *_ in want}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in docs.collect() if r["doc_id"] not in bad)


def test_empty_tables(spark):
    assert near_dups.classes(no_docs(spark)).count() == 0
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.leaks(no_docs(spark), bench).count() == 0
    assert decontaminate.decontaminate(awkward_docs(spark), bench.limit(0)).count() == awkward_docs(spark).count()


def test_benchmark_texts_are_found_whatever_their_id(spark):
    texts = [" ".join(words(700 + i, 40)) for i in range(6)]
    items = [(None, texts[0]), (None, texts[1]), (1, texts[2]), (1, texts[3]), (1, texts[3].upper()), (2, texts[4]), (3, texts[4]), (4, texts[5])]
    rows = [(i, f"{prose(40 + i, 60)}\n{t}\n{prose(60 + i, 60)}") for i, t in enumerate(texts)] + [(9, prose(50, 200))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r["doc_id"], str(r["item_id"]), r["containment"]) for r in decontaminate.leaks(docs, bench).collect())
    assert got == [(0, "None", 1.0), (1, "None", 1.0), (2, "1", 1.0), (3, "1", 1.0), (4, "2", 1.0), (4, "3", 1.0), (5, "4", 1.0)]
    assert [r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect()] == [9]
