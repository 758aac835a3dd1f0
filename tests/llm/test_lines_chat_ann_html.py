import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from shelfcast.llm import ann, chat, html, line_dedup

from .helpers import awkward_docs, no_docs, words

# ------------------------------------------------------------------ line dedup


def _masked(line):
    return tuple("<*>" if any(c in "0123456789" for c in t) else t for t in line.split())


def _brute_lines(rows):
    """Template of every line by the tree, then first documents."""
    leaf = defaultdict(lambda: defaultdict(set))
    for d, t in rows:
        for line in (t or "").split("\n"):
            m = _masked(line)
            if m:
                leaf[(len(m), m[:3])][m].add((d, t))
    name = {}
    for key, masks in leaf.items():
        docs = set().union(*masks.values())
        mixed = key[0] >= 5 and len(masks) > 1 and len(docs) > 1
        shape = []
        for i in range(key[0]):
            counts = defaultdict(int)
            for m in masks:
                counts[m[i]] += 1
            shape.append(counts)
        for m in masks:
            alike = sum(shape[i][m[i]] == max(shape[i].values()) for i in range(key[0]))
            name[m] = ("shape", key) if mixed and alike >= 0.8 * key[0] - 1e-9 else ("mask", m)
    holders = defaultdict(set)
    for key, masks in leaf.items():
        for m, docs in masks.items():
            holders[name[m]] |= docs
    least = lambda docs: min(docs, key=lambda x: (x[0] is None, x[0] or 0))
    out = []
    for d, t in rows:
        kept, dropped = [], 0
        for line in (t or "").split("\n"):
            m = _masked(line)
            docs = holders[name[m]] if m else set()
            if m and len(docs) >= 2 and least(docs) != (d, t):
                dropped += 1
            else:
                kept.append(line)
        out.append((str(d), None if t is None else "\n".join(kept), dropped))
    return sorted(out, key=str)


def test_line_dedup_equals_brute_force(spark):
    r = random.Random(6)
    shared = [" ".join(words(40 + i, n)) for i, n in enumerate((6, 9, 60, 12))] + ["All rights reserved."]
    rows = []
    for i in range(30):
        lines = [" ".join(words(7000 + 50 * i + j, 12)) for j in range(4)] + ["", shared[r.randrange(5)], shared[4]]
        lines.append(f"Order {r.randrange(9999)} was shipped on day {r.randrange(31)} to the customer")
        lines.append(f"The current user {words(i, 1)[0]} has logged in from the office network today")
        r.shuffle(lines)
        rows.append((3000 + i, "\n".join(lines), "en", "l"))
    docs = awkward_docs(spark, rows)
    out = line_dedup.dedup_lines(docs).collect()
    want = _brute_lines([(d["doc_id"], d["text"]) for d in docs.collect()])
    assert sorted(((str(x["doc_id"]), x["text"], x["n_dropped"]) for x in out), key=str) == want
    assert sum(w[2] for w in want) > 60
    texts = [x["text"] for x in out if x["doc_id"] and x["doc_id"] >= 3000]
    assert sum(shared[2] in t for t in texts) == 1 and sum("has logged in from" in t for t in texts) == 1
    assert line_dedup.dedup_lines(no_docs(spark)).count() == 0


def test_a_leaf_may_hold_several_templates(spark):
    names = ["".join(chr(97 + (i * 7 + j * j) % 26) for j in range(4)) + chr(97 + i % 26) + "abcd"[i // 26] for i in range(100)]
    kinds = [("The current user {} has logged in from the office network today", 30), ("The current user {} was locked out after three wrong passwords yesterday", 20),
             ("The current user {} has changed all settings of one old printer", 20), ("The current user {} paid for two more years of service today", 2)]
    rows, name = [], iter(names)
    for text, many in kinds:
        assert len(text.split()) in (11, 12)
        rows += [text.format(next(name)) for _ in range(many)]
    rows = [(i, f"{line}\nown line number x{'y' * i} stays in this document") for i, line in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.dedup_lines(docs).collect()
    left = [r["text"].split("\n")[0] for r in out if "The current user" in r["text"]]
    assert sorted(left) == sorted(text.format(names[at]) for (text, _), at in zip(kinds, (0, 30, 50, 70), strict=True))


# ------------------------------------------------------------------ chat

TURNS = "conv_id long, turn long, role string, text string, n long, pos string"


def _brute_chats(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is None, turn or 0, role or "", role is not None, text))
    full = {c: [(t[2] if t[3] else None, t[4]) for t in sorted(v, key=lambda t: t[:4])] for c, v in convs.items()}
    out = []
    for c, v in full.items():
        if any(len(w) > len(v) and w[:len(v)] == v for w in full.values()):
            continue
        same = [d for d, w in full.items() if w == v]
        first = min(same, key=lambda d: (d is None, d or 0))
        if c == first:
            out.append((c, len(v), len(same), "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in v)))
    return sorted(out, key=str)


def test_chats_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_TURNS", 4)  # long conversations are cut into blocks
    r = random.Random(8)
    rows = []
    for c in range(60):
        base = [("user" if i % 2 == 0 else "assistant", f"{c % 9}-{i}" if i else "hello") for i in range(r.randrange(1, 15))]
        rows += [(c, i, role, text) for i, (role, text) in enumerate(base)]
    rows += [(200, 0, None, None), (201, 0, None, ""), (202, 0, "", None), (None, 0, "user", "x"), (None, 1, "user", None),
             (203, None, "user", "last"), (203, 5, "user", "first"), (204, 0, "user", "hello"), (205, 0, "user", "long " * 50_000)]
    turns = spark.createDataFrame([(*x, 1, "p") for x in rows], TURNS)
    got = sorted(((x["conv_id"], x["n_turns"], x["n_equal"], x["text"]) for x in chat.format_chats(turns).collect()), key=str)
    assert got == _brute_chats(rows)
    assert chat.format_chats(turns.limit(0)).count() == 0


# ------------------------------------------------------------------ nearest neighbours

VECTORS = "vec_id long, embedding array<float>, label int, key string, list int"


def _brute_nearest(rows, k, every):
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and len(v) == 16 and None not in v and all(np.isfinite(v)) and any(v)}
    ok = sorted(ok)
    x = np.array([v for _, v in ok], dtype=np.float32).astype(float)
    ids, norms = np.array([i for i, _ in ok]), np.linalg.norm(x, axis=1)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        s = (x * x[q]).sum(axis=1) / (norms * norms[q])
        o = np.lexsort((ids, -s))
        out[int(ids[q])] = [(int(ids[j]), float(s[j])) for j in o if j != q][:k]
    return out


def test_nearest_neighbours_recall_scores_and_ties(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 40)
    monkeypatch.setattr(ann, "LIST_MAX", 64)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    rows = [(i, [float(v) for v in (centres[i % 12] + 0.6 * rng.normal(size=16)).astype(np.float32)]) for i in range(1500)]
    rows += [(i, rows[7][1]) for i in range(5000, 5400)]  # a vector that many rows hold
    rows += [(6000, None), (6050, [0.0] * 16), (6100, [float("nan")] * 16), (6150, [None] * 16), (6200, []), (6250, [1.0] * 3), (None, rows[3][1])]
    rows.append(rows[0])
    frame = spark.createDataFrame([(*r, None, "k", 1) for r in rows], VECTORS)
    got = defaultdict(dict)
    for r in ann.nearest(frame, F.col("vec_id") % 50 == 0).collect():
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    want = _brute_nearest(rows, 5, 50)
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q].values()} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    for q, ranked in got.items():
        assert sorted(ranked) == [1, 2, 3, 4, 5]
        exact = {v: s for v, s in want[q]}
        for v, s in ranked.values():
            assert v != q and (v not in exact or abs(exact[v] - s) < 1e-12)
    assert [v for _, (v, _) in sorted(got[5000].items())] == [7, 5001, 5002, 5003, 5004]
    few = ann.nearest(frame.filter("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2]
    assert ann.nearest(frame.limit(0), F.lit(True)).count() == 0


def test_outliers_and_tiny_clusters_get_all_neighbours(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 40)
    monkeypatch.setattr(ann, "LIST_MAX", 64)
    rng = np.random.default_rng(2)
    centre = np.zeros(16)
    centre[0] = 4.0
    rows = [(i, [float(v) for v in (centre + 0.8 * rng.normal(size=16)).astype(np.float32)]) for i in range(1, 1200) if i % 50]
    far = rng.normal(size=(40, 16))
    far[:, 0] = -abs(far[:, 0]) - 1
    for j, v in enumerate(far):  # one to five close vectors each
        rows += [(10_000 + 50 * j + i, [float(x) for x in (v + 1e-4 * i * rng.normal(size=16)).astype(np.float32)]) for i in range(1 + j % 5)]
    frame = spark.createDataFrame([(*r, None, "k", 1) for r in rows], VECTORS)
    want = _brute_nearest(rows, 5, 50)
    got = defaultdict(dict)
    for r in ann.nearest(frame, F.col("vec_id") % 50 == 0).collect():
        got[r["query_id"]][r["rank"]] = r["vec_id"]
    assert set(got) == set(want) and len(want) == 40
    assert all(sorted(ranked) == [1, 2, 3, 4, 5] for ranked in got.values())
    hits = sum(len(set(got[q].values()) & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    monkeypatch.setattr(ann, "REPLICAS", 0)  # no list is needed: what is missing comes from all lists
    monkeypatch.setattr(ann, "PROBES", 1)
    again = ann.nearest(frame, F.col("vec_id") % 50 == 0).groupBy("query_id").count().collect()
    assert len(again) == 40 and {r["count"] for r in again} == {5}


def test_huge_and_tiny_components(spark):
    """Norms neither overflow nor vanish: parallel vectors have cosine one at any length."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 8))
    rows = [(i, (base[i % 6] * scale).tolist()) for i, scale in enumerate([1.0] * 6 + [1e200] * 6 + [1e-200] * 6)]
    frame = spark.createDataFrame([(*r, None, "k", 1) for r in rows], VECTORS.replace("array<float>", "array<double>"))
    got = defaultdict(list)
    for r in ann.nearest(frame, F.col("vec_id") < 18, 2).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], round(r["score"], 12)))
    assert all({v for v, _ in got[i]} == {(i + 6) % 18, (i + 12) % 18} and [s for _, s in got[i]] == [1.0, 1.0] for i in range(18))


def test_queries_read_a_falling_share_of_the_lists():
    shares = [ann.probes(n) / n for n in (240, 1000, 4000)]
    assert ann.probes(10) == ann.PROBES and shares == sorted(shares, reverse=True)


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(5)
    c = ann._unit(rng.normal(size=(700, 24))).astype(np.float32)
    x = ann._unit(rng.normal(size=(64, 24))).astype(np.float32)
    ids, _ = ann.graph_search(x, c, ann.neighbour_graph(c))
    exact = np.argsort(-(x @ c.T), axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(ids, exact, strict=True)]) > 0.95


# ------------------------------------------------------------------ html

PAGES = "page_id long, url string, html string, key long, text string"


def _text(spark, *pages):
    frame = spark.createDataFrame([(i, u, h, 1, "t") for i, (u, h) in enumerate(pages)], PAGES)
    return {r["page_id"]: r for r in html.extract(frame).collect()}


def test_marked_pages_give_the_article_alone(spark):
    page = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body><nav><ul><li><a href="/a">A</a>'
            '<li>B</ul></nav><!-- c > --><div class="ad">buy</div><article><header><h1>Big  &amp; bold</h1></header><p>One\n\ttwo&nbsp;&#51;<b>x</b>y<br>line<p>Second &lt;p&gt;'
            '<div class="cookie-notice"><p>cookies</p></div><aside>side</aside><form><input><label>f</label></form><ul><li>i1<li>i2</ul><section id="comments"><p>me too</p></section>'
            '</article><footer>&copy; f</footer></body></html>')
    got = _text(spark, ("http://h/x", page), ("http://h/y", None), ("http://h/z", ""), (None, "<article><p>cut &amp off <a href=\"/x"), ("u", "plain < text &copy; &bogus;"))
    assert got[0]["text"] == "Big & bold\nOne two 3xy\nline\nSecond <p>\ni1\ni2" and got[0]["n_chars"] == len(got[0]["text"])
    assert got[1]["text"] == got[2]["text"] == "" and got[1]["n_chars"] == 0
    assert got[3]["text"] == "cut & off" and got[4]["text"] == "plain < text © &bogus;"
    assert _text(spark) == {}


def test_names_mark_as_a_whole_and_all_marked_text_stays(spark):
    got = _text(spark, ("a", "<article><p>one</p><section class='share-price'><p>two</p></section><div class='share-buttons'>s</div><div class='x site-footer'>f</div></article>"),
                ("b", "<main><p>intro</p><article>teaser</article><p>rest</p><div id='ad-slot-2'>buy</div></main><p>outside</p>"),
                ("c", "<div class='content'><div class='banner-history'>kept</div><div class=\"cookie-banner\">gone</div></div>"))
    assert [got[i]["text"] for i in range(3)] == ["one\ntwo", "intro\nteaser\nrest", "kept"]


def _covered(streams, depth):
    """Per stream its tokens inside longest substrings of at least ``depth`` tokens that another page holds too."""
    out = []
    for i, s in enumerate(streams):
        inside = set()
        for at in range(len(s)):
            best = 0
            for j, t in enumerate(streams):
                for b in range(len(t) if j != i else 0):
                    n = 0
                    while at + n < len(s) and b + n < len(t) and s[at + n] == t[b + n]:
                        n += 1
                    best = max(best, n)
            if best >= depth:
                inside |= set(range(at, at + best))
        out.append(inside)
    return out


def test_repeats_cover_what_longest_repeats_cover(spark, monkeypatch):
    r = random.Random(12)
    runs = [words(600 + i, n) for i, n in enumerate((5, 8, 9, 20, 33))]
    streams = []
    for i in range(7):
        parts = [r.choice(runs)[r.randrange(3):] if r.random() < 0.6 else words(900 + 10 * i + k, r.randrange(1, 9)) for k in range(6)]
        streams.append([w for part in parts for w in part])
    streams[6] = streams[5]
    pages = spark.createDataFrame([(i, f"http://h{i // 7}/", f"<p>{' '.join(s)}</p>", i) for i, s in enumerate([*streams, streams[0]])],
                                  "page_id long, url string, html string, key long")
    host = html.F.regexp_extract("url", "//([^/]*)", 1)
    got = {x["key"]: {p + k for p in x["starts"] for k in range(html.DEPTH)} for x in html.repeats(pages.select("key", host.alias("host"), "html")).collect()}
    assert [got.get(i, set()) for i in range(7)] == _covered(streams, html.DEPTH) and 7 not in got
    assert any(got.values())


def test_long_equal_and_unnamed_pages(spark):
    """A very long page, equal rows, null ids and urls, clashing extra columns."""
    long = " ".join(words(5, 40_000))
    frame = spark.createDataFrame([(1, "http://h/1", f"<article><p>{long}</p></article>", "x", 1), (2, "http://h/2", "<p>a b</p>", "y", 2), (2, "http://h/2", "<p>a b</p>", "y", 2),
                                   (None, None, "<p>c</p>", None, None)], "page_id long, url string, html string, host string, n_repeated long")
    got = sorted((str(r["page_id"]), r["text"]) for r in html.extract(frame).collect())
    assert got == [("1", long), ("2", "a b"), ("2", "a b"), ("None", "c")]


def test_unmarked_pages_lose_what_repeats_on_their_host(spark):
    menu = "".join(f"<div><a href='/{i}'>entry number {i}</a></div>" for i in range(5))
    note = "<div>Everything on this site is provided as it is without any promise of use</div>"
    own = [" ".join(words(300 + i, 70)) for i in range(4)]
    pages = [(f"https://site.example/{i}", f"<body>{menu}<div>{own[i]}</div>{note}</body>") for i in range(4)]
    pages.append(("https://other.example/", f"<body>{menu}<div>{own[0]}</div></body>"))
    pages += [("https://copy.example/a", f"<body><div>{own[1]}</div></body>"), ("https://copy.example/b", f"<body><div>{own[1]}</div></body>")]
    got = _text(spark, *pages)
    for i in range(4):
        assert got[i]["text"] == own[i] and got[i]["n_repeated"] > 0
    assert got[4]["text"].startswith("entry number 0\n") and got[4]["n_repeated"] == 0
    assert got[5]["text"] == got[6]["text"] == own[1]
