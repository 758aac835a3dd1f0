import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfcast.llm import katz, quality

from .helpers import awkward_docs, no_docs, prose, tokens


def _held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def _brute(rows):
    """Dictionary Katz model: a function (context, word) -> probability, counts, tokens."""
    uni, bi, after = Counter(), defaultdict(Counter), Counter()
    for d, t in rows:
        if _held(d):
            continue
        p = "<s>"
        for w in [*tokens(t), "</s>"]:
            uni[w] += 1
            bi[p][w] += 1
            after[p] += 1
            p = w
    n = sum(uni.values())

    def of(counts):
        held = Counter(counts)
        return katz.discounts(np.array([held[r] for r in range(1, katz.K + 2)]))

    d1, d2 = of(uni.values()), of(c for h in bi.values() for c in h.values())
    p1 = {w: d1[min(c, katz.K + 1)] * c / n for w, c in uni.items()}
    unknown = 1 - sum(p1.values())
    alpha = {h: (1 - sum(d2[min(c, katz.K + 1)] * c / after[h] for c in f.values())) / (1 - sum(p1[w] for w in f)) for h, f in bi.items()}

    def p(h, w):
        c = bi[h][w] if h in bi else 0
        return d2[min(c, katz.K + 1)] * c / after[h] if c else alpha.get(h, 1.0) * p1.get(w, unknown)

    return p, uni, bi, n


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(2)
    stock = [f"v{i}" for i in range(60)]
    rows = []
    for i in range(200, 330):
        w, text = r.choice(stock), []
        for _ in range(r.randrange(0, 80)):
            w = stock[(stock.index(w) * 7 + min(r.randrange(9), r.randrange(9))) % 60]
            text.append(w if r.random() > 0.02 else f"rare{r.randrange(10_000)}")
        rows.append((i, " ".join(text), "en", "m"))
    return awkward_docs(spark, rows)


@pytest.mark.parametrize("hot_tokens, block_tokens, bucket_tokens", [(10**9, katz.BLOCK_TOKENS, katz.BUCKET_TOKENS), (20, 700, 1500)])
def test_scores_equal_a_dictionary_model(spark, docs, monkeypatch, hot_tokens, block_tokens, bucket_tokens):
    monkeypatch.setattr(katz, "HOT_TOKENS", hot_tokens)
    monkeypatch.setattr(katz, "BLOCK_TOKENS", block_tokens)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", bucket_tokens)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    p, uni, bi, n = _brute(rows)
    want = []
    for d, t in rows:
        score, base, h, w = 0.0, 0.0, "<s>", [*tokens(t), "</s>"]
        for x in w:
            score += math.log10(p(h, x))
            base += math.log10((uni[x] + 1) / (n + len(uni) + 1))
            h = x
        want.append((str(d), _held(d), len(w), sum(uni[x] > 0 for x in w), n, round(base, 6), round(score, 6)))
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6))
           for r in katz.score_documents(docs).collect()]
    near = lambda a, b: a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-5 and abs(a[6] - b[6]) < 1e-5
    assert all(near(a, b) for a, b in zip(sorted(want), sorted(got), strict=True))
    for h in list(bi)[:5]:  # exactly normalised over the training types and the unknown type
        assert abs(sum(p(h, w) for w in uni) + p(h, "<never seen>") - 1) < 1e-9


def test_discounts_fall_back_on_irregular_counts():
    for counts in ([0] * 6, [5, 0, 0, 0, 0, 0], [1, 100, 1, 100, 1, 100], [900, 300, 150, 90, 60, 40]):
        d = katz.discounts(np.array(counts))
        assert d[0] == 0 and all(0 < x < 1 for x in d[1:])


def test_no_training_text(spark):
    one = spark.createDataFrame([(i, "a b") for i in range(400) if _held(i)], "doc_id long, text string")
    rows = katz.score_documents(one).collect()
    assert rows and {(r["train_tokens"], r["n_known"], r["score"]) for r in rows} == {(0, 0, 0.0)}
    assert katz.score_documents(no_docs(spark)).count() == 0


# ------------------------------------------------------------------ quality

def _labelled(spark):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(1200):
        text, junk, toxic = prose(10_000 + i, r.randrange(20, 200)), 0, 0
        kind = r.random()
        if kind < 0.06:
            text, junk = " ".join(w.upper() + "!!" for w in text.split()), 1
        elif kind < 0.12:
            text, junk = " ".join(w + r.choice(("***", "%%%")) for w in text.split()), 1
        elif kind < 0.18:
            text, junk = " ".join(w for w in text.split() for _ in range(9)), 1
        elif kind < 0.26:
            parts = text.split()
            for _ in range(3):  # made-up insults: only the labels know them
                parts.insert(r.randrange(len(parts)), "grobulon" + r.choice("aeiou"))
            text, toxic = " ".join(parts), 1
        elif kind < 0.32:
            text, toxic = text + " you idiot, pathetic scum", 1
        rows.append((i, text, "en", "q"))
        if r.random() < 0.5:
            labels.append((i, 1 - junk, toxic))
        rows[-1] = (*rows[-1][:4],)
        rows[-1] = (i, text, "en", "bad" if junk or toxic else "good")
    return awkward_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_rejects_junk_and_toxic_and_keeps_clean(spark):
    docs, labels = _labelled(spark)
    out = quality.scores(docs, labels).join(docs.select("doc_id", "source"), "doc_id").filter("source in ('good', 'bad')").collect()
    good, bad = [r["keep"] for r in out if r["source"] == "good"], [r["keep"] for r in out if r["source"] == "bad"]
    assert len(bad) > 200 and sum(good) >= 0.99 * len(good) and sum(bad) <= 0.03 * len(bad)
    rest = quality.reject(docs, labels)
    assert rest.columns == docs.columns
    kept = [r["text"] for r in rest.collect()]
    assert None not in kept and "" not in kept and " \t\n" not in kept


def test_classifier_on_empty_tables(spark):
    docs, labels = awkward_docs(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.scores(docs, labels).collect()
    assert len(rows) == docs.count()
    assert quality.scores(no_docs(spark), labels).count() == 0


def test_expectation_maximisation_recovers_the_labellers():
    rng = np.random.default_rng(0)
    truth = rng.random(40_000) < 0.2
    rates = np.array([[0.02, 0.85], [0.05, 0.7], [0.1, 0.6], [0.01, 0.4]])
    votes = (rng.random((len(truth), 4)) < rates[:, truth.astype(int)].T).astype(int)
    patterns, at, counts = np.unique(np.column_stack([votes, np.full(len(truth), -1)]), axis=0, return_inverse=True, return_counts=True)
    posterior, found, share = quality.expectation_maximisation(patterns, counts.astype(float))
    assert abs(share - 0.2) < 0.02
    assert np.allclose(found[:, 1:8:2].T, rates, atol=0.05)
    assert ((posterior[at] > 0.5) == truth).mean() > 0.95


def test_a_vote_of_three_levels_equals_the_closed_form():
    """One labeller of three levels and labels on half the rows: rates and posteriors of a plain EM."""
    patterns = np.array([[level, 1 if level > 1 else 0, label] for level in range(3) for label in (-1, 0, 1)])
    counts = np.array([700.0, 90, 5, 60, 20, 30, 50, 3, 80])
    posterior, _, share = quality.expectation_maximisation(patterns, counts, steps=40)
    post = np.where((patterns >= 1).any(axis=1), 0.9, 0.05)
    post = np.where(patterns[:, -1] == 1, 0.99, np.where(patterns[:, -1] == 0, 0.01, post))
    for _ in range(40):
        logs = []
        for mass, prior in ((counts * (1 - post), 1 - post), (counts * post, post)):
            p = np.log((counts @ prior + 1) / (counts.sum() + 2))
            each = np.full(len(patterns), p)
            for j, size in enumerate((3, 2, 2)):
                seen = patterns[:, j] >= 0
                rate = [(mass[patterns[:, j] == v].sum() + 0.5) / (mass[seen].sum() + 0.5 * size) for v in range(size)]
                each[seen] += np.log([rate[v] for v in patterns[seen, j]])
            logs.append(each)
        post = 1 / (1 + np.exp(logs[0] - logs[1]))
    assert np.allclose(posterior, post, atol=1e-9) and 0 < share < 1
    assert posterior[6] > posterior[3] > posterior[0]  # the level orders the unlabelled rows


def test_scores_equal_a_plain_scorer(spark):
    """Every score is the bias plus the weights of the distinct features that a plain walk over the text finds."""
    docs = awkward_docs(spark, [(100 + i, prose(i, 40).upper() if i % 4 == 0 else prose(i, 40), "en", "q") for i in range(60)])
    labels = spark.createDataFrame([(100 + i, int(i % 4 != 0), 0) for i in range(40)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    scored = quality.scored(docs.select("doc_id", "text"), labels).collect()
    assert len(scored) == docs.count()
    import pyarrow as pa

    for r in scored:
        (_, _, features, _, share), = quality._each_chunk(pa.array([r["text"] or ""]))
        codes, _ = quality._style_features(share)
        held = {int(x) for x in (*features, *codes)}
        for t, task in enumerate(quality.TASKS):
            known, weights, bias = model[task]
            want = bias + sum(w for f, w in zip(known.tolist(), weights, strict=True) if f in held)
            if t == 0 and share[0, 0] < 0:
                want = max(want, 1.0)
            assert abs(want - r["__junk" if t == 0 else "__toxic"]) < 1e-9


def test_a_doc_id_of_many_rows_is_one_row_of_the_fits(spark, monkeypatch):
    fitted, fit = [], quality.logistic
    monkeypatch.setattr(quality, "logistic", lambda starts, *rest: fitted.append(len(starts)) or fit(starts, *rest))
    docs, labels = _labelled(spark)
    docs = docs.select("doc_id", "text").filter("doc_id < 300")
    hot = spark.range(400).selectExpr("7L as doc_id", "concat('one more text number ', cast(id % 200 as string)) as text")
    out = quality.scores(docs.unionByName(hot), labels.filter("doc_id < 300")).count()
    assert out == docs.count() + 400
    assert len(fitted) == 4 and max(fitted) <= docs.select("doc_id").distinct().count()


def test_every_significant_feature_may_carry_weight(spark):
    n = 7_000
    counts = spark.range(n).selectExpr("id as feature", "10D as docs", "0D as junk", "10D as toxic")
    assert list(quality._candidates(counts, "toxic", 10_000.0, 500.0)) == list(range(n))
    assert len(quality._candidates(counts, "junk", 10_000.0, 500.0)) == 0


def test_gradients_in_blocks_give_the_same_weights(monkeypatch):
    rng = np.random.default_rng(7)
    lengths = rng.integers(1, 30, 400)
    lengths[50] = 300  # a row longer than a block
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    col, target = rng.integers(0, 60, lengths.sum()).astype(np.int32), (rng.random(400) < 0.3).astype(float)
    whole = quality.logistic(starts, col, target, 60)
    monkeypatch.setattr(quality, "BLOCK_HITS", 64)
    parts = quality.logistic(starts, col, target, 60)
    assert np.allclose(whole[0], parts[0], atol=1e-6) and abs(whole[1] - parts[1]) < 1e-6


def test_text_ids(spark):
    """Ids that are no numbers: the same scores, classes and decisions as with numbers."""
    from shelfcast.llm import near_dups

    from .helpers import changed, prose

    texts = [prose(i, 60) for i in range(5)] + [changed(prose(0, 60), 30)]
    named = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)] + [(None, "x y")], "doc_id string, text string")
    got = {r["doc_id"]: r for r in katz.score_documents(named).collect()}
    assert set(got) == {*(f"d{i}" for i in range(6)), None} and all(r["score"] < 0 for r in got.values())
    classes = {r["doc_id"]: r["class_id"] for r in near_dups.classes(named).collect()}
    assert classes == {**{f"d{i}": f"d{i}" for i in range(5)}, "d5": "d0", None: None}
    labels = spark.createDataFrame([("d0", 1, 0), ("d1", 0, 1)], "doc_id string, quality int, toxic int")
    assert {r["doc_id"] for r in quality.scores(named, labels).collect()} == set(got)
