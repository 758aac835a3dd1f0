"""The corpus pipeline stage by stage on small tables: every stage against brute force on its own input."""

import random
import re
import uuid
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from shelfcast.session import work_root

from .helpers import awkward_docs, changed, no_docs, prose, shingles, tokens, words
from .test_near_dups_leaks import _classes


def _tables(spark, docs, labels, items):
    path = f"{work_root(spark)}/tests/pipeline-{uuid.uuid4().hex[:8]}"
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(12)
    items = [(i, " ".join(words(500 + i, 20 + 5 * i))) for i in range(6)]
    rows, labels = [], []
    for i in range(100, 500):
        text, junk, toxic = prose(20_000 + i, r.randrange(30, 150)), 0, 0
        if i % 10 == 0:
            text, junk = " ".join(w.upper() + "!!" for w in text.split()), 1
        elif i % 10 == 1:
            text, toxic = text.replace(" ", " you idiot ", 1) + " pathetic scum", 1
        elif i % 10 == 2:
            text = text + "\n" + items[i % 6][1]
        elif i % 10 == 3:
            text = changed(prose(20_000 + i - 3 + 1, 140) if i % 20 == 3 else prose(77, 140), 45 + i % 7)
        rows.append((i, text, "en", f"s{i % 4}"))
        labels.append((i, 1 - junk, toxic))
    docs = awkward_docs(spark, rows)
    return _tables(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), spark.createDataFrame(items, "item_id long, text string")), items


def test_every_stage_on_its_own_input(spark, tables):
    path, items = tables
    read = lambda df: [(x["doc_id"], x["text"], x["source"]) for x in df.collect()]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, out = docs.columns, {}
    frames = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        saved = f"{path}/out-{name}"
        stage(spark, docs, path).write.parquet(saved)
        docs = spark.read.parquet(saved)
        frames[name] = docs
        out[name] = read(docs)
        if name != "shard":
            assert docs.columns == columns
    # junk, toxic and wordless documents go, the others stay
    kept = {d for d, _, _ in out["quality"]}
    regular = [d for d in range(100, 500)]
    assert not [d for d in regular if d % 10 in (0, 1) and d in kept]
    assert all(d in kept for d in regular if d % 10 > 1)
    assert all(tokens(t) for _, t, _ in out["quality"])
    # one document of each class
    rows = [(d, t) for d, t, _ in out["quality"]]
    assert sorted(str(d) for d, _, _ in out["near_dups"]) == sorted({str(c): str(c) for c in _classes(rows)}.values())
    # no document holds an item, nothing else went
    normal = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    sets = [shingles(normal(t)) for _, t in items]
    leaks = lambda t: any(len(s & shingles(normal(t))) >= 0.8 * len(s) for s in sets)
    assert sorted(map(str, out["decontaminate"])) == sorted(str(x) for x in out["near_dups"] if not leaks(x[1]))
    assert len(out["decontaminate"]) < len(out["near_dups"])
    # copies of whole documents near each source's target
    before, after = Counter(), Counter()
    for _, t, s in out["decontaminate"]:
        before[s] += len(tokens(t))
    for _, t, s in out["mix"]:
        after[s] += len(tokens(t))
    from .test_mix_shard import _targets

    longest = max(len(tokens(t)) for _, t, s in out["decontaminate"])
    assert all(abs(after[s] - x) <= 2 * longest for s, x in _targets(before).items())
    assert set(map(str, out["mix"])) <= set(map(str, out["decontaminate"])) and max(Counter(map(str, out["mix"])).values()) <= 3
    # shards hold every record once
    assert Counter(map(str, out["shard"])) == Counter(map(str, out["mix"]))
    slots = defaultdict(list)
    for x in frames["shard"].select("shard", "slot").collect():
        slots[x["shard"]].append(x["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_run_on_empty_documents(spark):
    path = _tables(spark, no_docs(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int"), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string"))
    assert corpus_pipeline.run(spark, path).count() == 0


@pytest.mark.parametrize("use", ["quality", "near_dups"])
def test_arrow_batches_of_long_rows_are_bounded(spark, use):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from shelfcast.llm import common, near_dups, quality

    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(conf)
    docs = spark.range(0, 60, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 20_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

    try:
        if use == "quality":
            quality.scored(docs.limit(2), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
        else:
            near_dups.sketches(docs)
        got = [r[0] for r in docs.mapInArrow(sizes, "bytes long").collect()]
    finally:
        spark.conf.unset(conf)
    assert sum(got) > 12_000_000 and max(got) < common.BATCH_BYTES + 1_000_000
