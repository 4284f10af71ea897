from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlake.llm import quality, queries, toxicity
from cartlake.llm.common import table

SF = "/root/testdata/sf0.01"
DOCS, LABELS = "doc_id bigint, text string, toxic string, label string", "doc_id bigint, quality int, toxic int, text string"


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_quality_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op9_quality_classifier"](spark, SF).collect()}
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(r.held_out == fold(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in rows.items())
    tests = [(r.quality, rows[r.doc_id]) for r in table(spark, SF, "labels").collect() if fold(r.doc_id)]
    good = [p.score for q, p in tests if q]
    bad = [p.score for q, p in tests if not q]
    ranked = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert ranked > 0.95 and np.mean([p.predicted == q for q, p in tests]) > 0.9


def test_quality_scores_whole_texts_as_the_plain_mean(spark):
    model = quality.Model(np.random.default_rng(1).normal(size=quality.BUCKETS), 0.3)
    texts = [None, "", "  ", "One two", "one two one", "x" * 3000, "word " * 60_000]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)] + [(None, "One two", "a", "b")], DOCS)
    got = {r.doc_id: r.score for r in quality.scored(df, model).collect()}
    for i, t in enumerate(texts):
        adds = [model.adds[b] for w in (t or "").lower().split() for b in quality.features(w)]
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(0.3 + (sum(adds) / len(adds) if adds else 0)))), abs=1e-9)
    assert got[None] == pytest.approx(got[3]) and quality.scored(df.where("false"), model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, None, None, "")], [(1, 1, 1, ""), (2, 1, 1, "")], [(1, 0, 0, ""), (None, 1, 1, ""), (99, 1, 1, ""), (2, 7, 7, "")]])
def test_labels_that_teach_little(spark, labels):
    docs = spark.createDataFrame([(1, "a b", "", ""), (2, None, "", ""), (2, "c", "", "")], DOCS)
    marks = spark.createDataFrame(labels, LABELS)
    assert quality.classified(docs, marks).count() == 3
    assert [r.toxic for r in toxicity.graded(docs, toxicity.learned(docs, marks)).collect()] == [False] * 3


def test_toxicity_on_held_out_rows(spark):
    """English texts: in the small tables the labels of the other languages follow nothing that is in the texts."""
    docs = {r.doc_id: r.lang for r in table(spark, SF, "documents").collect()}
    rows = {r.doc_id: r for r in queries.QUERIES["op10_toxicity"](spark, SF).collect()}
    assert rows.keys() == docs.keys()
    tests = [(r.toxic, rows[r.doc_id]) for r in table(spark, SF, "labels").collect() if fold(r.doc_id)]
    assert np.mean([p.toxic for t, p in tests if t and docs[p.doc_id] == "en"]) > 0.85 and np.mean([p.toxic for t, p in tests if not t]) < 0.02
    assert all(0 <= r.severity <= 3 and 0 <= r.grade <= 3 and r.toxic == (r.grade >= 1) for r in rows.values())


def test_stems_of_inflected_words(spark):
    words = [f"w{k}x" for k in range(300)]
    rng = np.random.default_rng(2)
    rows = [(k, " ".join(rng.choice(words, 60)) + (f" grumbl{rng.choice(words)}" if k % 5 == 0 else ""), "", "") for k in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.learned(docs, spark.createDataFrame([(k, 1, int(k % 5 == 0), "") for k in range(400)], LABELS))
    assert {r.doc_id: r.toxic for r in toxicity.graded(docs, model).collect()} == {k: k % 5 == 0 for k in range(400)}


def test_ordered_thresholds_share_weights():
    model = toxicity.Model({"bad": 0, "worse*": 1}, np.array([2.0, 4.0]), np.array([1.0, 2.0, 4.0]))
    none, some, most = (model.chances(c) for c in ({}, {"bad": 1}, {"bad": 3, "worse*": 2}))
    assert (np.diff(none) <= 0).all() and none.sum() < some.sum() < most.sum()
    assert np.allclose(np.log(some / (1 - some)), 2 * math.log(2) - model.thresholds)


def test_denied_rows(spark):
    model = toxicity.Model({"bad": 0}, np.array([9.0]), np.array([1.0, 2.0, 3.0]))
    df = spark.createDataFrame([(1, "so BAD!", "x", "y"), (2, "good", None, None), (None, None, None, None), (3, "w " * 50_000 + "bad", "", "")], DOCS)
    kept = toxicity.deny(df, model)
    assert kept.schema == df.schema and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2]
    assert toxicity.deny(df.where("false"), model).count() == toxicity.graded(df.where("false"), model).count() == 0


def test_no_telling_term_is_left_out(spark):
    rng = np.random.default_rng(9)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    words = sorted({"".join(rng.choice(letters, 9)) for _ in range(1200)})
    # Every word is in six toxic texts, eighteen to a text.
    slots = words * 6
    rows = [(k, " ".join(slots[k * 18 : k * 18 + 18]), "", "") for k in range(len(slots) // 18)]
    rows += [(1000 + k, f"plain text {k}", "", "") for k in range(4000)]
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.fit(docs, spark.createDataFrame([(i, 1, int(i < 1000), "") for i, *_ in rows], LABELS))
    assert all(model.weights[model.terms[w]] > 0 for w in words)


def test_labels_without_a_document_use_up_no_sample(spark):
    docs = spark.createDataFrame([(k, "vile words here" if k % 2 else "good plain text", "", "") for k in range(40)], DOCS)
    marks = spark.createDataFrame([(k, k % 2, k % 2, "") for k in range(4000)], LABELS)
    model = quality.fit(docs, marks.select("doc_id", F.col("quality").alias("label")), sample=40)
    assert {r.doc_id: r.predicted for r in quality.scored(docs, model, 0.5).collect()} == {k: k % 2 for k in range(40)}
    model = toxicity.fit(docs, marks, sample=40)
    assert {r.doc_id: r.toxic for r in toxicity.graded(docs, model).collect()} == {k: k % 2 == 1 for k in range(40)}
