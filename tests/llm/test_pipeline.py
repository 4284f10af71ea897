from __future__ import annotations

import hashlib
import sys
from pathlib import Path

import numpy as np
import sentencepiece

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402
from cartlake.llm import pieces, toxicity  # noqa: E402
from cartlake.llm.common import TABLES, settle, table  # noqa: E402
from cartlake.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = text.encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else {b""}


def test_every_stage_against_a_plain_version(spark):
    import test_decontaminate
    import test_suffix_dedup

    docs = table(spark, SF, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    model = toxicity.learned(docs, table(spark, SF, "labels"))
    find = toxicity.Finder(frozenset(model.terms)).found

    docs = settle(corpus_pipeline.STAGES[0][1](spark, docs, SF), "t1")
    after = {r.doc_id: r for r in docs.collect()}
    assert after == {i: r for i, r in before.items() if model.chances(find(r.text))[0] < 0.5}

    before, docs = after, settle(corpus_pipeline.STAGES[1][1](spark, docs, SF), "t2")
    after = {r.doc_id: r for r in docs.collect()}
    sets = {i: shingles(r.text) for i, r in before.items()}
    alike = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    assert all(after[i] == before[i] for i in after)
    # No two that are left are clearly alike, and what went has something like it.
    ids = sorted(before)
    assert max(alike(i, j) for i in after for j in after if i < j) < 0.85
    assert all(max(alike(i, j) for j in ids if j != i) > 0.55 for i in before.keys() - after.keys())

    before, docs = after, settle(corpus_pipeline.STAGES[2][1](spark, docs, SF), "t3")
    after = {r.doc_id: r for r in docs.collect()}
    left = {r[0]: r for r in test_suffix_dedup.brute([(i, r.text) for i, r in before.items()])}
    assert after.keys() == before.keys()
    for i, r in after.items():
        assert (r.lang, r.source, r.n_chars) == (before[i].lang, before[i].source, len(r.text))
        assert hashlib.sha256(r.text.encode()).hexdigest() == left[i][4] or len(r.text.encode()) < left[i][1] - left[i][2]

    before, docs = after, settle(corpus_pipeline.STAGES[3][1](spark, docs, SF), "t4")
    after = {r.doc_id: r for r in docs.collect()}
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    dirty = {r[0] for r in test_decontaminate.brute([(i, r.text) for i, r in before.items()], items) if r[4]}
    assert after == {i: r for i, r in before.items() if i not in dirty}

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    want = {}
    for i, r in after.items():
        ids = lib.encode(r.text, add_bos=True, add_eos=True)
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in QUERIES["pipeline"](spark, SF).collect()} == want


def test_odd_tables(spark, monkeypatch):
    schema = TABLES["documents"] + ", component_id int, row string, _row int, _left string, _dirty int, node int, tile string, doc int"
    rows = [(None, None, None, None, None, 1, "a"), (1, "", "en", "s", 0, 2, "b"), (1, "", "en", "s", 0, 2, "b"), (2, "one two", "en", "s", 7, None, None), (3, "w " * 20_000, "en", "s", 40_000, 3, "c")]
    rows = [(*r, 7, "l", 8, 9, "t", 10) for r in rows]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = settle(stage(spark, docs, SF), "odd")
            assert docs.columns == columns, name
            assert {tuple(r[7:]) for r in docs.collect()} == ({(7, "l", 8, 9, "t", 10)} if data else set()), name
        out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        assert sorted((r.doc_id or 0) for r in out) == ([0, 1, 2, 3] if data else [])
