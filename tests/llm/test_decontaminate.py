from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest

from cartlake.llm import decontaminate, queries

SF = "/root/testdata/sf0.001"
DOCS, ITEMS = "doc_id bigint, text string, items string, row int", "item_id bigint, text string, doc_id int"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, t in items:
            v = words(t)
            k = min(10, len(v))
            wins = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if v else set()
            for i in range(len(w) - k + 1 if v else 0):
                if tuple(w[i : i + k]) in wins:
                    hit |= set(range(i, i + k))
                    ids |= {str(item_id)} if item_id is not None else set()
        out.append((doc_id, len(w), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=repr)


DOC_ROWS = [
    (1, "a b c d e f g h i j k l m"), (2, "X a, B-c d E f g h i J k! l m n 9"), (3, None), (4, ""), (None, "Short Item"),
    (5, "short item short item short"), (5, "short item short item short"), (6, "né Né ÉÉ shorts item"), (7, "w " * 40_000 + "short item"), (8, "x x x x x x x x x x x x"),
]
ITEM_ROWS = [(10, "A b c d e f g h i j k l"), (2, "short item"), (2, "short item"), (3, None), (4, " ,. "), (None, "né"), (11, "x " * 11), (12, "b c d e f g h i j k")]


@pytest.mark.parametrize("bound", [decontaminate.AUTOMATON_BYTES, 20])
def test_against_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "AUTOMATON_BYTES", bound)
    docs = spark.createDataFrame([(*r, "x", 1) for r in DOC_ROWS], DOCS)
    items = spark.createDataFrame([(*r, 1) for r in ITEM_ROWS], ITEMS)
    rows = decontaminate.hits(docs, items).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows), key=repr) == brute(DOC_ROWS, ITEM_ROWS)
    two = next(r for r in rows if r.doc_id == 2)
    assert [DOC_ROWS[1][1][s.a : s.b] for s in two.chars] == ["a, B-c d E f g h i J k! l"]
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", "x", 1)], DOCS), spark.createDataFrame([], ITEMS)
    assert [(r.n_hit, r.contaminated) for r in decontaminate.hits(docs, items).collect()] == [(0, False)]
    assert decontaminate.hits(docs.where("false"), items).count() == 0 and decontaminate.decontaminate(docs, items).count() == 1


def test_query_against_sql(spark):
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
    from tools.check import canonical, oracle_rows

    df = queries.QUERIES["op7_decontaminate"](spark, SF)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(*oracle_rows(SF, queries.ORACLES["op7_decontaminate"]))
