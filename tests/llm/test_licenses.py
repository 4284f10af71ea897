from __future__ import annotations

import re

from cartlake.llm import licenses, queries
from cartlake.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, row bigint, t int, pos int"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(doc_id, text):
    w = words(text)
    starts = lambda t: [i for i in range(len(w)) if w[i : i + len(t.split())] == t.split()]
    places = [(i, t.label) for t in licenses.BASE for i in starts(t.text)]
    labels, best = {label for _, label in places}, 0.0
    for t in licenses.TEMPLATES:
        masks = {}
        for at, pair in enumerate(t.pairs):
            for i in starts(pair):
                masks.setdefault(i - at, set()).add(at)
        if t.exact:
            lines = [m for m in masks.values()]
        else:
            lines, before = [], None
            for start in sorted(masks):
                if before is None or start - before > 2:
                    lines.append(set())
                lines[-1] |= masks[start]
                before = start
        for m in lines:
            best = max(best, len(m) / len(t.pairs))
            if not t.exact and len(m) / len(t.pairs) >= 0.75:
                labels.add(t.label)
    at = [i for i, _ in places]
    return (doc_id, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), best)


def got(df):
    return sorted((tuple(r) for r in df.drop("spans").collect()), key=repr)


def test_query_against_brute_force(spark):
    want = sorted((brute(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()), key=repr)
    assert any(r[2] for r in want) and got(queries.QUERIES["op2_license_scan"](spark, SF)) == want


def test_odd_texts(spark):
    texts = [
        None, "", "one", "CC", "cc BY cc by", "CC-BY/cc by by cc", "All\nRights *Reserved*", "General Public", "gnu GENERAL public license, version 3",
        "Licensed under the new Apache License, Version 2.0", "Released under MIT License", "K cc by", "Kc by", "ÉCC BY", "cc by é",
        "cc by " * 30_000, "word " * 60_000 + "all rights reserved", "of the " * 500, "İ cc İ by",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "cc by"), (3, "cc by"), (None, "cc by"), (None, None)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], DOCS)
    assert got(licenses.scan(df)) == sorted((brute(*r) for r in rows), key=repr)
    assert licenses.scan(df.where("false")).count() == 0


def test_spans_and_plan(spark):
    df = spark.createDataFrame([(1, "x y Licensed under the new Apache License, Version 2.0 z", 0, 0, 0)], DOCS)
    out = licenses.scan(df)
    (row,) = out.collect()
    assert row["labels"] == "apache-2.0" and [(s.label, s.first, s.last) for s in row.spans] == [("apache-2.0", 2, 10)]
    plan = queries.QUERIES["op2_license_scan"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
