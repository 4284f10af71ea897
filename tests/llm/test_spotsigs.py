from __future__ import annotations

import hashlib
import random
import re
from itertools import islice

import pytest

from cartlake.llm import queries, spotsigs
from cartlake.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, piece int, edge string, after string, row int"


def chains(text):
    """Anchor and the two content words after it, by words and not by hashes."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    common = {w.decode() for w in spotsigs.ANCHORS}
    out = set()
    for i, w in enumerate(words):
        after = list(islice((x for x in islice(words, i + 1, i + 400) if x not in common), 2)) if w in common else []
        if len(after) == 2:
            out.add((w, *after))
    return out or ({" ".join(words)} if words else set())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    """``rows``: (doc_id, text) with doc_ids that do not repeat, unless the texts do too."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [r[1] or "" for r in rows]
    sets, out = [chains(t) for t in texts], []
    for k, (doc_id, _) in enumerate(rows):
        text, after = texts[k], texts[(k + 1) % len(rows)]
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), round(likeness(sets[k], chains(new)), 12), round(likeness(sets[k], sets[(k + 1) % len(rows)]), 12)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 12), round(r.near_next, 12)) for r in df.collect()), key=repr)


def test_signatures():
    text = "The Quick brown fox, and the LAZY dog; is it a ïdea of né?"
    assert len(spotsigs.signatures(text)) == len(chains(text)) > 3
    assert len(spotsigs.signatures("fox dog")) == 1 and len(spotsigs.signatures("the of")) == 1
    assert len(spotsigs.signatures(None)) == len(spotsigs.signatures(" !?")) == 0
    assert spotsigs.jaccard(spotsigs.signatures(""), spotsigs.signatures("x")) == 0
    assert spotsigs.jaccard(spotsigs.signatures(""), spotsigs.signatures(None)) == 1
    assert spotsigs.jaccard(*map(spotsigs.signatures, ("the a1 b1 of c1 d1", "the a1 b1")), 0.9) == 0


def test_edits_against_brute_force(spark):
    data = [(None, "the one two"), (1, "the quick brown fox " * 3), (1, "the quick brown fox " * 3), (2, None), (3, ""), (5, "é" * 7), (8, "the lazy dog " * 1_000), (9, "x"), (-4, "of the 🙂 house and a dog 🙂"), (2**40, "a b")]
    docs = lambda rows: spark.createDataFrame([(*r, 1, "e", "a", 2) for r in rows], DOCS)
    assert rows_of(spotsigs.edits(docs(data).repartition(4))) == brute(data)
    assert rows_of(spotsigs.edits(docs(data[1:2]))) == brute(data[1:2])
    assert spotsigs.edits(docs([])).count() == spotsigs.groups(docs([])).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_many_ranges(spark, parts):
    rng = random.Random(3)
    vocab = ["the", "of", "und", *(f"w{k}" for k in range(50))]
    data = [(i * 3, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 5, 60])))) for i in range(400)]
    docs = spark.createDataFrame([(*r, 1, "e", "a", 2) for r in data], DOCS).repartition(parts)
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", str(parts))
    path = str(spotsigs.settle(docs, "t").inputFiles()[0].rsplit("/", 1)[0])
    assert rows_of(spotsigs.edits(session.read.schema(DOCS).parquet(path))) == brute(data)


def test_groups_against_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    vocab = ["the", "of", "und", "a", *(f"w{k}" for k in range(400))]
    data = []
    for _ in range(40):
        words = rng.choices(vocab, k=rng.choice([3, 12, 60, 200]))
        for _ in range(rng.choice([1, 1, 3, 6])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 2, len(words) // 20])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            data.append((len(data), " ".join(copy)))
    data += [(1000, None), (1001, ""), (None, data[0][1]), (None, "the quite alone words"), (3, data[0][1])]
    sets = [chains(t or "") for _, t in data]
    home = list(range(len(data)))
    for i in range(len(data)):
        for j in range(i):
            if likeness(sets[i], sets[j]) >= 0.8:
                home = [home[j] if h == home[i] else h for h in home]
    least = {h: min((d for k, (d, _) in enumerate(data) if home[k] == h and d is not None), default=None) for h in home}
    want = sorted(((d, least[h]) for (d, _), h in zip(data, home)), key=repr)
    docs = spark.createDataFrame([(*r, 1, "e", "a", 2) for r in data], DOCS).repartition(3)
    assert sorted(((r.doc_id, r.component_id) for r in spotsigs.groups(docs).collect()), key=repr) == want
    monkeypatch.setattr(spotsigs, "SETS", 3)
    assert sorted(((r.doc_id, r.component_id) for r in spotsigs.groups(docs).collect()), key=repr) == want


def test_query_against_brute_force(spark):
    rows = queries.QUERIES["op11_document_fingerprints"](spark, SF)
    data = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert rows_of(rows) == brute(data)
    names = {}
    for r in rows.collect():
        names.setdefault(r.fingerprint, set()).add(frozenset(chains(dict(data)[r.doc_id] or "")))
    assert all(len(s) == 1 for s in names.values()) and len(names) == len({x for s in names.values() for x in s})
