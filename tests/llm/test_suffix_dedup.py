from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cartlake.llm import queries, suffix_dedup
from cartlake.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, row bigint, key string, zipped binary"


def brute(rows, length=200):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(hash(r[p : p + length]) for _, r in raws for p in range(len(r) - length + 1))
    out = []
    for i, r in raws:
        gone = np.zeros(len(r) + 1, np.int64)
        for p in range(len(r) - length + 1):
            if seen[hash(r[p : p + length])] > 1:
                gone[p] += 1
                gone[p + length] -= 1
        flags = np.cumsum(gone)[: len(r)] > 0
        kept = np.frombuffer(r, np.uint8)[~flags].tobytes()
        spans = int((np.diff(np.concatenate(([0], flags.astype(int)))) == 1).sum())
        out.append((i, len(r), int(flags.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


def test_query_against_brute_force(spark):
    want = brute([(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()])
    assert got(queries.QUERIES["op8_suffix_array_dedup"](spark, SF)) == want


def odd_rows():
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, block = noise(320), noise(199)
    rows = [(k, noise(rng.randrange(0, 300)) + passage + noise(rng.randrange(0, 300))) for k in range(12)]
    rows += [(20, None), (21, ""), (22, block), (23, block), (24, block + "x"), (25, "y" + block + "x"), (26, "a" * 199), (27, "a" * 200), (28, "a" * 201), (29, noise(2000)), (29, noise(400))]
    rows += [(30, noise(77) * 30), (31, "é" * 150), (32, "x" + "é" * 150), (33, passage), (34, passage), (34, passage), (None, passage), (None, None), (35, passage[:260] + "é" + passage[260:])]
    words = noise(3000).split(" ")
    for k in range(40, 52):  # near copies
        edited = [w if rng.random() > 0.01 else noise(3) for w in words]
        rows.append((k, " ".join(edited)))
    return rows


@pytest.mark.parametrize("group_bytes", [suffix_dedup.GROUP_BYTES, 600])
def test_odd_texts(spark, monkeypatch, group_bytes):
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", group_bytes)
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1, "k", b"z") for r in rows], DOCS)
    assert got(suffix_dedup.deduplicated(df)) == brute(rows)
    texts = suffix_dedup.deduplicated(df, keep_text=True).collect()
    assert sum(r.text is None for r in texts) == 2 and all(len((r.text or "").encode()) <= r.n_bytes - r.n_removed for r in texts)


def test_empty_table_and_long_text(spark):
    assert suffix_dedup.deduplicated(spark.createDataFrame([], DOCS)).count() == 0
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefghij ") for _ in range(1_300_000))
    rows = [(1, text), (2, text[600_000:600_500])]
    assert got(suffix_dedup.deduplicated(spark.createDataFrame([(*r, 1, "", b"") for r in rows], DOCS))) == brute(rows)


def test_merged_transforms_of_many_shards(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 700)
    rng = random.Random(6)
    for length in (8, 12, 15):
        pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(length, 90))) for _ in range(60)]
        seen = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
        want = [[seen[p[i : i + length]] > 1 for i in range(len(p) - length + 1)] for p in pieces]
        assert [f.tolist() for f in suffix_dedup.repeated_windows(pieces, length)] == want


def test_gram_hashes():
    data = np.frombuffer(b"abcabcabcabcabcabcabcabc", np.uint8)
    for size in (1, 3, 5, 6, 13):
        h = suffix_dedup.gram_hashes(data, size)
        text = data.tobytes()
        grams = [text[i : i + size] for i in range(len(text) - size + 1)]
        assert len(h) == len(grams) and all((h[i] == h[j]) == (grams[i] == grams[j]) for i in range(len(h)) for j in range(len(h)))
