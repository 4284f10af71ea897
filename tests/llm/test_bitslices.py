from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from cartlake.llm import bitslices, queries
from cartlake.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS, ITEMS = "doc_id bigint, text string, items string, score int, item int", "item_id bigint, text string, rank int"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, top=10):
    bags = [(i, Counter(w), len(w)) for i, t in docs if (w := words(t))]
    n, total = len(bags), sum(b[2] for b in bags)
    out = []
    for item_id, text in {(i, t) for i, t in items}:
        ranked = []
        for doc_id, bag, size in bags:
            m, score = 100 - 75 + (75 * size * n) // total, 0
            for w in words(text):
                if w in bag:
                    df = sum(w in b[1] for b in bags)
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * ((1000000000 * bag[w]) // (1000 * bag[w] + 8 * m))
            if score > 0:
                ranked.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, k, d, -s) for k, (s, _, _, d) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


DOC_ROWS = [
    (1, "the quick brown fox"), (2, "THE lazy dog, the dog; the dog"), (3, None), (4, ""), (None, "quick quick quick fox"), (5, "fox fox"), (5, "fox fox"),
    (6, "the the the the fox"), (7, "né Né ÉÉ \x00 fox-trot"), (8, "w " * 30_000 + "fox"), (9, "!!"), (10, "fox fox"), (12, "x1 x2 x3"),
]
ITEM_ROWS = [(1, "quick fox fox"), (1, "quick fox fox"), (2, "the dog"), (2, "né"), (3, None), (4, " ,"), (None, "w fox"), (5, "absent"), (6, "fox absent the")]


def test_search_against_brute_force(spark):
    docs = spark.createDataFrame([(*d, "x", 1, 2) for d in DOC_ROWS], DOCS).repartition(3)
    items = spark.createDataFrame([(*i, 7) for i in ITEM_ROWS], ITEMS)
    assert rows_of(bitslices.search(docs, items)) == brute(DOC_ROWS, ITEM_ROWS)
    assert rows_of(bitslices.search(docs, items, top=2, items_bytes=6)) == brute(DOC_ROWS, ITEM_ROWS, 2)


def test_random_tables(spark):
    rng = random.Random(5)
    vocab = [f"t{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.choice([3, 30, 300])))) for i in range(300)]
    items = [(i, " ".join(rng.choices(vocab, k=12))) for i in range(25)]
    a = spark.createDataFrame([(*d, "", 0, 0) for d in docs], DOCS).repartition(4)
    b = spark.createDataFrame([(*i, 0) for i in items], ITEMS)
    assert rows_of(bitslices.search(a, b)) == brute(docs, items)


def test_bounds_are_never_below_scores():
    rng = random.Random(2)
    bags = [Counter(rng.choices(range(60), k=rng.choice([2, 20, 90]))) for _ in range(64)]
    docs = [Counter({f"w{k}".encode(): v for k, v in b.items()}) for b in bags]
    corpus = bitslices.Corpus(len(docs), sum(sum(d.values()) for d in docs))
    asked = [Counter(f"w{rng.randrange(70)}".encode() for _ in range(8)) for _ in range(20)]
    holding = Counter(w for d in docs for w in d)
    items = bitslices.Items(asked, holding, corpus)
    block = bitslices._block(256, [(i, sum(d.values()), bitslices._hashed(d), np.array(list(d.values()))) for i, d in enumerate(docs)])
    sizes = block.column("sizes")[0].values.to_numpy()
    bound = items.bounds(256, sizes, block.column("bits")[0].as_buffer())
    exact = np.array([[items.score(k, d, corpus.spread(sum(d.values()))) for d in docs] for k in range(len(asked))])
    assert (bound >= exact).all() and (exact > 0).any()
    # Wide signatures exclude documents without any of the terms.
    wide = bitslices._block(2**14, [(i, sum(d.values()), bitslices._hashed(d), np.array(list(d.values()))) for i, d in enumerate(docs)])
    assert ((items.bounds(2**14, sizes, wide.column("bits")[0].as_buffer()) > 0) >= (exact > 0)).all()
    assert (items.bounds(2**14, sizes, wide.column("bits")[0].as_buffer())[exact == 0] == 0).mean() > 0.9


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a", "", 0, 0)], DOCS), spark.createDataFrame([(1, "a", 0)], ITEMS)
    assert bitslices.search(docs, some[1]).count() == bitslices.search(some[0], items).count() == 0
    assert [tuple(r) for r in bitslices.search(*some).collect()] == [(1, 1, 1, math.floor(1000 * math.log(4 / 3)) * (10**9 // 1800))]


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert rows_of(queries.QUERIES["op12_ranked_search"](spark, SF)) == brute(docs, items)
