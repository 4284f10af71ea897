from __future__ import annotations

import random

import numpy as np
import xxhash

from cartlake.llm import queries, simhash
from cartlake.llm.common import table

SF = "/root/testdata/sf0.001"

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute_fp(text, shingle=3):
    words = (text or "").encode().lower().split()
    n = [0] * 64
    parts = [b" ".join(words[k : k + shingle]) for k in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    for p in parts:
        h = xxhash.xxh64_intdigest(p, 42)
        for b in range(64):
            n[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * n[b] > len(parts))


def brute_components(ids, fps, radius=3):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def check(spark, rows):
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: (int(r.f, 16), r.component_id) for r in simhash.groups(df).select("doc_id", simhash.hex_digits("fp").alias("f"), "component_id").collect()}
    fps = {r[0]: brute_fp(r[1]) for r in rows}
    want = brute_components(sorted(fps), fps)
    assert got == {i: (fps[i], want[i]) for i in fps}


def test_query_against_brute_force(spark):
    rows = table(spark, SF, "documents").collect()
    fps = {r.doc_id: brute_fp(r.text) for r in rows}
    want = brute_components(sorted(fps), fps)
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in queries.QUERIES["op5_simhash_near_dedup"](spark, SF).collect()}
    assert got == {i: (fps[i], want[i]) for i in fps}


def test_edge_texts(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, " \t\n", "en", "s", 3), (4, "One two", "en", "s", 7), (5, "oNE  TWO", "en", "s", 8)]
    rows += [(6, "É é x y z", "fr", "s", 1), (7, "word " * 30000, "en", "s", 1), (8, "word " * 29000, "en", "s", 1)]
    check(spark, rows)


def test_one_row_per_row_of_texts_with_one_fingerprint(spark):
    # The same shingle more or less often: one fingerprint, several numbers of shingles.
    rows = [(k, "word " * (3 + k % 5), "en", "s", 1) for k in range(10)] + [(20, "a b a b a b", "en", "s", 1), (21, "b a b a " * 2, "en", "s", 1)]
    fps = {r[0]: brute_fp(r[1]) for r in rows}
    want = brute_components(sorted(fps), fps)
    found = simhash.groups(spark.createDataFrame(rows, DOCS)).select("doc_id", simhash.hex_digits("fp").alias("f"), "component_id")
    assert sorted((r.doc_id, int(r.f, 16), r.component_id) for r in found.collect()) == [(i, fps[i], want[i]) for i in sorted(fps)]
    assert found.where("doc_id < 10").select("f").distinct().count() == 1


def test_empty_table_repeats_and_null_ids(spark):
    assert simhash.groups(spark.createDataFrame([], DOCS)).count() == 0
    assert simhash.deduplicate(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "a b c", "en", "s", 1), (3, "a b c", "en", "s", 1), (3, "a b c", "en", "s", 1), (9, "a b c", "en", "s", 1)]
    got = sorted(((r.doc_id or -1), r.component_id or -1) for r in simhash.groups(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(-1, -1), (3, 3), (3, 3), (9, 3)]
    assert sorted(r.doc_id or -1 for r in simhash.deduplicate(spark.createDataFrame(rows, DOCS)).collect()) == [-1, 3]


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 5, b"x", 1), (2, "a b", 6, b"y", 2)], "doc_id bigint, text string, component_id int, fp binary, tile int")
    assert [r.doc_id for r in simhash.deduplicate(df).collect()] == [1]
    assert simhash.deduplicate(df).columns == df.columns


def test_chains_over_many_tiles(spark, monkeypatch):
    random.seed(5)
    monkeypatch.setattr(simhash, "TILE", 16)
    fps, at = [], random.getrandbits(64)
    for _ in range(150):
        at ^= 1 << random.randrange(64)
        fps += [at, random.getrandbits(64)]
    fps = sorted(set(fps))
    rows = [(i, f.to_bytes(8, "little"), f.bit_count()) for i, f in enumerate(fps)]
    classes = spark.createDataFrame(rows, "node bigint, fp binary, band int")
    got = {i: i for i in range(len(fps))}
    got.update({r.node: r.component for r in simhash.components(simhash.linked(classes, simhash.Plan())).collect()})
    assert got == brute_components(range(len(fps)), dict(enumerate(fps)))


def jaccard(a, b):
    a, b = ({tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in (a, b))
    return len(a & b) / len(a | b)


def test_similarity_plan(spark):
    rng, rows = np.random.default_rng(3), []
    for k in range(60):
        words = [f"w{x}" for x in rng.integers(0, 4000, int(rng.integers(60, 600)))]
        edited = list(words)
        for at in rng.choice(len(words), max(1, len(words) // 60), replace=False):
            edited[at] = "changed"
        assert jaccard(" ".join(words), " ".join(edited)) > 0.8
        rows += [(2 * k, " ".join(words), "en", "s", 1), (2 * k + 1, " ".join(edited), "en", "s", 1)]
    kept = sorted(r.doc_id for r in simhash.deduplicate(spark.createDataFrame(rows, DOCS)).collect())
    assert kept == list(range(0, 120, 2))


def five_word_sets(rows):
    words = {i: t.split() for i, t in rows}
    return {i: {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}


def groups_of_sets(rows, similarity=0.8):
    """Smallest id per id, by all pairs of shingle sets."""
    sets, parent = five_word_sets(rows), {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= similarity:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in parent}


def by_sets(spark, rows):
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    assert {r.doc_id: r.component_id for r in simhash.groups(df, simhash.similar()).collect()} == (want := groups_of_sets(rows))
    assert sorted(r.doc_id for r in simhash.deduplicate(df).collect()) == sorted(set(want.values()))
    return want


def test_every_link_reaches_the_similarity(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SETS", 8, raising=False)
    rng, rows = np.random.default_rng(8), []
    for k in range(40):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 10 if k % 2 else int(rng.integers(100, 400)))]
        rows += [(3 * k, " ".join(words)), (3 * k + 1, " ".join(["other"] + words[1:]) if k % 2 else " ".join(words[: -(len(words) // 4)]))]
        rows += [(3 * k + 2, " ".join(words[:-1]))] if not k % 2 else []
    # Pages of one template: any two are near each other, and not as near as 0.8.
    frame = [f"t{x}" for x in range(400)]
    for k in range(40):
        rows.append((1000 + k, " ".join(frame + [f"p{k}x{x}" for x in range(60)])))
    want = by_sets(spark, rows)
    assert len(set(want.values())) == 40 + 40 + 40


def test_short_texts_against_all_pairs(spark):
    rng, rows = np.random.default_rng(4), []
    for k in range(400):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 8 if k < 200 else int(rng.integers(5, 26)))]
        other = words + ["more"] if k < 200 else words[: len(words) - int(rng.integers(0, 3))]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    by_sets(spark, rows)


def test_differing_bits_of_few_shingles():
    assert simhash.differing(4, 5, 4) == 0.1875 and simhash.differing(3, 3, 3) == 0
    rng = np.random.default_rng(6)
    for n, m, both in ((4, 5, 4), (8, 8, 7), (13, 14, 12), (30, 33, 28)):
        words = rng.integers(0, 2**63, n + m - both).astype(np.uint64)
        plan = simhash.Plan(5, 256, distinct=True)
        a, b = (np.frombuffer(simhash.fingerprint(h, plan), np.uint64) for h in (words[:n], words[-m:]))
        assert abs(np.bitwise_count(a ^ b).sum() / 2**14 - simhash.differing(n, m, both)) < 0.015
    plan = simhash.similar()
    assert plan.few[4] == (140, 46) and plan.few[3] == (0, 0) and all(r <= plan.radius for r, _ in plan.few[simhash.FEW // 2 :])


def test_a_doc_id_with_several_texts(spark):
    base, unique = [f"w{x}" for x in range(60)], " ".join(f"u{x}" for x in range(60))
    near, copy = " ".join(base[:-1] + ["other"]), " ".join(base)
    rows = [(3, copy), (5, near), (5, unique), (7, copy), (7, unique + " a b"), (8, near), (8, near), (2, "x y"), (2, "X  Y")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    got = sorted((r.doc_id, r.component_id) for r in simhash.groups(df, simhash.similar()).collect())
    assert got == [(2, 2), (2, 2), (3, 3), (5, 3), (5, 5), (7, 3), (7, 5), (8, 3), (8, 3)]
    kept = sorted((r.doc_id, r.text.lower().split()) for r in simhash.deduplicate(df).collect())
    assert kept == [(2, ["x", "y"]), (3, copy.split()), (5, unique.split())]
