from __future__ import annotations

import sys
from pathlib import Path

import numpy as np

from cartlake.llm import embeddings, queries
from cartlake.llm.common import table

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
SF = "/root/testdata/sf0.01"
VECTORS = "vec_id bigint, embedding array<float>, label int, node int, component string"


def brute(rows, cosine=0.98):
    units = [embeddings.unit(e) if label is not None and i is not None else None for i, e, label in rows]
    near = [[j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= cosine] for i in range(len(rows))]
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = None if vec_id is None else min(rows[j][0] for j in seen)
        out.append((vec_id, len(near[i]), least, vec_id == least))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def test_query_against_brute_force_and_sql(spark):
    from tools.check import canonical, oracle_rows

    df = queries.QUERIES["op1_embedding_near_dedup"](spark, SF)
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, SF, "embeddings").collect()]
    assert got(df) == brute(rows)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(*oracle_rows(SF, queries.ORACLES["op1_embedding_near_dedup"]))


def near(rng, base, angle):
    off = rng.normal(size=len(base))
    off -= off @ base * base
    return np.cos(angle) * base + np.sin(angle) * off / np.linalg.norm(off)


def test_groups_chains_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    rng, rows = np.random.default_rng(4), []
    for k in range(4):
        base = rng.normal(size=16)
        base /= np.linalg.norm(base)
        rows += [(near(rng, base, a) * 10.0 ** rng.integers(-3, 4)).tolist() for a in rng.uniform(0.02, 0.17, 30)]
        rows += [base.tolist()] * 25
        for _ in range(6):  # a chain
            base = near(rng, base, 0.19)
            rows.append(base.tolist())
    nan, inf = float("nan"), float("inf")
    rows += [None, [], [0.0] * 16, [nan] * 16, [inf] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 8, [2.0] * 8, [1e30] * 16, [1e-30] * 16, [-0.0] + [1.0] * 15, [0.0] + [1.0] * 15]
    data = [(int(i), [None if x is None else float(np.float32(x)) for x in e] if e is not None else None, int(i) % 7 and 1) for i, e in enumerate(rows)]
    data += [(5, data[5][1], 1), (None, data[5][1], 1), (900, data[5][1], None), (901, data[5][1], 2)]
    df = spark.createDataFrame([(*r, 1, "x") for r in data], VECTORS)
    assert got(embeddings.links(df)) == brute(data)


def test_empty_table(spark):
    assert embeddings.links(spark.createDataFrame([], VECTORS)).count() == 0


def test_tables_reach_the_recall():
    rng, bits, found = np.random.default_rng(9), embeddings.BITS, 0
    tables = embeddings.tables_for(0.98)
    p = embeddings.planes(64, tables, bits)
    for _ in range(300):
        base = rng.normal(size=64)
        base /= np.linalg.norm(base)
        other = near(rng, base, np.arccos(0.98))
        found += ((base @ p >= 0) == (other @ p >= 0)).reshape(tables, bits).all(axis=1).any()
    assert found == 300


def test_a_vec_id_with_several_vectors(spark):
    rng = np.random.default_rng(12)
    a, b, c = ([float(x) for x in rng.normal(size=16)] for _ in range(3))
    near_a = near(rng, np.array(a), 0.02)
    rows = [(3, a, 1), (5, [float(x) for x in near_a], 1), (5, b, 1), (9, b, 1), (5, c, 1), (3, c, 1)]
    rows = [(i, np.float32(v).tolist(), label) for i, v, label in rows]
    df = spark.createDataFrame([(i, v, label, 0, "x") for i, v, label in rows], VECTORS)
    assert got(embeddings.links(df)) == brute(rows)
