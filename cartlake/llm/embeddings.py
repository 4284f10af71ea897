"""Embedding near-duplicates: random-hyperplane signs in several tables, exact cosine, connected components.

Equal vectors of a label are one class. A class falls into one bucket per table, by the signs of its products with
random hyperplanes; buckets of one class are dropped before any vector is shuffled. Large buckets are cut into
blocks, and pairs of blocks are tiles of bounded size. In a tile all pairs are compared in numpy; a pair counts in the
first table that holds it, so that links are counted once, and what a tile returns is counts and a forest of its
links, not pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import mapped, row_id, settle
from cartlake.llm.components import components
from cartlake.llm.simhash import _unite

BITS = 12
#: Classes of a block; a tile compares two blocks.
BLOCK = 2_048
SEED = 20_240_229


def tables_for(cosine: float, bits: int = BITS, miss: float = 1e-5) -> int:
    """Tables after which a pair of exactly this cosine is in no common bucket with a chance of ``miss``."""
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return math.ceil(math.log(miss) / math.log(1 - same))


def planes(dimensions: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimensions]).normal(size=(dimensions, tables * bits))


def unit(vector: list | None) -> np.ndarray | None:
    """The vector at length one in double precision; None for one that links with nothing."""
    if not vector or any(x is None for x in vector):
        return None
    v = np.asarray(vector, np.float64)
    if not np.isfinite(v).all() or not v.any():
        return None
    v = v / np.abs(v).max()
    return v / math.sqrt(float(v @ v))


def _signed(vectors: DataFrame, tables: int, bits: int) -> DataFrame:
    """``(vec_id, class binary, unit binary, signs array<int>)``; the class is null for what links with nothing."""
    powers = 1 << np.arange(bits)

    def run(batch: pa.RecordBatch) -> dict:
        keys, units, signs, cache = [], [], [], {}
        for vector, label in zip(batch.column("embedding").to_pylist(), batch.column("label").to_pylist()):
            v = unit(vector) if label is not None else None
            if v is None:
                keys.append(None), units.append(None), signs.append(None)
                continue
            if len(v) not in cache:
                cache[len(v)] = planes(len(v), tables, bits)
            # Equal vectors give equal bytes: adding 0 makes one zero of both.
            raw = (np.asarray(vector, np.float64) + 0.0).tobytes()
            keys.append(hashlib.sha256(str(label).encode() + b"/" + raw).digest()[:16])
            units.append(v.tobytes())
            signs.append((((v @ cache[len(v)]) >= 0).reshape(tables, bits) @ powers).astype(np.int32))
        return {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "class": pa.array(keys, pa.binary()), "unit": pa.array(units, pa.binary()), "signs": pa.array(signs, pa.list_(pa.int32()))}

    return mapped(vectors.select("vec_id", "embedding", "label"), run, "vec_id bigint, label int, class binary, unit binary, signs array<int>")


def _compare(rows: list[dict], cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A tile: ids of classes with links, rows they are linked to here, and the forest (node, smaller node)."""
    rows.sort(key=lambda r: r["node"])
    node = np.array([r["node"] for r in rows])
    size = np.array([r["size"] for r in rows])
    side = np.array([r["side"] for r in rows])
    table = rows[0]["table"]
    units = np.frombuffer(b"".join(r["unit"] for r in rows)).reshape(len(rows), -1)
    signs = np.array([r["signs"][:table] for r in rows], np.int32).reshape(len(rows), table)
    a, b = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
    count, parent = np.zeros(len(rows), np.int64), np.arange(len(rows))
    for at in range(0, len(a), 512):
        part = a[at : at + 512]
        x, y = np.nonzero(units[part] @ units[b].T >= cosine - 1e-9)
        x, y = part[x], b[y]
        ok = (x < y) if side[0] == 0 else (x != y)
        x, y = x[ok], y[ok]
        exact = np.einsum("ij,ij->i", units[x], units[y]) >= cosine
        x, y = x[exact], y[exact]
        if table:
            first = ~(signs[x] == signs[y]).any(axis=1)
            x, y = x[first], y[first]
        np.add.at(count, x, size[y])
        np.add.at(count, y, size[x])
        parent = _unite(parent, x, y)
    linked = np.flatnonzero(count)
    return node[linked], count[linked], node[parent[linked]]


def _tiles(classes: DataFrame) -> DataFrame:
    """``(tile, table, node, side)`` for every tile of every bucket with two classes or more."""
    put = classes.select("node", "label", "dims", F.posexplode("signs").alias("table", "bucket"))
    sizes = settle(put.groupBy("table", "bucket", "label", "dims").agg(F.count("*").alias("n")).where("n > 1"), "embed-buckets")
    met = put.join(sizes, ["table", "bucket", "label", "dims"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    met = met.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = F.xxhash64("table", "bucket", "label", "dims", F.least("own", "with"), F.greatest("own", "with"))
    side = F.when(F.col("own") == F.col("with"), 0).when(F.col("own") < F.col("with"), 1).otherwise(2)
    return met.select("node", "label", key.alias("tile"), "table", side.alias("side"))


def links(vectors: DataFrame, cosine: float = 0.98, bits: int = BITS, miss: float = 1e-5) -> DataFrame:
    """``vectors(vec_id, embedding, label)`` to ``(vec_id, n_links, component_id, kept)``, a row for each row.

    Two rows are linked when their labels are equal and not null and the cosine of their vectors, in double precision,
    is ``cosine`` or more; both have to be found by the tables (see ``tables_for``). ``n_links``: other rows linked
    directly. ``component_id``: the smallest vec_id that links lead to. ``kept``: vec_id = component_id.
    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of
    different lengths. Rows with a null vec_id link with nothing and have a null component. Rows that repeat a vec_id
    are rows of their own. An empty table gives an empty table; other columns are ignored.
    """
    tables = tables_for(cosine, bits, miss)
    signed = settle(_signed(vectors, tables, bits), "embed-signs")
    usable = signed.where("class is not null and vec_id is not null")
    # One row of a class carries the vector; which one does not matter.
    each = usable.groupBy("class").agg(F.min("vec_id").alias("first"), F.count("*").alias("size"), F.any_value("label").alias("label"), F.any_value("unit").alias("unit"), F.any_value("signs").alias("signs"))
    # Numbers of their own: several classes can have a vec_id. They are fixed by being written.
    classes = settle(each.withColumn("dims", F.octet_length("unit")).withColumn("node", row_id()), "embed-classes")
    tiles = settle(_tiles(classes), "embed-tiles")
    full = tiles.join(classes.select("node", "label", "dims", "size", "unit", "signs"), ["node", "label"])
    full = full.repartition("tile").sortWithinPartitions("tile", "table", "label", "dims")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> pa.RecordBatch:
            if len(rows) < 2:
                return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, names=["node", "n", "root"])
            node, n, root = _compare(rows, cosine)
            return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(root, pa.int64())], names=["node", "n", "root"])

        rows, at = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if (key := (row["tile"], row["table"], row["label"], row["dims"])) != at:
                    yield close()
                    rows, at = [], key
                rows.append(row)
        yield close()

    found = settle(full.mapInArrow(run, "node bigint, n bigint, root bigint"), "embed-links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    homes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.select("class", "first", "node", "size").join(counts, "node", "left").join(homes, "node", "left")
    known = settle(known.select("class", "first", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component")), "embed-homes")
    least = settle(known.groupBy("component").agg(F.min("first").alias("component_id")), "embed-least")
    known = settle(known.join(least, "component").select("class", "n_links", "component_id"), "embed-named")
    out = usable.select("vec_id", "class").join(known, "class").select("vec_id", "n_links", "component_id")
    rest = signed.where("class is null or vec_id is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
