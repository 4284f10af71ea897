"""SimHash near-duplicates: tiled exact comparison by exclusive-or and bit counts.

A fingerprint has ``words`` words of 64 bits. Equal fingerprints are one class. Classes are dealt into *bands*
(population count, or shingle-count band); only tiles of bands within reach are compared, every pair in them,
in numpy blocks. A tile returns a forest of its links, not the pairs, so a group of copies costs no more rows
than it has members; the forests meet in distributed connected components.

Where a plan asks for a similarity, fingerprints only find candidates. Every pair that is similar is in one component
of candidates, so the shingle sets of such a component meet in tiles, and only pairs that reach the similarity link.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import mapped, row_id, settle
from cartlake.llm.components import components

SEED = 42
#: Fingerprints of a tile side: 32,768 rows of 64 bits are 256 KB, and a block of 256 rows against them 64 MB.
TILE = 32_768
BLOCK = 256
#: Up to so many shingles the bits that two sets differ in are counted exactly, ties included.
FEW = 64
#: Shingle sets, and shingles in them, of a side where sets are compared: 8 MB.
SETS = 512
SHINGLES = 1_000_000
#: What rows of one class have in common.
CLASS = ["fp", "band", "n", "own"]


@dataclass(frozen=True)
class Plan:
    """``shingle`` words a shingle; ``words`` of 64 bits; links at ``radius`` differing bits or fewer.

    ``distinct`` counts a repeated shingle once. ``size_ratio`` r: only texts whose numbers of shingles are within
    r of each other are compared, as a Jaccard similarity of 1 / r or more implies; without it bands are population
    counts. ``screen`` (words, bits): a pair is dropped when its first words differ in more bits. ``similarity``: what
    the radius finds are candidates, which link when the Jaccard similarity of their shingle sets is as much.
    ``few``: for sets of 0, 1, ... shingles a radius and a bound of the screen of their own.
    """

    shingle: int = 3
    words: int = 1
    radius: int = 3
    distinct: bool = False
    size_ratio: float | None = None
    screen: tuple[int, int] | None = None
    similarity: float | None = None
    few: tuple[tuple[int, int], ...] = ()


def _halves(n: int) -> np.ndarray:
    """Chances of 0 to n heads of n coins."""
    return np.array([math.comb(n, k) / 2**n for k in range(n + 1)])


def differing(n: int, m: int, both: int) -> float:
    """Chance that a bit of the fingerprints of ``n`` and ``m`` shingles, ``both`` of them common, differs.

    A bit is one where more than half of the shingles' bits are; ties are zeros, so that small even sets lean to 0.
    """

    def over(size: int) -> np.ndarray:
        tail = np.append(np.cumsum(_halves(size - both)[::-1])[::-1], 0.0)
        return tail[np.clip(size // 2 - np.arange(both + 1) + 1, 0, size - both + 1)]

    a, b = over(n), over(m)
    return float((_halves(both) * (a * (1 - b) + b * (1 - a))).sum())


@lru_cache
def _most_differing(similarity: float) -> tuple[float, ...]:
    """For 0 to FEW shingles: the largest chance of a differing bit over all sets that are similar enough."""
    out = [0.0]
    for n in range(1, FEW + 1):
        sizes = range(math.floor(similarity * n), math.ceil(n / similarity) + 1)
        met = [(m, c) for m in sizes for c in range(1, min(n, m) + 1) if c / (n + m - c) >= similarity]
        out.append(max(differing(n, m, c) for m, c in met))
    return tuple(out)


def similar(similarity: float = 0.8, shingle: int = 5, words: int = 8, sigmas: float = 5) -> Plan:
    """The plan that links texts whose shingle sets have a Jaccard similarity of ``similarity`` or more.

    The share of differing bits estimates the angle between two shingle sets, and their cosine is at least
    2s / (1 + s); few shingles differ in more bits, by their number. The radius, for candidates, and the bound of the
    screen are that share and ``sigmas`` standard deviations of it more.
    """

    def most(p: float, bits: int) -> int:
        return int(bits * p + sigmas * math.sqrt(bits * p * (1 - p)))

    odds = _most_differing(similarity)
    p = max(math.acos(2 * similarity / (1 + similarity)) / math.pi, *odds[FEW // 2 :])
    few = tuple((most(x, 64 * words), most(x, 128)) for x in odds)
    return Plan(shingle, words, most(p, 64 * words), True, 1 / similarity, (2, most(p, 128)) if words > 2 else None, similarity, few)


def _spread(h: np.ndarray, words: int) -> np.ndarray:
    """(n, words) of 64 bits from n hashes: the hash itself, then mixes of it."""
    out = np.empty((len(h), words), np.uint64)
    out[:, 0] = h
    for k in range(1, words):
        x = h + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, k] = x ^ (x >> np.uint64(31))
    return out


def shingles(text: str | None, plan: Plan) -> np.ndarray:
    """Hashes of the shingles; of a plan with distinct ones in order. Fewer words than a shingle's are one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    size = min(plan.shingle, len(words))
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())), np.uint64, len(starts))
    return np.unique(h) if plan.distinct else h


def set_key(h: np.ndarray) -> bytes:
    """Names a shingle set."""
    return xxhash.xxh3_128_digest(h.tobytes())


def fingerprint(h: np.ndarray, plan: Plan) -> bytes:
    """Little-endian fingerprint of shingles; zero where there are none."""
    counts = np.zeros(64 * plan.words, np.int64)
    for at in range(0, len(h), 2048):  # bounded memory for very long texts
        bits = np.unpackbits(_spread(h[at : at + 2048], plan.words).view(np.uint8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(h), bitorder="little").tobytes()


def fingerprints(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, text_key, fp binary, band int, n int, own binary)``, a row for each row.

    ``text_key``: tells the texts of a doc_id apart. ``n``: shingles, where the plan compares or bounds by their number,
    else 0. ``own``: names the shingle set where sets are compared, else empty. A null text is an empty one.
    """

    counted = bool(plan.few or plan.similarity)

    def run(batch: pa.RecordBatch) -> dict:
        fps, sizes, own = [], [], []
        for text in batch.column("text").to_pylist():
            h = shingles(text, plan)
            fps.append(fingerprint(h, plan)), sizes.append(len(h)), own.append(set_key(h) if plan.similarity else b"")
        if plan.size_ratio:
            band = [int(math.log(n) / math.log(plan.size_ratio)) if n else -2 for n in sizes]
        else:
            band = [int.from_bytes(f, "little").bit_count() for f in fps]
        return {"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "fp": pa.array(fps, pa.binary()), "band": pa.array(band, pa.int32()), "n": pa.array(sizes if counted else [0] * len(sizes), pa.int32()), "own": pa.array(own, pa.binary())}

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return mapped(keyed, run, "doc_id bigint, text_key bigint, fp binary, band int, n int, own binary")


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return up
        parent = up


def _unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    while True:
        a, b = parent[i], parent[j]
        open_ = a != b
        if not open_.any():
            return parent
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        parent = _roots(parent)


def forest(node: np.ndarray, fps: np.ndarray, left: np.ndarray, right: np.ndarray, plan: Plan, size: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links of one tile as (node, smaller node of its tree). ``left`` / ``right`` say which side rows are on.

    Both sides are walked in the order of the population count of the first word, and rows of a block meet only
    the rows whose count is within the bits that the first word may differ by. ``size``: shingles of the rows, where
    the plan has bounds for few.
    """
    order = np.argsort(node, kind="stable")
    node, fps, left, right = node[order], fps[order], left[order], right[order]
    count = np.bitwise_count(fps[:, 0]).astype(np.int64)
    screened, most = plan.screen or (plan.words, plan.radius)
    radii, bounds = np.full(len(node), plan.radius), np.full(len(node), most)
    if plan.few:
        few = np.flatnonzero(size[order] < len(plan.few))
        own = np.array(plan.few)[size[order][few]]
        radii[few], bounds[few] = own[:, 0], own[:, 1] if plan.screen else own[:, 0]
    reach = min(int(bounds.max(initial=0)), 64)
    a, b = np.flatnonzero(left), np.flatnonzero(right)
    a, b = a[np.argsort(count[a], kind="stable")], b[np.argsort(count[b], kind="stable")]
    cols, counted, parent = [np.ascontiguousarray(fps[b, k]) for k in range(plan.words)], count[b], np.arange(len(node))
    for at in range(0, len(a), BLOCK):
        rows = a[at : at + BLOCK]
        lo = np.searchsorted(counted, count[rows[0]] - reach)
        hi = np.searchsorted(counted, count[rows[-1]] + reach, "right")
        if lo == hi:
            continue
        differ = np.bitwise_count(fps[rows, 0][:, None] ^ cols[0][None, lo:hi])
        for k in range(1, screened):
            differ = differ.astype(np.uint16) + np.bitwise_count(fps[rows, k][:, None] ^ cols[k][None, lo:hi])
        x, y = np.nonzero(differ <= bounds[rows][:, None])
        x, y = rows[x], b[lo:hi][y]
        if screened < plan.words:
            near = np.bitwise_count(fps[x] ^ fps[y]).sum(axis=1, dtype=np.int64) <= radii[x]
            x, y = x[near], y[near]
        parent = _unite(parent, x, y)
    moved = np.flatnonzero(parent != np.arange(len(node)))
    return node[moved], node[parent[moved]]


def _tiles(classes: DataFrame, reach: int) -> DataFrame:
    """Each class once for every tile it belongs to: its own block, and the blocks of bands within reach."""
    sizes = {r.band: r.n for r in classes.groupBy("band").agg(F.count("*").alias("n")).collect()}  # a few hundred bands
    if not sizes:
        return classes.where("false").select("node", "fp", "n", F.lit("").alias("tile"), F.lit(0).alias("side"))
    blocks = {b: -(-n // TILE) for b, n in sizes.items()}
    n_of = F.create_map(*[F.lit(x) for item in blocks.items() for x in item])
    own = classes.withColumn("block", F.pmod(F.xxhash64("fp"), n_of[F.col("band")]).cast("int"))
    other = F.explode(F.sequence(F.col("band") - reach, F.col("band") + reach))
    met = own.withColumn("with", other).where(F.col("with").isin(list(blocks)))
    met = met.withColumn("at", F.explode(F.sequence(F.lit(0), n_of[F.col("with")] - 1)))
    me, you = F.struct("band", "block"), F.struct(F.col("with").alias("band"), F.col("at").alias("block"))
    tile = F.concat_ws("/", F.least(me, you)["band"], F.least(me, you)["block"], F.greatest(me, you)["band"], F.greatest(me, you)["block"])
    side = F.when(me == you, 0).when(me < you, 1).otherwise(2)
    return met.select("node", "fp", "n", tile.alias("tile"), side.alias("side"))


def linked(classes: DataFrame, plan: Plan) -> DataFrame:
    """``classes(node, fp, band)`` with its nodes to links ``(a, b)`` that have the same components as all pairs.

    A plan with bounds for few shingles needs their number as ``n``.
    """
    classes = classes if plan.few else classes.withColumn("n", F.lit(0))

    def run(group: pa.Table) -> pa.Table:
        node, side = group.column("node").to_numpy(), group.column("side").to_numpy()
        fps = np.frombuffer(b"".join(group.column("fp").to_pylist()), np.uint64).reshape(-1, plan.words)
        a, b = forest(node, fps, side != 2, side != 1, plan, group.column("n").to_numpy())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    tiles = _tiles(classes, 1 if plan.size_ratio else plan.radius)
    return tiles.groupBy("tile").applyInArrow(run, "a bigint, b bigint")


def alike(node: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of one tile of shingle sets as (node, smaller node of its tree): Jaccard ``similarity`` or more.

    Rows go by size, so what may be similar to a row is a run of rows, whose shingles are looked up at once. Rows that
    are in the row's tree already are linked, and not compared when nothing else is in the run.
    """
    size = np.array([len(h) for h in sets], np.int64)
    order = np.lexsort((node, size))
    order = order[size[order] > 0]
    node, size, left, right = node[order], size[order], left[order], right[order]
    if not len(node):
        return node, node
    words, place = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(size)))
    seen, parent = np.zeros(len(words), bool), np.arange(len(node))
    for i in np.flatnonzero(left):
        lo, hi = np.searchsorted(size, similarity * size[i] - 1), np.searchsorted(size, size[i] / similarity + 1, "right")
        open_ = right[lo:hi] & (parent[lo:hi] != parent[i])
        if not open_.any():
            continue
        mine = place[starts[i] : starts[i + 1]]
        seen[mine] = True
        both = np.add.reduceat(seen[place[starts[lo] : starts[hi]]], starts[lo:hi] - starts[lo], dtype=np.int64)
        seen[mine] = False
        y = lo + np.flatnonzero(open_ & (both / (size[i] + size[lo:hi] - both) >= similarity))
        parent = _unite(parent, np.full(len(y), i), y)
    # The smallest node of a tree stands for it.
    least = np.full(len(node), np.iinfo(np.int64).max)
    np.minimum.at(least, parent, node)
    moved = least[parent] != node
    return node[moved], least[parent][moved]


def similar_links(docs: DataFrame, classes: DataFrame, plan: Plan) -> DataFrame:
    """Links ``(a, b)`` of ``classes`` with the same components as all pairs of classes with similar shingle sets.

    The sets are made again from the texts of those classes only that have a candidate.
    """
    met = components(linked(classes, plan)).withColumnRenamed("component", "part")
    met = settle(met.join(classes.select("node", "n", "own", F.col("first.doc_id").alias("doc_id")), "node"), "simhash-met")
    blocks = F.ceil(F.greatest(F.count("*") / SETS, F.sum("n") / SHINGLES)).cast("int")
    parts = settle(met.groupBy("part").agg(blocks.alias("blocks")), "simhash-parts")
    asked = settle(met.join(parts, "part"), "simhash-asked")

    def made(batch: pa.RecordBatch) -> dict:
        sets = [shingles(t, plan) for t in batch.column("text").to_pylist()]
        # Another text of the same doc_id is another class.
        same = pa.array([set_key(h) == own for h, own in zip(sets, batch.column("own").to_pylist())], pa.bool_())
        held = pa.array([h.tobytes() for h in sets], pa.binary())
        return {k: batch.column(k).filter(same) for k in ("node", "part", "blocks")} | {"held": held.filter(same)}

    texts = docs.select("doc_id", "text").join(asked, "doc_id").select("node", "part", "blocks", "own", "text")
    sets = mapped(texts, made, "node bigint, part bigint, blocks int, held binary")
    sets = settle(sets.groupBy("node", "part", "blocks").agg(F.any_value("held").alias("held")), "simhash-sets")
    put = sets.withColumn("at", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    put = put.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("at") == F.col("with"), 0).when(F.col("at") < F.col("with"), 1).otherwise(2)
    tiles = put.select("node", "held", "part", F.least("at", "with").alias("lo"), F.greatest("at", "with").alias("hi"), side.alias("side"))

    def run(group: pa.Table) -> pa.Table:
        node, side = group.column("node").to_numpy(), group.column("side").to_numpy()
        held = [np.frombuffer(x, np.uint64) for x in group.column("held").to_pylist()]
        a, b = alike(node, held, side != 2, side != 1, plan.similarity)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return tiles.groupBy("part", "lo", "hi").applyInArrow(run, "a bigint, b bigint")


def _homes(docs: DataFrame, fps: DataFrame, plan: Plan) -> DataFrame:
    """``(node, component, first, fp, band, n, own)`` per class of ``fps``: ``first`` is its smallest (doc_id, text_key)."""
    each = fps.where("doc_id is not null").groupBy(*CLASS).agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    # Numbers of their own: several classes can have a doc_id. They are fixed by being written.
    classes = settle(each.withColumn("node", row_id()), "simhash-class")
    links = similar_links(docs, classes, plan) if plan.similarity else linked(classes, plan)
    found = classes.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    return settle(found.select("node", "component", "first", *CLASS), "simhash-home")


def groups(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, fp, component_id)``, a row for each row.

    Null and empty texts have the fingerprint zero and are linked like any other. Rows with the same doc_id are
    kept apart; each is linked by its own text. A row with a null doc_id has a fingerprint but no links, and a
    null component. An empty table gives an empty table; other columns are ignored.
    """
    fps = settle(fingerprints(docs, plan), "simhash")
    homes = _homes(docs, fps, plan)
    least = settle(homes.groupBy("component").agg(F.min("first.doc_id").alias("component_id")), "simhash-least")
    named = settle(homes.join(least, "component").select(*CLASS, "component_id"), "simhash-named")
    out = fps.where("doc_id is not null").join(named, CLASS).select("doc_id", "fp", "component_id")
    return out.union(fps.where("doc_id is null").select("doc_id", "fp", F.lit(None).cast("bigint").alias("component_id")))


def hex_digits(fp: Column | str) -> Column:
    """A 64-bit fingerprint as 16 hexadecimal digits, highest first."""
    return F.lower(F.concat(*[F.substring(F.hex(fp), 2 * k + 1, 2) for k in reversed(range(8))]))


def deduplicate(docs: DataFrame, plan: Plan | None = None) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, that with the smallest doc_id.

    Rows with the same doc_id and different texts are documents of their own; of such in one group one stays.

    Default: sets of five-word shingles, Jaccard similarity 0.8 or more, by the sets themselves. Rows that repeat a doc_id and its text are one document; rows
    with a null doc_id stay as they are. All columns are kept.
    """
    plan = plan or similar()
    homes = _homes(docs, settle(fingerprints(docs, plan), "simhash"), plan)
    first = homes.groupBy("component").agg(F.min("first").alias("first")).select("first.doc_id", "first.text_key")
    named = docs.where("doc_id is not null")
    # Joined by doc_id alone, so that one shuffle of the texts serves the dropping of repeats too.
    same = (named["doc_id"] == first["doc_id"]) & (F.xxhash64(named["text"]).bitwiseXOR(first["text_key"]) == 0)
    kept = named.join(first, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))
