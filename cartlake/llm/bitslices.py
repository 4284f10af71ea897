"""Ranked lexical search over bit-sliced Bloom signatures.

A document's signature holds its terms, and a term that occurs 2^l times or more once again under level l.
Documents of about the same number of keys form a block, which is stored by bit position: one bitmap over the
block's documents for each position. The bitmaps of a term's positions, and-ed, overestimate the documents that
have it so often; the weights of an item's terms, summed over those slices and times the most that a frequency of
that level can count, bound an item's score in every document from above.

The best bounds of each item name the documents that are scored first. Their scores give the item's bar, every
document whose bound reaches the bar is scored exactly, and nothing else can be among the best.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartlake.llm.common import mapped, settle
from cartlake.llm.decontaminate import normal
from cartlake.session import shared_dir

TOP = 10
#: Bitmaps a key, and bits of a signature for each key: one absent key in 400 seems present.
HASHES, BITS = 4, 16
#: Bits of a block (512 KB) and its most documents.
CELLS, ROWS = 2**22, 1024
#: Items are searched in groups of so many bytes of text; a group's terms are what is broadcast.
ITEMS_BYTES = 4 * 2**20

BLOCK = "width int, ids array<bigint>, sizes array<bigint>, bits binary"


def terms(text: str | None) -> list[bytes]:
    """Runs of digits, letters a-z (A-Z folded) and characters beyond ASCII."""
    return normal(text).split()


def _places(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """(keys, HASHES) bit positions of terms at a level."""
    x = hashes + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    step = (x >> np.uint64(32)) | np.uint64(1)
    return ((x & np.uint64(0xFFFFFFFF))[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(width - 1)


def _hashed(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _block(width: int, docs: list[tuple]) -> pa.RecordBatch:
    """The documents ``(id, number of terms, term hashes, frequencies)`` as one row."""
    columns = -(-len(docs) // 8) * 8
    owner = np.repeat(np.arange(len(docs)), [len(d[2]) for d in docs])
    hashes, counts = np.concatenate([d[2] for d in docs]), np.concatenate([d[3] for d in docs])
    cells = np.zeros(width * columns, bool)
    level = 0
    while (often := counts >= 2**level).any():
        places = _places(hashes[often], level, width).astype(np.int64)
        cells[places * columns + owner[often][:, None]] = True
        level += 1
    bits = np.packbits(cells.reshape(width, columns), axis=1, bitorder="little").tobytes()
    ids, sizes = ([[d[k] for d in docs]] for k in (0, 1))
    made = {"width": pa.array([width], pa.int32()), "ids": pa.array(ids, pa.list_(pa.int64())), "sizes": pa.array(sizes, pa.list_(pa.int64())), "bits": pa.array([bits], pa.binary())}
    return pa.RecordBatch.from_pydict(made)


def index(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` as blocks ``(width, ids, sizes, bits)``, written to the shared folder.

    Every row with a term is in one block; null and termless texts are in none. Null and repeated doc_ids are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[int, list[tuple]] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = terms(text.as_py())
                if not words:
                    continue
                counted = Counter(words)
                counts = np.fromiter(counted.values(), np.int64, len(counted))
                keys = len(counts) + int(np.log2(counts).astype(np.int64).sum())
                width = max(256, 1 << (BITS * keys - 1).bit_length())
                rows = open_blocks.setdefault(width, [])
                rows.append((doc_id, len(words), _hashed(counted), counts))
                if len(rows) >= max(8, min(ROWS, CELLS // width)):
                    yield _block(width, open_blocks.pop(width))
        for width, rows in open_blocks.items():
            yield _block(width, rows)

    path = shared_dir(docs.sparkSession, "bit-slices")
    # Small row groups: a reader holds one of them.
    docs.select("doc_id", "text").mapInArrow(run, BLOCK).write.option("parquet.block.size", 2**24).parquet(path)
    return docs.sparkSession.read.schema(BLOCK).parquet(path)


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, and their terms with repeats."""

    documents: int
    terms: int

    def spread(self, sizes):
        """The length part of a score's divisor; of numbers or arrays."""
        return 25 + (75 * sizes * self.documents) // self.terms


def worth(often, spread):
    """What a frequency counts in a document of that spread."""
    return (1_000_000_000 * often) // (1000 * often + 8 * spread)


def weight(corpus: Corpus, holding: int) -> int:
    """The weight of a term that ``holding`` documents have."""
    return math.floor(1000 * math.log((2 * corpus.documents + 2) / (2 * holding + 1)))


class Items:
    """Weighted terms of some items: for item k the places ``own[k]`` in ``words`` and the weights ``heavy[k]``."""

    def __init__(self, counted: list[dict[bytes, int]], holding: dict[bytes, int], corpus: Corpus):
        self.corpus = corpus
        self.words = sorted({w for c in counted for w in c if holding.get(w)})
        at = {w: i for i, w in enumerate(self.words)}
        known = [[(at[w], w, n * weight(corpus, holding[w])) for w, n in c.items() if w in at] for c in counted]
        self.own = [np.array([i for i, _, _ in k], np.int64) for k in known]
        self.heavy = [np.array([h for _, _, h in k], np.float64) for k in known]
        self.pairs = [[(w, h) for _, w, h in k] for k in known]
        self.hashes = _hashed(self.words)

    def bounds(self, width: int, sizes: np.ndarray, bits: bytes) -> np.ndarray:
        """(items, documents): no score in the block is higher. Weighted sums are whole numbers below 2^53."""
        slices = np.frombuffer(bits, np.uint8).reshape(width, -1)
        out, before, spread = np.zeros((len(self.own), len(sizes)), np.int64), 0, self.corpus.spread(sizes)
        live, present, level = np.arange(len(self.words)), None, 0
        while len(live):
            places = _places(self.hashes[live], level, width).astype(np.int64)
            got = slices[places[:, 0]] if present is None else slices[places[:, 0]] & present
            for k in range(1, HASHES):
                got = got & slices[places[:, k]]
            some = got.any(axis=1)
            live, present = live[some], got[some]
            shown = np.unpackbits(present, axis=1, bitorder="little", count=len(sizes)).astype(np.float64)
            row = np.full(len(self.words), -1)
            row[live] = np.arange(len(live))
            most = worth(2 ** (level + 1) - 1, spread)
            for k, (own, heavy) in enumerate(zip(self.own, self.heavy)):
                rows = row[own]
                if (here := rows >= 0).any():
                    out[k] += (heavy[here] @ shown[rows[here]]).astype(np.int64) * (most - before)
            before, level = most, level + 1
        return out

    def score(self, k: int, counted: dict[bytes, int], spread: int) -> int:
        """Item k's exact score in a document."""
        return sum(h * worth(often, spread) for w, h in self.pairs[k] if (often := counted.get(w)))


_RANKED = "item int, doc_id bigint, score bigint"


def _ids_of(block: pa.RecordBatch, row: int) -> list:
    return block.column("ids")[row].as_py()


def _frontrunners(blocks: DataFrame, shared, top: int) -> DataFrame:
    """The ``top`` best bounds of each item that a task has met, as ``(item, doc_id, score)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, best = shared.value, {}
        for batch in batches:
            for row in range(batch.num_rows):
                sizes = batch.column("sizes")[row].values.to_numpy()
                bound = items.bounds(batch.column("width")[row].as_py(), sizes, batch.column("bits")[row].as_buffer())
                ids = _ids_of(batch, row)
                first = np.argpartition(-bound, min(top, len(ids)) - 1, axis=1)[:, :top]
                for k, places in enumerate(first):
                    own = best.get(k, []) + [(int(bound[k, p]), ids[p]) for p in places if bound[k, p] > 0]
                    best[k] = sorted(own, key=lambda x: -x[0])[:top]
        rows = [(k, i, b) for k, own in best.items() for b, i in own]
        if rows:
            item, ids, score = zip(*rows)
            yield pa.RecordBatch.from_pydict({"item": pa.array(item, pa.int32()), "doc_id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.int64())})

    return blocks.mapInArrow(run, _RANKED)


def _not_excluded(blocks: DataFrame, shared, bars: list[int]) -> DataFrame:
    """Every ``(item, doc_id)`` whose bound reaches the item's bar."""
    floor = np.array(bars, np.int64)

    def run(batch: pa.RecordBatch) -> dict:
        item, ids = [], []
        for row in range(batch.num_rows):
            sizes = batch.column("sizes")[row].values.to_numpy()
            bound = shared.value.bounds(batch.column("width")[row].as_py(), sizes, batch.column("bits")[row].as_buffer())
            k, place = np.nonzero(bound >= floor[:, None])
            item.append(pa.array(k, pa.int32()))
            ids.append(pa.array(_ids_of(batch, row), pa.int64()).take(pa.array(place)))
        return {"item": pa.concat_arrays(item), "doc_id": pa.concat_arrays(ids)}

    return mapped(blocks, run, "item int, doc_id bigint")


def _scored(docs: DataFrame, wanted: DataFrame, shared) -> DataFrame:
    """Exact scores above 0 of ``wanted(item, doc_id)``; a doc_id of several rows is scored in each of them."""

    def run(batch: pa.RecordBatch) -> dict:
        items, out = shared.value, []
        for doc_id, text, own in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("items").to_pylist()):
            words = terms(text.as_py())
            if words:
                counted, spread = Counter(words), items.corpus.spread(len(words))
                out += [(k, doc_id, s) for k in own if (s := items.score(k, counted, spread)) > 0]
        item, ids, score = zip(*out) if out else ((), (), ())
        return {"item": pa.array(item, pa.int32()), "doc_id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.int64())}

    own = wanted.distinct().groupBy(F.col("doc_id").alias("wanted_id")).agg(F.collect_list("item").alias("items"))
    met = docs.select("doc_id", "text").join(own, F.col("doc_id").eqNullSafe(F.col("wanted_id")))
    return mapped(met.select("doc_id", "text", "items"), run, _RANKED)


def _best(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _holding(docs: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """Number of rows that have each of the wanted terms."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                counted.update(shared.value.intersection(terms(text.as_py())))
        if counted:
            yield pa.RecordBatch.from_pydict({"term": pa.array(list(counted), pa.binary()), "n": pa.array(list(counted.values()), pa.int64())})

    found = docs.select("text").mapInArrow(run, "term binary, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    shared.unpersist()
    return {bytes(r.term): r.n for r in found}


def search(docs: DataFrame, items: DataFrame, top: int = TOP, blocks: DataFrame | None = None, items_bytes: int = ITEMS_BYTES) -> DataFrame:
    """The ``top`` rows of ``docs(doc_id, text)`` for each of ``items(item_id, text)``: item_id, rank, doc_id, score.

    Scores are whole numbers; only those above 0 are ranked, equal ones by ascending doc_id, a null doc_id last.
    Rows of docs are documents of their own, also where they repeat a doc_id. Rows of items that repeat both columns
    are one item; an item_id with several texts, or none, is ranked for each text. Null and empty texts have no
    terms: they are found by nothing, find nothing, and do not count as documents. An empty table gives an empty
    table; other columns are ignored. ``blocks`` is an ``index`` of the same rows, made here where it is not given.

    Items go through in groups of ``items_bytes``; the terms of a group are broadcast, its results are written.
    """
    blocks = index(docs) if blocks is None else blocks
    total = blocks.select(F.sum(F.size("ids")).alias("n"), F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("terms")).first()
    corpus = Corpus(int(total.n or 0), int(total.terms or 0))
    asked = items.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    groups = -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // items_bytes)
    result = None
    for g in range(groups if corpus.documents else 0):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).collect()
        found = _group(docs, blocks, corpus, sorted(map(tuple, rows), key=repr), top)
        result = found if result is None else result.union(found)
    empty = "item_id bigint, rank int, doc_id bigint, score bigint"
    return docs.sparkSession.createDataFrame([], empty) if result is None else result


def _group(docs: DataFrame, blocks: DataFrame, corpus: Corpus, rows: list[tuple], top: int) -> DataFrame:
    spark = docs.sparkSession
    counted = [Counter(terms(text)) for _, text in rows]
    holding = _holding(docs, {w for c in counted for w in c})
    shared = spark.sparkContext.broadcast(Items(counted, holding, corpus))
    first = _best(_frontrunners(blocks, shared, top), top).select("item", "doc_id")
    lowest = _best(_scored(docs, settle(first, "search-first"), shared), top).where(F.col("rank") == top)
    bars = {r["item"]: r["score"] for r in lowest.select("item", "score").collect()}
    wanted = _not_excluded(blocks, shared, [bars.get(k, 1) for k in range(len(rows))])
    best = settle(_best(_scored(docs, wanted, shared), top), "search-best")
    shared.unpersist()
    names = spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(rows)], "item int, item_id bigint")
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
