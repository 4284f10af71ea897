"""Document fingerprints: chains of content words that follow common words.

Every common word of a text is an *anchor*; it and the content words at steps after it make a signature. A text's
fingerprint is its set of signatures. Frames, menus and lists have few common words, so prose decides. Two
fingerprints are compared by Jaccard similarity, which the sizes of the sets bound: sets are partitioned by size so
that only neighbouring partitions can meet, and within them only sets that share a rare enough signature do.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartlake.llm.common import mapped, row_id, settle, worker_cache
from cartlake.llm.components import components
from cartlake.llm.decontaminate import normal

#: Common words of English, German, French and Spanish.
ANCHORS = frozenset(
    w.encode()
    for w in """
    a an and are as at be but by for from had has have he his in is it its not of on or she that the their they this to was were which with you
    als am auch auf aus bei das dem den der des die ein eine einen einer es für im ist mit nicht noch sich sie sind und von war wie wird zu zum
    au aux avec ce cette dans de du elle en est et il ils la le les mais ne nous ou par pas plus pour que qui sa se ses son sur un une vous
    al como con del el ella era esta este ha lo los las más muy no nos o para pero por sin sobre su sus también una y ya
    """.split()
)
CHAIN, STEP = 2, 1
#: Words that a worker knows the hashes of, and the longest of them.
KNOWN, LONG = 200_000, 64
#: Sets, and signatures in them, of a side where sets are compared.
SETS, SIGNATURES = 512, 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hash(word: bytes) -> int:
    """Odd for an anchor, even for a content word."""
    return xxhash.xxh64_intdigest(word) & ~1 | (word in ANCHORS)


def _hashes(words: list[bytes]) -> np.ndarray:
    known = worker_cache(__name__)
    if len(known) > KNOWN:
        known.clear()
    out = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = _hash(w)
            if len(w) <= LONG and len(known) <= KNOWN:
                known[w] = h
        out.append(h)
    return np.array(out, np.uint64)


def signatures(text: str | None, chain: int = CHAIN, step: int = STEP) -> np.ndarray:
    """The sorted set of a text's signatures.

    Words are runs of digits, letters (A-Z folded) and characters beyond ASCII. A chain that the end of the text
    cuts off is none. A text with words and without a whole chain has one signature, of all its words; one without
    words, an empty or a null text, has none.
    """
    words = normal(text).split()
    if not words:
        return np.empty(0, np.uint64)
    h = _hashes(words)
    anchor = (h & np.uint64(1)).astype(bool)
    content, at = h[~anchor], np.cumsum(~anchor)[anchor]  # of each anchor the next content word
    whole = at + (chain - 1) * step < len(content)
    at, out = at[whole], h[anchor][whole]
    if not len(at):
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))], np.uint64)
    for k in range(chain):
        out = (out ^ (out >> np.uint64(29))) * _MIX + content[at + k * step]
    return np.unique(out ^ (out >> np.uint64(32)))


def fingerprint(own: np.ndarray) -> str:
    """Names a set of signatures: 32 hexadecimal digits."""
    return xxhash.xxh3_128_hexdigest(own.tobytes())


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Similarity of two sets; 1 for two empty ones. Below ``least`` it may be given as 0.

    The sizes bound it: where they cannot reach ``least`` the signatures are not looked at.
    """
    if not len(a) and not len(b):
        return 1.0
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small):
        return 0.0
    both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
    return both / (len(a) + len(b) - both)


def edited(text: str, after: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the beginning of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


#: One row of the walk: a document, and of a partition's first and last one the text as well.
_OUT = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(), "near_next": pa.float64(), "edge": pa.string(), "piece": pa.int64(), "text": pa.string(),
}
_SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edge string, piece bigint, text string"
#: Rows, and characters of texts, of a batch that leaves a worker.
_ROWS, _CHARS = 2048, 2**22


def _compared(doc_id: int | None, text: str, own: np.ndarray, after: str, other: np.ndarray) -> dict:
    changed = edited(text, after)
    new = signatures(changed)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return {
        "doc_id": doc_id, "n_chars": len(text), "edited_sha256": digest, "fingerprint": fingerprint(own),
        "edited_fingerprint": fingerprint(new), "near_edited": jaccard(own, new), "near_next": jaccard(own, other),
    }


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document with the next one of its partition; the first and the last document go on as edges."""
    before, out, chars, piece = None, [], 0, None
    for batch in batches:
        for doc_id, text, piece in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("piece").to_pylist()):
            text = text.as_py() or ""
            own = signatures(text)
            if before is None:
                out.append({"edge": "first", "piece": piece, "doc_id": doc_id, "text": text})
                chars += len(text)
            else:
                out.append(_compared(*before, text, own))
            before = doc_id, text, own
            if len(out) >= _ROWS or chars >= _CHARS:
                yield pa.RecordBatch.from_pylist(out, pa.schema(_OUT.items()))
                out, chars = [], 0
    if before is not None:
        out.append({"edge": "last", "piece": piece, "doc_id": before[0], "text": before[1]})
    if out:
        yield pa.RecordBatch.from_pylist(out, pa.schema(_OUT.items()))


def edits(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` and how like each fingerprint is to that of the edited text and of the next document.

    A row for each row: ``doc_id``, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``. The edited text has its last half replaced by the
    beginning of the next document's. Documents go by doc_id, null first; rows of one doc_id by a hash of the text,
    then as they are read; the first follows the last, a single one follows itself. A null text is an empty one. An
    empty table gives an empty table; other columns are ignored.

    Texts are shuffled once, by ranges of that order, and walked as streams. Only the first and the last text of each
    range meet again, in a join of the written edges.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), row_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), "text_key", "row"]
    lined = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id().cast("bigint").alias("piece"))
    walked = settle(lined.mapInArrow(_walk, _SCHEMA), "spots-walked")
    last = walked.where("edge = 'last'").select("doc_id", "text", "piece")
    pieces = [r.piece for r in last.select("piece").orderBy("piece").collect()]  # as many as partitions of the shuffle
    given = [c for c in walked.columns if c not in ("edge", "piece", "text")]
    inner = walked.where("edge IS NULL").select(*given)
    if not pieces:
        return inner
    following = docs.sparkSession.createDataFrame(list(zip(pieces, pieces[1:] + pieces[:1])), "piece bigint, follows bigint")
    first = walked.where("edge = 'first'").select(F.col("piece").alias("follows"), F.col("text").alias("after"))
    met = last.join(following, "piece").join(first, "follows").select("doc_id", "text", "after")

    def run(batch: pa.RecordBatch) -> dict:
        rows = [_compared(r["doc_id"], r["text"], signatures(r["text"]), r["after"], signatures(r["after"])) for r in batch.to_pylist()]
        return {c: pa.array([r[c] for r in rows], _OUT[c]) for c in given}

    return inner.union(mapped(met, run, _SCHEMA.partition(", edge")[0]))


# -- near-duplicates -----------------------------------------------------------------------------------------


def _alike(table: pa.Table, similarity: float) -> pa.Table:
    """Links of two sides of sets, as (set, smaller set of its tree). Sets go by size, which bounds what may meet."""
    node, side = table["node"].to_numpy(), table["side"].to_numpy()
    held = [np.frombuffer(x, np.uint64) for x in table["held"].to_pylist()]
    size = np.array([len(h) for h in held])
    order = np.lexsort((node, size))
    parent = {int(n): int(n) for n in node}

    def root(n: int) -> int:
        while parent[n] != n:
            parent[n] = n = parent[parent[n]]
        return n

    for place, i in enumerate(order):
        for j in order[place + 1 :]:
            if size[j] * similarity > size[i]:
                break
            if side[i] == side[j] != 0:
                continue
            a, b = root(int(node[i])), root(int(node[j]))
            if a != b and jaccard(held[i], held[j], similarity) >= similarity:
                parent[max(a, b)] = min(a, b)
    moved = [n for n in parent if parent[n] != n]
    return pa.table({"a": pa.array(moved, pa.int64()), "b": pa.array([root(n) for n in moved], pa.int64())})


def groups(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, fingerprint, component_id)``: groups linked by a Jaccard ``similarity`` or more.

    A row for each row; ``component_id`` is the smallest doc_id that links reach. Equal fingerprints are linked, also
    those of texts without words. Rows that repeat a doc_id are linked each by its own text; a null doc_id is linked
    like another and never names a component, which is null where it has no other. An empty table gives an empty
    table; other columns are ignored.

    A set is cut by size into partitions of ratio 1 / similarity. Two sets that are alike are in one or in neighbouring
    partitions and share one of their rarest signatures, so many as the similarity leaves no choice about. Where very
    many sets share one they meet in tiles of bounded size; a tile returns a forest, not its pairs.
    """

    def made(batch: pa.RecordBatch) -> dict:
        own = [signatures(t) for t in batch.column("text").to_pylist()]
        held = pa.array([x.tobytes() for x in own], pa.binary())
        return {"doc_id": batch.column("doc_id"), "fingerprint": pa.array([fingerprint(x) for x in own]), "n": pa.array([len(x) for x in own], pa.int64()), "held": held}

    found = settle(mapped(docs.select("doc_id", "text"), made, "doc_id bigint, fingerprint string, n bigint, held binary"), "spots-sets")
    classes = found.groupBy("fingerprint").agg(F.any_value("n").alias("n"), F.any_value("held").alias("held"), F.min("doc_id").alias("least"))
    classes = settle(classes.withColumn("node", row_id()), "spots-classes")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, n, held in zip(batch.column("node"), batch.column("n").to_pylist(), batch.column("held")):
                if n:
                    spots = np.frombuffer(held.as_py(), np.int64)
                    yield pa.record_batch({"node": pa.array(np.full(n, node.as_py())), "n": pa.array(np.full(n, n)), "spot": pa.array(spots)})

    spots = settle(classes.select("node", "n", "held").mapInArrow(each, "node bigint, n bigint, spot bigint"), "spots-each")
    held_by = spots.groupBy("spot").agg(F.count("*").alias("df")).where("df > 1")
    # Signatures of one set only come first and meet nothing, so they are counted and not ranked.
    shared = spots.join(settle(held_by, "spots-shared"), "spot")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("df", "spot")) + F.col("n") - F.count("*").over(Window.partitionBy("node"))
    prefix = shared.withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1)
    band = F.floor(F.log("n") / -math.log(similarity) + 1e-9)
    keyed = prefix.select("node", "n", "spot", F.explode(F.array(band, band + 1)).alias("band"))
    keyed = settle(keyed, "spots-keyed")
    blocks = F.ceil(F.greatest(F.count("*") / SETS, F.sum("n") / SIGNATURES)).cast("int")
    parts = settle(keyed.groupBy("spot", "band").agg(F.count("*").alias("c"), blocks.alias("blocks")).where("c > 1").drop("c"), "spots-parts")
    put = keyed.join(parts, ["spot", "band"]).withColumn("at", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    put = put.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("at") == F.col("with"), 0).when(F.col("at") < F.col("with"), 1).otherwise(2)
    put = put.select("node", "spot", "band", F.least("at", "with").alias("lo"), F.greatest("at", "with").alias("hi"), side.alias("side"))
    tiles = put.join(classes.select("node", "held"), "node")
    links = tiles.groupBy("spot", "band", "lo", "hi").applyInArrow(lambda t: _alike(t, similarity), "a bigint, b bigint")
    linked = classes.select("node", "fingerprint", "least").join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    linked = settle(linked, "spots-linked")
    named = linked.join(linked.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("fingerprint", "component_id")
    return found.select("doc_id", "fingerprint").join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")
