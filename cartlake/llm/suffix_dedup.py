"""Suffix-array deduplication of byte strings that occur more than once.

Texts are cut into *pieces*: stretches of windows (strings of ``length`` bytes) whose smallest gram hash is the same.
Equal windows have equal smallest hashes, so all places of a repeated string are in pieces of one key; a key that
only one place has needs no look. Equal pieces are one piece with a count, and all their windows are repeated.
Pieces of a key that differ are indexed: each shard of pieces gets its Burrows-Wheeler transform, and the
transforms are merged by refining their interleave one character at a time. No suffix is compared or sorted again:
a step moves every entry to the bucket of the character before it, in the order of the step before. Entries that
are told apart at step k share k - 1 characters, and those that still stand together after ``length`` steps are the
places of a repeated string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import row_id, settle

LENGTH = 200
GRAM = 64
SHARD_BYTES = 32_768
#: Distinct pieces of a key beyond this are not merged in one task: their windows are counted by hash instead.
GROUP_BYTES = 4 * 2**20
#: Keys are merged together up to about this size.
UNIT_BYTES = 512 * 1024

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def gram_hashes(data: np.ndarray, size: int, base: np.uint64 = _BASE) -> np.ndarray:
    """A hash of every ``size`` bytes that stand together: sum of byte * base^place, put together by doubling."""
    parts, have, width, power = [], data.astype(np.uint64) + np.uint64(1), 1, base
    rest, out, out_width = size, None, 0
    while rest:
        if rest & 1:
            if out is None:
                out, out_width = have, width
            else:
                n = len(data) - out_width - width + 1
                shift = np.uint64(pow(int(base), width, 2**64))
                out = have[:n] + shift * out[width : width + n]
                out_width += width
        rest >>= 1
        if rest:
            n = len(data) - 2 * width + 1
            have = have[:n] + power * have[width : width + n]
            power, width = np.uint64(pow(int(base), 2 * width, 2**64)), 2 * width
    return _mixed(out[: len(data) - size + 1])


def _least(h: np.ndarray, span: int) -> np.ndarray:
    """The smallest of every ``span`` neighbours."""
    width, n = 1, len(h) - span + 1
    while 2 * width <= span:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.minimum(h[:n], h[span - width : span - width + n])


def runs(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, first windows and numbers of windows of a text's pieces, and whether a piece has its smallest gram twice.

    Only then can a piece hold a window twice. A long text is walked in overlapping blocks.
    """
    raw, span, block = np.frombuffer(data, np.uint8), length - gram + 1, 1 << 20
    out: list[tuple[np.ndarray, ...]] = []
    windows = max(0, len(raw) - length + 1)
    with np.errstate(over="ignore"):
        for at in range(0, windows, block):
            h = gram_hashes(raw[at : at + block + length - 1], gram)
            least = _least(h, span)
            new = np.concatenate(([True], least[1:] != least[:-1]))
            run, first = np.cumsum(new) - 1, np.flatnonzero(new)
            # A place is the smallest of some window if the largest of its windows' smallest hashes is its own.
            ends = np.zeros(span - 1, np.uint64)
            smallest = np.flatnonzero(~_least(~np.concatenate((ends, least, ends)), span) == h)
            again = smallest[1:][h[smallest[1:]] == h[smallest[:-1]]]
            window = np.maximum(again - span + 1, 0)
            twice = np.zeros(len(first), bool)
            twice[run[window[least[window] == h[again]]]] = True
            out.append((least[first], first + at, np.diff(np.concatenate((first, [len(least)]))), twice))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    key, first, n, twice = map(np.concatenate, zip(*out))
    return key, first, n, twice


# -- index of differing pieces ------------------------------------------------------------------------------


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Places of a shard in the order of the ``depth`` bytes from there on (prefix doubling; equal ones by place)."""
    n, have = len(data), 8
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    rank = np.zeros(n, np.uint64)
    for k in range(8):
        rank = (rank << np.uint64(8)) | padded[k : k + n]
    rank = np.unique(rank, return_inverse=True)[1]
    while have < depth and rank.max(initial=0) < n - 1:
        behind = np.zeros(n, np.int64)
        behind[: max(0, n - have)] = rank[have:] + 1
        rank = np.unique(rank * (n + 1) + behind, return_inverse=True)[1]
        have *= 2
    return np.argsort(rank, kind="stable")


class Shard:
    """Suffix order, Burrows-Wheeler transform (``step`` bytes a symbol) and last-to-first map of some pieces."""

    def __init__(self, data: np.ndarray, depth: int, step: int):
        self.order = suffix_order(data, depth)
        self.rank = np.empty(len(data), np.int64)
        self.rank[self.order] = np.arange(len(data))
        before = np.maximum(self.order - step, 0)
        self.symbol = np.zeros(len(data), np.uint32)
        for k in range(step):
            self.symbol = (self.symbol << np.uint32(8)) | data[np.minimum(before + k, len(data) - 1)]
        self.last_to_first = self.rank[before]


def repeated_windows(pieces: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each piece, which of its windows also start anywhere else in the pieces.

    The transforms of the shards are merged from the empty prefix on: every window begins as the place behind it, all
    in one interval; a step takes each entry to the symbol before it, keeping the order inside a symbol. An interval
    of one entry has no equal and is dropped.
    """
    step = 4 if length % 4 == 0 else 1
    shards, orders, starts, at = [], [], [], 0
    group: list[bytes] = []
    ends: list[int] = []

    def close() -> None:
        nonlocal at
        data = np.frombuffer(b"".join(group) + b"\0", np.uint8)  # a place behind the last window of all
        shard = Shard(data, length, step)
        behind = np.concatenate([np.arange(b - len(p) + length, b + 1) for p, b in zip(group, ends)])
        starts.append(np.sort(shard.rank[behind]) + at)
        shards.append(shard)
        orders.append(shard.order)
        at += len(data)
        group.clear()
        ends.clear()

    offsets, shard_of = [], []
    for piece in pieces:
        if group and ends[-1] + len(piece) > SHARD_BYTES:
            close()
        offsets.append(ends[-1] if ends else 0)
        shard_of.append(len(shards))
        group.append(piece)
        ends.append(offsets[-1] + len(piece))
    if not group:
        return []
    close()
    bases = np.concatenate(([0], np.cumsum([len(o) for o in orders])))
    symbol = np.unique(np.concatenate([s.symbol for s in shards]), return_inverse=True)[1]
    symbol = symbol.astype(np.uint16 if symbol.max(initial=0) < 65_536 else np.uint32)
    first = np.concatenate([s.last_to_first + b for s, b in zip(shards, bases)])
    entry, block = np.concatenate(starts), np.zeros(sum(map(len, starts)), np.int64)
    for _ in range(length // step):
        c = symbol[entry]
        order = np.argsort(c, kind="stable")
        c, entry, block = c[order], first[entry[order]], block[order]
        new = np.concatenate(([True], (c[1:] != c[:-1]) | (block[1:] != block[:-1]))) if len(c) else np.zeros(0, bool)
        block = np.cumsum(new) - 1
        alone = new & np.concatenate((new[1:], [True])) if len(c) else new
        if alone.any():
            entry, block = entry[~alone], block[~alone]
    hit = np.zeros(bases[-1], bool)
    hit[np.concatenate(orders)[entry] + bases[np.searchsorted(bases, entry, "right") - 1]] = True
    return [hit[bases[s] + o : bases[s] + o + len(p) - length + 1] for p, o, s in zip(pieces, offsets, shard_of)]


def ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of set flags, end excluded."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


# -- jobs ---------------------------------------------------------------------------------------------------

_SPANS = "array<struct<a:bigint,b:bigint>>"
_SPANS_ARROW = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _spans(rows) -> pa.Array:
    return pa.array([[{"a": a, "b": b} for a, b in r] for r in rows], _SPANS_ARROW)


def _runs_of(rows: DataFrame, length: int) -> DataFrame:
    """``(row, text)`` to ``(key, row, first, n, twice)``: the pieces of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(row, *runs(_raw(text), length)) for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist())]
            if found:
                own = np.repeat(np.array([f[0] for f in found]), [len(f[1]) for f in found])
                key, first, n, twice = (np.concatenate([f[k] for f in found]) for k in (1, 2, 3, 4))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(own, pa.int64()), pa.array(first), pa.array(n), pa.array(twice)], names=["key", "row", "first", "n", "twice"])

    return rows.mapInArrow(run, "key bigint, row bigint, first bigint, n bigint, twice boolean")


def _packed(rows: DataFrame) -> DataFrame:
    """``(row, doc_id, zipped, empty)``: what a join on the row moves of a text; ``empty`` marks a null one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packer = zstandard.ZstdCompressor(level=3)
            texts = batch.column("text").to_pylist()
            zipped = pa.array([packer.compress(_raw(t)) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), zipped, pa.array([t is None for t in texts])], names=["row", "doc_id", "zipped", "empty"])

    return rows.mapInArrow(run, "row bigint, doc_id bigint, zipped binary, empty boolean")


def _unpacked(zipped: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(zipped)


def _pieces(listed: DataFrame, length: int) -> DataFrame:
    """``(row, copies, places, zipped)`` to a row per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("pid", pa.binary()), ("row", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("twice", pa.bool_()), ("copies", pa.int64()), ("piece", pa.binary())])
        for batch in batches:
            out, size = [], 0
            for r in batch.to_pylist():
                raw = _unpacked(r["zipped"])
                for p in r["places"]:
                    piece = raw[p["first"] : p["first"] + p["n"] + length - 1]
                    out.append({"key": p["key"], "pid": hashlib.sha256(piece).digest()[:16], "row": r["row"], "first": p["first"], "n": p["n"], "twice": p["twice"], "copies": r["copies"], "piece": piece})
                    size += len(piece)
                    if size > 16_000_000:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
            yield pa.RecordBatch.from_pylist(out, schema)

    return listed.mapInArrow(run, "key bigint, pid binary, row bigint, first bigint, n bigint, twice boolean, copies bigint, piece binary")


def _merged(pieces: DataFrame, length: int) -> DataFrame:
    """Distinct pieces, keys together and in order, to ``(key, pid, spans)`` of repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit: list[tuple[int, bytes, bytes]] = []
        size, at = 0, None

        def close() -> pa.RecordBatch:
            found = [ranges(f) for f in repeated_windows([p for _, _, p in unit], length)]
            rows = [(k, i, f) for (k, i, _), f in zip(unit, found) if f]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), _spans(r[2] for r in rows)], names=["key", "pid", "spans"])

        for batch in batches:
            for key, pid, piece in zip(batch.column("key").to_pylist(), batch.column("pid").to_pylist(), batch.column("piece").to_pylist()):
                if key != at and size > UNIT_BYTES:
                    yield close()
                    unit, size = [], 0
                at = key
                unit.append((key, pid, piece))
                size += len(piece)
        yield close()

    return pieces.repartition("key").sortWithinPartitions("key", "pid").mapInArrow(run, f"key bigint, pid binary, spans {_SPANS}")


def _counted(pieces: DataFrame, length: int) -> DataFrame:
    """The same for keys with too many pieces for one task: windows are counted by two 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, pid, piece in zip(batch.column("key").to_pylist(), batch.column("pid").to_pylist(), batch.column("piece").to_pylist()):
                raw = np.frombuffer(piece, np.uint8)
                with np.errstate(over="ignore"):
                    one, two = (gram_hashes(raw, length, b).view(np.int64) for b in (_BASE, np.uint64(0xD6E8FEB86659FD93)))
                n = len(one)
                yield pa.RecordBatch.from_arrays([pa.array([key] * n, pa.int64()), pa.array([pid] * n, pa.binary()), pa.array(np.arange(n)), pa.array(one), pa.array(two)], names=["key", "pid", "at", "one", "two"])

    windows = settle(pieces.mapInArrow(run, "key bigint, pid binary, at bigint, one bigint, two bigint"), "suffix-windows")
    often = settle(windows.groupBy("one", "two").agg(F.count("*").alias("c")).where("c > 1").select("one", "two"), "suffix-often")
    span = F.struct(F.col("at").alias("a"), (F.col("at") + 1).alias("b"))
    return windows.join(often, ["one", "two"]).groupBy("key", "pid").agg(F.collect_list(span).alias("spans"))


def covered(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``rows(row, doc_id, text)`` to ``(row, spans, whole)`` for rows in which anything is repeated.

    ``spans``: ranges of windows that occur more than once; ``whole``: the text is met more than once, so all of its
    windows are.
    """
    found = settle(_runs_of(rows.select("row", "text"), length), "suffix-runs")
    keys = settle(found.groupBy("key").agg(F.count("*").alias("c"), F.max("twice").alias("twice")).where("c > 1 or twice").select("key"), "suffix-keys")
    sums = settle(rows.where(F.octet_length("text") >= length).select("row", F.unhex(F.sha2("text", 256)).alias("sha")), "suffix-sums")
    groups = settle(sums.groupBy("sha").agg(F.min("row").alias("lead"), F.count("*").alias("copies")), "suffix-groups")
    copied = sums.join(groups.where("copies > 1").select("sha"), "sha").select("row", F.lit(True).alias("whole"))
    place = F.struct("first", "n", "key", "twice")
    listed = found.join(keys, "key").groupBy("row").agg(F.collect_list(place).alias("places"))
    listed = listed.join(groups.select(F.col("lead").alias("row"), "copies"), "row")  # equal texts are one text
    pieces = settle(_pieces(listed.join(_packed(rows), "row").select("row", "copies", "places", "zipped"), length), "suffix-pieces")
    each = settle(pieces.groupBy("key", "pid").agg(F.sum("copies").alias("copies"), F.max("n").alias("n"), F.max("twice").alias("twice")), "suffix-each")
    # Several pieces of a key, or one that may repeat itself, need an index.
    open_keys = settle(
        each.groupBy("key").agg(F.count("*").alias("c"), F.max("twice").alias("twice"), F.sum(F.col("n") + length - 1).alias("size")).where("c > 1 or twice").select("key", "size"),
        "suffix-open",
    )
    differing = pieces.select("key", "pid", "piece").join(open_keys, "key").groupBy("key", "pid", "size").agg(F.any_value("piece").alias("piece"))
    differing = settle(differing, "suffix-differing")
    by_merge = _merged(differing.where(F.col("size") <= GROUP_BYTES), length)
    by_count = _counted(differing.where(F.col("size") > GROUP_BYTES), length)
    alike = each.where("copies > 1").select("key", "pid", F.array(F.struct(F.lit(0).cast("bigint").alias("a"), F.col("n").alias("b"))).alias("spans"))
    marks = settle(by_merge.unionByName(by_count).unionByName(alike), "suffix-marks")
    single = pieces.where("copies = 1").select("key", "pid", "row", "first").join(marks, ["key", "pid"])
    moved = F.transform("spans", lambda s: F.struct((s["a"] + F.col("first")).alias("a"), (s["b"] + F.col("first")).alias("b")))
    parts = single.select("row", moved.alias("spans")).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    nothing = F.lit([]).cast(_SPANS)
    return parts.select("row", "spans", F.lit(False).alias("whole")).union(copied.select("row", nothing.alias("spans"), "whole"))


def cut(raw: bytes, spans: list[tuple[int, int]], length: int = LENGTH) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text, and the ranges of bytes that were removed, in order and joined."""
    removed: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        end = b - 1 + length
        if removed and a <= removed[-1][1]:
            removed[-1] = (removed[-1][0], max(end, removed[-1][1]))
        else:
            removed.append((a, end))
    kept, at = [], 0
    for a, b in removed:
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]]), removed


def deduplicated(docs: DataFrame, length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` without every byte that a repeated string of ``length`` bytes covers.

    A row for each row: ``doc_id``, ``n_bytes`` (UTF-8), ``n_removed``, ``n_spans`` (maximal removed ranges),
    ``kept_sha256`` of the remaining bytes; with ``keep_text`` also ``row`` and the remaining ``text`` (bytes that are
    no whole character any more are left out). A string counts wherever it starts, in the same text too; overlaps
    count; strings never cross texts and are judged on the input. A null text is an empty one. Null and repeated
    doc_ids are kept, and rows that repeat a text repeat its strings. An empty table gives an empty table; other
    columns are ignored.
    """
    rows = docs.select(row_id().alias("row"), "doc_id", "text")
    found = settle(covered(rows, length), "suffix-covered")
    full = _packed(rows).join(found, "row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "row", "text")}
            for r in batch.to_pylist():
                raw = _unpacked(r["zipped"])
                spans = [(0, len(raw) - length + 1)] if r["whole"] else [(s["a"], s["b"]) for s in r["spans"] or []]
                kept, removed = cut(raw, spans, length)
                for k, v in (("doc_id", r["doc_id"]), ("n_bytes", len(raw)), ("n_removed", len(raw) - len(kept)), ("n_spans", len(removed)), ("kept_sha256", hashlib.sha256(kept).hexdigest()), ("row", r["row"])):
                    out[k].append(v)
                out["text"].append((kept.decode("utf-8", "ignore") if keep_text and not r["empty"] else None))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, row bigint, text string"
    out = full.mapInArrow(run, schema)
    return out if keep_text else out.drop("row", "text")


def cleaned(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text``, and ``n_chars``, where there is one, counted again.

    All rows and columns stay, whatever their names; a null text stays null, a text that was all repeated is empty.
    Rows that repeat repeat each other's strings; an empty table stays empty.
    """
    left = deduplicated(docs, length, keep_text=True).select("row", "text")
    held = docs.select(F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("doc"), row_id().alias("row"))
    own = {c: F.col("doc").getField(c) for c in docs.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in own:
        own["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return held.join(left, "row").select(*[own[c].alias(c) for c in docs.columns])
