"""Benchmark decontamination by one Aho-Corasick automaton over normalised test items.

Items and documents are lower-cased (A-Z) and cut into words; the automaton's letters are whole words of the
items, its patterns their windows. A document is walked once, and every hit is mapped back to the characters of
the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import mapped, row_id, worker_cache

WINDOW = 10
#: Items whose texts have more bytes than this together are dealt into several automata.
AUTOMATON_BYTES = 32 * 2**20

_SAME = bytes(range(256))
#: Digits, a-z and all bytes of characters beyond ASCII stay; A-Z become a-z; the rest parts words.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in _SAME)
_WORD = re.compile(rb"[^ ]+")


def normal(text: str | None) -> bytes:
    """The text's UTF-8 bytes, folded; as long as before."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


class Scanner:
    """The automaton of some items: ``(item_id as text or None, text)``."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item_id, text in items:
            words = [self.ids.setdefault(w, len(self.ids) + 1) for w in normal(text).split()]
            for at in range(max(1, len(words) - window + 1) if words else 0):
                owners[tuple(words[at : at + window])].update([] if item_id is None else [item_id])
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, own in owners.items():
            self.automaton.add_word(key, (len(key), own))
        if owners:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, merged ranges of hit words (end excluded), items that occur."""
        words = normal(text).split()
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        if words and len(self.automaton):
            get = self.ids.get
            for end, (size, own) in self.automaton.iter(tuple([get(w, 0) for w in words])):
                items |= own
                spans.append((end + 1 - size, end + 1))
        return len(words), merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, overlapping ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def in_text(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character ranges of the original text for ranges of words."""
    folded = normal(text)
    places = [m.span() for m in _WORD.finditer(folded)]
    raw = text.encode("utf-8", "surrogatepass")
    chars = lambda at: len(raw[:at].decode("utf-8", "surrogatepass"))
    return [(chars(places[a][0]), chars(places[b - 1][1])) for a, b in spans]


def _scanner(key: str, items: list) -> Scanner:
    known = worker_cache(__name__)
    if key not in known:
        known.clear()
        known[key] = Scanner(items)
    return known[key]


SPAN = "array<struct<a:bigint,b:bigint>>"
_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _scan(docs: DataFrame, items: list[tuple[str | None, str | None]]) -> DataFrame:
    key = hashlib.sha256(repr(items).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(items)  # AUTOMATON_BYTES at most

    def run(batch: pa.RecordBatch) -> dict:
        scanner = _scanner(key, shared.value)
        texts = batch.column("text").to_pylist()
        found = [scanner.scan(t) for t in texts]
        chars = [in_text(t or "", spans) if spans else [] for t, (_, spans, _) in zip(texts, found)]
        listed = lambda rows: pa.array([[{"a": a, "b": b} for a, b in r] for r in rows], _SPANS)
        return {
            "row": batch.column("row"),
            "doc_id": batch.column("doc_id"),
            "n_words": pa.array([f[0] for f in found], pa.int64()),
            "spans": listed(f[1] for f in found),
            "chars": listed(chars),
            "items": pa.array([sorted(f[2]) for f in found], pa.list_(pa.string())),
        }

    rows = docs.select("doc_id", "text").withColumn("row", row_id())
    return mapped(rows, run, f"row bigint, doc_id bigint, n_words bigint, spans {SPAN}, chars {SPAN}, items array<string>")


def _dealt(items: DataFrame) -> tuple[DataFrame, int]:
    """The different items, and into how many automata they go."""
    texts = items.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    return texts, -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // AUTOMATON_BYTES) or 1


def _shard(texts: DataFrame, shards: int, k: int) -> list[tuple[str | None, str | None]]:
    return sorted(map(tuple, texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k).collect()), key=repr)


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` against ``items(item_id, text)``: a row for each document row.

    ``n_words``; ``n_hit`` (words inside any window that occurs); ``n_items`` and ``items`` (sorted texts of the
    item_ids with an occurring window); ``spans`` (hit ranges of words) and ``chars`` (the same in characters of
    the original text); ``contaminated``. A null text has no words and no windows; an item with a null item_id
    makes hits but is not counted; rows that repeat an item_id are one item. Null and repeated doc_ids are kept;
    an empty table of items hits nothing; other columns are ignored.
    """
    texts, shards = _dealt(items)
    found = _scan(docs, _shard(texts, shards, 0))
    if shards > 1:
        for k in range(1, shards):
            found = found.union(_scan(docs, _shard(texts, shards, k)))
        gather = lambda c: F.flatten(F.collect_list(c)).alias(c)  # noqa: E731  at most a document's words, from each automaton
        found = found.groupBy("row", "doc_id", "n_words").agg(gather("spans"), gather("chars"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        found = _merged(found)
    total = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["b"] - s["a"])
    return found.select("doc_id", "n_words", total.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), "items", "spans", "chars", (F.size("spans") > 0).alias("contaminated"))


def _merged(found: DataFrame) -> DataFrame:
    """Ranges from several automata in order and joined."""

    def joined(name: str):
        start = F.array_sort(name)
        empty = F.lit([]).cast(SPAN)
        step = lambda out, s: F.when(
            (F.size(out) > 0) & (s["a"] <= F.element_at(out, -1)["b"]),
            F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(F.element_at(out, -1)["a"].alias("a"), F.greatest(F.element_at(out, -1)["b"], s["b"]).alias("b")))),
        ).otherwise(F.concat(out, F.array(s)))
        return F.when(F.size(name) > 0, F.aggregate(start, empty, step)).otherwise(empty).alias(name)

    return found.select("row", "doc_id", "n_words", joined("spans"), joined("chars"), "items")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a window of an item; all columns stay as they are.

    A null or empty text stays; rows that repeat are judged each; an empty table of either kind takes nothing out.
    """
    texts, shards = _dealt(items)
    for k in range(shards):
        docs = _clean(docs, _shard(texts, shards, k))
    return docs


def _clean(docs: DataFrame, items: list[tuple[str | None, str | None]]) -> DataFrame:
    """``docs`` without what these items hit, judged in place: no shuffle."""
    key = hashlib.sha256(repr(items).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(items)  # AUTOMATON_BYTES at most

    def run(batches):
        for batch in batches:
            scanner = _scanner(key, shared.value)
            yield batch.filter(pa.array([not scanner.scan(t)[1] for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
