"""Exact token counts at every prefix of a text, by dynamic programming over its last tokens.

The encoding of a prefix ends in some piece, and what stands before that piece is encoded as the shorter prefix
is. So a prefix needs only its last piece and its count: the last piece is the one that stays apart from the last
piece of the shorter prefix when the two are merged on their own. With the counts of all prefixes, "how many
tokens has this text up to here" and "how much of it fits a budget" are look-ups; nothing is encoded again.
"""

from __future__ import annotations

from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartlake.llm.common import mapped
from cartlake.llm.pieces import KEPT, SPACE, Vocabulary, chunks_of, vocabulary

#: The last "piece" of a prefix that ends in a character without a piece: nothing joins with it.
ALONE = -2


class PrefixCounts:
    """Counts at every prefix of chunks (see ``pieces``) of one vocabulary."""

    def __init__(self, voc: Vocabulary):
        self.voc, self._fits, self._whole = voc, {}, {}
        #: By the last two characters: the longest piece that ends so.
        self.longest: dict[str, int] = {}
        for piece in voc.ids:
            self.longest[piece[-2:]] = max(len(piece), self.longest.get(piece[-2:], 1))
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, int] = {}

    def whole(self, piece: int) -> bool:
        """The piece's text is encoded as the piece alone."""
        if (found := self._whole.get(piece)) is None:
            found = self._whole[piece] = self.voc.merged(self.voc.text[piece]) == [piece]
        return found

    def fits(self, left: int, right: int) -> bool:
        """Two neighbouring pieces stay as they are when their joined text is encoded."""
        key = left * self.voc.size + right
        if (found := self._fits.get(key)) is None:
            found = self.whole(right) and self.voc.merged(self.voc.text[left] + self.voc.text[right]) == [left, right]
            self._fits[key] = found
        return found

    def _extend(self, chunk: str, last: list[int], counts: array) -> None:
        """One more prefix: that of ``len(last)`` characters."""
        ids, i = self.voc.ids, len(last)
        if chunk[i - 1] not in ids:
            last.append(ALONE)
            counts.append(counts[-1] + (len(chunk[i - 1].encode()) if self.voc.bytes else 1))
            return
        for size in range(min(i, self.longest.get(chunk[max(0, i - 2) : i], 1)), 0, -1):
            piece = ids.get(chunk[i - size : i])
            if piece is not None:
                before = last[i - size]
                if self.whole(piece) if before == ALONE else self.fits(before, piece):
                    last.append(piece)
                    counts.append(counts[i - size] + 1)
                    return
        merged = self.voc.merged(chunk[:i])  # not met so far: no piece fits, so the prefix is encoded as a whole
        last.append(merged[-1])
        lost = sum(len(c.encode()) - 1 for c in chunk[:i] if c not in ids) if self.voc.bytes else 0
        counts.append(len(merged) + lost)

    def learn(self, wanted: set[str]) -> None:
        """Counts of chunks, of all that are wanted; in sorted order, so that a shared beginning is worked out once."""
        if len(self.chunks) > KEPT:
            self.chunks.clear()
        if len(self._fits) > 2 * KEPT:
            self._fits.clear()
        chunks = wanted - self.chunks.keys()
        before, last, counts = "", [ALONE], array("i", [0])
        for chunk in sorted(chunks):
            same, most = 0, min(len(before), len(chunk))
            while same < most and before[same] == chunk[same]:
                same += 1
            del last[same + 1 :], counts[same + 1 :]
            spaced = chunk.replace(" ", SPACE)
            for _ in range(same, len(chunk)):
                self._extend(spaced, last, counts)
            self.chunks[chunk] = counts[1:].tobytes()
            before = chunk

    def at_every_prefix(self, text: str) -> np.ndarray:
        """``counts[p]``: tokens of ``text[:p]`` for p from 0 to its length (no begin or end)."""
        out, base = [np.zeros(1, np.int32)], 0
        parts = chunks_of(text)
        self.learn(set(parts))
        for part in parts:
            own = np.frombuffer(self.chunks[part], np.int32) + base
            base = int(own[-1])
            out.append(own)
        counts = np.concatenate(out)
        return np.concatenate((counts[:1], counts[2:])) if parts else counts  # without the mark before the text

    def totals(self, texts: list[str]) -> list[int]:
        """Tokens of whole texts."""
        words, cut = self.words, [t.replace(SPACE, " ").split(" ") for t in texts]
        found = [None if "" in parts else list(map(words.get, parts)) for parts in cut]
        uneven = {k: chunks_of(texts[k]) for k, f in enumerate(found) if f is None}
        fresh = {w: chunks_of(w) for parts, f in zip(cut, found) if f and None in f for w, n in zip(parts, f) if n is None}
        self.learn({c for own in fresh.values() for c in own} | {c for own in uneven.values() for c in own})
        ends = lambda own: sum(int.from_bytes(self.chunks[c][-4:], "little") for c in own)
        counted = {w: ends(own) for w, own in fresh.items()}
        if len(words) < KEPT:
            words.update(counted)
        return [
            ends(uneven[k]) if f is None else sum(f) if None not in f else sum(counted[w] if n is None else n for w, n in zip(parts, f))
            for k, (parts, f) in enumerate(zip(cut, found))
        ]


@lru_cache(maxsize=2)
def prefix_counts(path: str) -> PrefixCounts:
    return PrefixCounts(vocabulary(path))


def _slices(texts: list[str], chars: int = 4_000_000):
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= chars):
            size += len(texts[end])
            end += 1
        yield texts[at:end]
        at = end


def counted(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, n_bytes, n_tokens, over_limit)``, a row for each row, over whole texts.

    A null text is an empty one: no bytes, no tokens. Null and repeated doc_ids are kept; an empty table gives an
    empty table; other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> dict:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        counts = prefix_counts(path)
        tokens = [n for part in _slices(texts) for n in counts.totals(part)]
        sizes = [len(t.encode()) for t in texts]
        return {"doc_id": batch.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()), "n_tokens": pa.array(tokens, pa.int64()), "over_limit": pa.array([n > limit for n in tokens], pa.bool_())}

    return mapped(docs.select("doc_id", "text"), run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")


def prefix_table(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, counts array<int>)``: the token count of every prefix, the empty one first."""

    def run(batch: pa.RecordBatch) -> dict:
        counts = prefix_counts(path)
        rows = [counts.at_every_prefix(t or "") for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "counts": pa.array(rows, pa.list_(pa.int32()))}

    return mapped(docs.select("doc_id", "text"), run, "doc_id bigint, counts array<int>")


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of ``budget`` tokens or fewer. Counts may fall as a text grows, so the last fit counts."""
    fits = np.flatnonzero(np.asarray(counts) <= budget)
    return int(fits[-1]) if len(fits) else 0


def truncated(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """``(doc_id, text)`` to ``(doc_id, text, n_tokens)``: the longest prefix within the budget and its count."""

    def run(batch: pa.RecordBatch) -> dict:
        counts, texts, tokens = prefix_counts(path), [], []
        for text in batch.column("text").to_pylist():
            own = counts.at_every_prefix(text or "")
            at = longest_prefix(own, budget)
            texts.append(text and text[:at])
            tokens.append(int(own[at]))
        return {"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string()), "n_tokens": pa.array(tokens, pa.int64())}

    return mapped(docs.select("doc_id", "text"), run, "doc_id bigint, text string, n_tokens bigint")
