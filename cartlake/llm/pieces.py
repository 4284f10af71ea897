"""SentencePiece encoding and decoding of merge-type vocabularies by a score-ordered agenda.

The text is one sequence of characters; the adjacent pair whose joined piece has the best score is merged, the
leftmost first among equals, until no pair joins. Two adjacent characters that stand together in no piece can
never be merged across, so a text falls into *chunks* that are encoded on their own, and a chunk met before is
not encoded again. Every chunk that is new to a batch is checked against the sentencepiece library.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from contextlib import suppress
from functools import lru_cache
from struct import pack
from sys import getsizeof

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from cartlake.llm.common import mapped, worker_cache

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
#: Chunks that a Python worker keeps at most; a full table starts over.
KEPT = 500_000
#: Bytes of coded words, and of coded chunks, that a worker keeps for encoding. Full words stay as they are (the
#: frequent ones come early); full chunks start over. What is not kept is worked out again: results are the same.
KEPT_BYTES = 64 << 20
#: Bytes of a place in a table of them.
PLACE = 100
#: Longer chunks take the heap, shorter ones the side-by-side agenda.
LONG = 48
FAR = np.int32(2**31 - 1)
#: What counts as a letter where chunks are cut.
LETTER = r"[^\W\d_¹²³]"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Pieces of a model file and the table of joins: (left id, right id) to the joined piece's id."""

    def __init__(self, path: str):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        plain = [i for i in range(size) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        self.text = [lib.id_to_piece(i) for i in range(size)]
        self.ids = {self.text[i]: i for i in plain}
        self.bytes = {int(lib.id_to_piece(i)[3:5], 16): i for i in range(size) if lib.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.begin, self.end, self.unknown = lib.bos_id(), lib.eos_id(), lib.unk_id()
        score = np.array([lib.get_score(i) for i in range(size)])
        #: Place of a piece's score among all scores, the best first; equal scores share a place.
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int64)
        joins = {}
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                a, b = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if a is not None and b is not None:
                    joins[a, b] = i
        self.joins = joins
        keys = np.array([a * size + b for a, b in joins], np.int64)
        order = np.argsort(keys)
        self.size, self.keys, self.joined = size, keys[order], np.array(list(joins.values()), np.int64)[order]
        #: By code point: the piece of one character or -2; by id: what it decodes to.
        self.of_char = np.full(0x110000, -2, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        self.shown = [bytes([self.byte_of[i]]) if i in self.byte_of else t.replace(SPACE, " ").encode() for i, t in enumerate(self.text)]
        self.lead = len(lib.encode("\n"))
        crossing = re.compile(rf"[^{SPACE}]{SPACE}|\n|{LETTER}(?!{LETTER})[^{SPACE}]|(?!{LETTER})[^{SPACE}]{LETTER}")
        if any(c not in self.ids for p in self.ids for c in p) or any(map(crossing.search, self.ids)):
            raise ValueError("pieces must be made of pieces and must not cross chunks")

    # -- agenda ---------------------------------------------------------------------------------------------

    def _join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of each joined pair, -1 where the pair joins to no piece."""
        want = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where((self.keys[at] == want) & (left >= 0) & (right >= 0), self.joined[at], -1)

    def _side_by_side(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The agenda of many short chunks of about the same length, one merge of each chunk a round.

        Ids of all chunks in a row, and their number per chunk.
        """
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        width = int(sizes.max())
        place = np.arange(width)
        s = np.full((len(chunks), width + 1), -1, np.int32)
        s[:, :width][place[None, :] < sizes[:, None]] = self.of_char[np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)]
        pair = self._join(s[:, :-1], s[:, 1:])
        best = np.where(pair >= 0, self.rank[pair], FAR)
        active = np.arange(len(chunks))
        while True:
            at = best[active].argmin(axis=1)
            going = best[active, at] < FAR
            active, at = active[going], at[going]
            if not len(active):
                return s[s != -1], (s != -1).sum(axis=1)
            own, ranks, pairs = s[active], best[active], pair[active]
            line = np.arange(len(active))
            own[line, at] = pairs[line, at]
            source = place[None, :] + (place[None, :] > at[:, None])
            own[:, :width] = np.take_along_axis(own, source, 1)
            own[:, width] = -1
            source = np.minimum(source, width - 1)
            pairs, ranks = np.take_along_axis(pairs, source, 1), np.take_along_axis(ranks, source, 1)
            for col in (at - 1, at):
                rows, cols = line[col >= 0], col[col >= 0]
                new = self._join(own[rows, cols], own[rows, cols + 1])
                pairs[rows, cols] = new
                ranks[rows, cols] = np.where(new >= 0, self.rank[new], FAR)
            s[active], best[active], pair[active] = own, ranks, pairs

    def merged(self, chunk: str) -> list[int]:
        """The agenda of one chunk of any length as a heap over a linked list; -2 for a character without a piece."""
        ids = [self.ids.get(c, -2) for c in chunk]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(ids) and (piece := self.joins.get((ids[i], ids[j]))) is not None:
                heapq.heappush(agenda, (int(self.rank[piece]), i, ids[i], ids[j], piece))

        for i in range(len(ids) - 1):
            offer(i, i + 1)
        while agenda:
            _, i, left, right, piece = heapq.heappop(agenda)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = piece, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [x for x in ids if x != -1]

    def _spelled(self, chunk: str, ids: list[int]) -> list[int]:
        """Characters without a piece as their bytes, or as the unknown piece where the model has none."""
        out, lost = [], iter(c for c in chunk if c not in self.ids)
        for i in ids:
            out += [i] if i != -2 else [self.bytes[b] for b in next(lost).encode()] if self.bytes else [self.unknown]
        return out

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        order = sorted(range(len(chunks)), key=lambda i: len(chunks[i]))
        out: list[list[int]] = [[]] * len(chunks)
        short = [i for i in order if len(chunks[i]) <= LONG]
        for i in order[len(short) :]:
            out[i] = self.merged(chunks[i])
        for at in range(0, len(short), 8192):
            part = short[at : at + 8192]
            flat, sizes = self._side_by_side([chunks[i] for i in part])
            flat, ends = flat.tolist(), np.cumsum(sizes).tolist()
            for i, a, b in zip(part, [0, *ends], ends):
                out[i] = flat[a:b]
        return [self._spelled(c, ids) if -2 in ids else ids for c, ids in zip(chunks, out)]

    def decoded(self, ids: list[int]) -> bytes:
        return b"".join(map(self.shown.__getitem__, ids))

    def checked(self, chunks: list[str]) -> list[tuple[list[int], bool]]:
        """Chunks as the agenda encodes them, and whether the library agrees.

        A line end keeps what follows it apart from the mark that the library puts before a text.
        """
        mine, lead = self.encode_chunks(chunks), self.lead
        theirs = self.library.encode(["\n" + c for c in chunks], num_threads=1)
        return [(m, m == t[lead:]) for m, t in zip(mine, theirs)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


_CHUNK = re.compile(rf" *{LETTER}+| *(?:(?!{LETTER})[^ \n])+| +|\n")


def chunks_of(text: str) -> list[str]:
    """The chunks of a text with the space that the model puts before it."""
    return _CHUNK.findall(" " + text.replace(SPACE, " ")) if text else []


#: Ids as little-endian 32-bit numbers. Where the library disagrees or the ids do not decode to what was encoded:
#: (ids, decoded bytes, library agrees).
Coded = bytes | tuple[bytes, bytes, bool]


def _joined(parts: list[str], coded: list[Coded], before: str = "") -> Coded:
    try:
        return b"".join(coded)
    except TypeError:
        whole = [(x, (before + c).encode(), True) if isinstance(x, bytes) else x for c, x in zip(parts, coded)]
        return b"".join(x[0] for x in whole), b"".join(x[1] for x in whole), all(x[2] for x in whole)


def _learn(path: str, chunks: set[str], known: dict[str, Coded]) -> None:
    voc, new = vocabulary(path), list(chunks)
    for at in range(0, len(new), 65_536):
        part = new[at : at + 65_536]
        for c, (ids, same) in zip(part, voc.checked([c.replace(" ", SPACE) for c in part])):
            packed, shown = pack(f"<{len(ids)}I", *ids), voc.decoded(ids)
            known[c] = packed if same and shown == c.encode() else (packed, shown, same)


def _gaps(found: list) -> Iterator[int]:
    at = -1
    with suppress(ValueError):
        while True:
            yield (at := found.index(None, at + 1))


class Kept:
    """Coded chunks, and coded words: what stands between two single spaces, with the one before it."""

    def __init__(self):
        self.chunks: dict[str, Coded] = {}
        self.words: dict[str, Coded] = {}
        self.chunk_bytes = self.word_bytes = 0

    @staticmethod
    def size(coded: dict[str, Coded], keys) -> int:
        """Bytes of some entries; an entry with a disagreement, which is rare, is counted as its tuple."""
        return sum(getsizeof(k) + getsizeof(coded[k]) + PLACE for k in keys)

    def learn(self, path: str, lacking: set[str]) -> None:
        _learn(path, lacking, self.chunks)
        self.chunk_bytes += self.size(self.chunks, lacking)

    def keep(self, words: dict[str, Coded]) -> None:
        """Words up to the bound; those beyond it are worked out again when they are met again."""
        for word, coded in words.items():
            if self.word_bytes >= KEPT_BYTES:
                return
            self.words[word] = coded
            self.word_bytes += getsizeof(word) + getsizeof(coded) + PLACE

    def make_room(self) -> None:
        if self.chunk_bytes > KEPT_BYTES:
            self.chunks.clear()
            self.chunk_bytes = 0


def encode_batch(texts: list[str], path: str, slice_chars: int = 4_000_000) -> Iterator[tuple[bytes, bytes, bool]]:
    """Yields (ids without begin and end, decoded bytes, library agrees) per text, in slices of bounded size."""
    kept, at = worker_cache(__name__).setdefault(path, Kept()), 0
    chunks, words = kept.chunks, kept.words
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars + len(texts[end]) <= slice_chars):
            chars += len(texts[end])
            end += 1
        kept.make_room()
        cut = [t.replace(SPACE, " ").split(" ") for t in texts[at:end]]
        plain = ["" not in parts for parts in cut]  # without runs of spaces, which are a chunk with what follows
        cut = [parts if ok else chunks_of(t) for ok, parts, t in zip(plain, cut, texts[at:end])]
        found = [list(map((words if ok else chunks).get, parts)) for ok, parts in zip(plain, cut)]
        gaps = [list(_gaps(f)) for f in found]
        fresh = {parts[i]: _CHUNK.findall(" " + parts[i]) for ok, parts, gap in zip(plain, cut, gaps) if ok for i in gap}
        lacking = {c for own in fresh.values() for c in own} | {parts[i] for ok, parts, gap in zip(plain, cut, gaps) if not ok for i in gap}
        kept.learn(path, lacking - chunks.keys())
        coded_words = {word: _joined(own, [chunks[c] for c in own]) for word, own in fresh.items()}
        kept.keep(coded_words)
        for ok, text, parts, f, gap in zip(plain, texts[at:end], cut, found, gaps):
            for i in gap:
                f[i] = (coded_words if ok else chunks)[parts[i]]
            coded = _joined(parts, f, " " * ok)
            # A decoded text has no mark of the space before its first word.
            yield (coded, text.replace(SPACE, " ").encode(), True) if isinstance(coded, bytes) else (coded[0], coded[1][1:], coded[2])
        at = end


def encoded(docs: DataFrame, path: str, keep_ids: bool = False, keep_text: bool = False) -> DataFrame:
    """``(doc_id, text)`` to ids with begin and end, and their decoding; a row for each row, in whole texts.

    ``n_tokens``, ``ids_sha256`` (little-endian unsigned 32-bit numbers), ``decoded_sha256`` (UTF-8), ``agrees``
    (the ids, which are the agenda's, are the library's in every chunk), and with
    ``keep_ids`` / ``keep_text`` the ids (array) and the decoded text. A null text is an empty one: begin and end
    only. Null and repeated doc_ids are kept; an empty table gives an empty table; other columns are ignored.
    """
    voc_path = path

    def run(batch: pa.RecordBatch) -> dict:
        voc = vocabulary(voc_path)
        begin, end = (np.array([i], "<u4").tobytes() for i in (voc.begin, voc.end))
        out: dict = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", "agrees", "ids", "decoded")}
        for ids, decoded, same in encode_batch([t or "" for t in batch.column("text").to_pylist()], voc_path):
            ids = begin + ids + end
            out["n_tokens"].append(len(ids) // 4)
            out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
            out["agrees"].append(same)
            if keep_ids:
                out["ids"].append(np.frombuffer(ids, "<u4").astype(np.int32))
            if keep_text:
                out["decoded"].append(decoded.decode("utf-8", "replace"))
        kinds = {"n_tokens": pa.int64(), "agrees": pa.bool_(), "ids": pa.list_(pa.int32())}
        used = ["n_tokens", "ids_sha256", "decoded_sha256", "agrees"] + ["ids"] * keep_ids + ["decoded"] * keep_text
        return {"doc_id": batch.column("doc_id")} | {k: pa.array(out[k], kinds.get(k, pa.string())) for k in used}

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, agrees boolean"
    schema += ", ids array<int>" * keep_ids + ", decoded string" * keep_text
    return mapped(docs.select("doc_id", "text"), run, schema)


def decode(ids: list[int], path: str) -> str:
    """The text of ids, as the library's ``decode``: control pieces say nothing, bytes are joined to characters."""
    voc = vocabulary(path)
    plain = [i for i in ids if not (voc.library.is_control(i) or voc.library.is_unknown(i))]
    text = voc.decoded(plain).decode("utf-8", "replace")
    return text[1:] if plain and plain[0] not in voc.byte_of and text.startswith(" ") else text
