from __future__ import annotations

import hashlib
import random

import numpy as np
import sentencepiece

from cartlake.llm import pieces, queries, token_counts
from cartlake.llm.common import table

SF = "/root/testdata/sf0.001"
PATH = pieces.model_path()
DOCS = "doc_id bigint, text string, n_tokens int, ids string"
PARTS = ["a", "the", " ", "  ", "\n", "▁", "日本", "é", "\u0000", "<s>", "</s>", "<0x0A>", "zzz", "x" * 60, "\t", "ing", "�", "😀", "aaaa", "\r\n", ".", " . ", "_.", "m²."]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 14))) for _ in range(n)]


def test_encoding_query_against_library(spark):
    lib = library()
    want = {}
    for r in table(spark, SF, "documents").collect():
        ids = lib.encode(r.text or "", add_bos=True, add_eos=True)
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest(), True)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.agrees) for r in queries.QUERIES["op6_sentencepiece"](spark, SF).collect()}
    assert got == want


def test_odd_texts_are_encoded_and_decoded_as_by_the_library():
    lib = library()
    for text, (ids, decoded, agrees) in zip(odd_texts(1500, 1), pieces.encode_batch(odd_texts(1500, 1), PATH)):
        want = lib.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want and agrees
        assert decoded.decode() == lib.decode(want) == pieces.decode([1, *want, 2], PATH)


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 5)
    texts, lib = odd_texts(200, 2), library()
    for text, (ids, _, _) in zip(texts, pieces.encode_batch(texts, PATH, slice_chars=50)):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(text)


def test_a_full_cache_of_counts_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT", 5)
    counts, texts, lib = token_counts.PrefixCounts(pieces.vocabulary(PATH)), odd_texts(120, 9), library()
    for at in range(0, len(texts), 6):
        assert counts.totals(texts[at : at + 6]) == [len(lib.encode(t)) for t in texts[at : at + 6]]
        assert counts.at_every_prefix(texts[at])[-1] == len(lib.encode(texts[at]))


def test_side_by_side_and_heap_agree():
    voc = pieces.vocabulary(PATH)
    rng = random.Random(4)
    chunks = ["▁" + "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 40))) for _ in range(500)]
    assert voc.encode_chunks(chunks) == [voc.merged(c) for c in chunks]


def test_where_the_agenda_differs_it_is_told(monkeypatch):
    voc = pieces.vocabulary(PATH)
    monkeypatch.setattr(pieces, "worker_cache", lambda owner, own={}: own)
    monkeypatch.setattr(voc, "encode_chunks", lambda chunks: [[5] for _ in chunks])
    ((ids, decoded, agrees),) = pieces.encode_batch(["plain words\nhere"], PATH)
    assert set(np.frombuffer(ids, "<u4").tolist()) == {5} and decoded != b"plain words\nhere" and not agrees


def test_counts_query_against_library(spark):
    lib = library()
    want = {r.doc_id: (len((r.text or "").encode()), n := len(lib.encode(r.text or "")), n > 4096) for r in table(spark, SF, "documents").collect()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.QUERIES["op4_token_counts"](spark, SF).collect()} == want


def test_every_prefix_count_is_the_librarys(spark):
    lib, counts = library(), token_counts.prefix_counts(PATH)
    texts = odd_texts(150, 3) + [r.text[:400] for r in table(spark, SF, "documents").limit(25).collect()]
    for text in texts:
        assert counts.at_every_prefix(text).tolist() == [len(lib.encode(text[:p])) for p in range(len(text) + 1)]
    assert counts.totals(texts) == [len(lib.encode(t)) for t in texts]


def test_budgets(spark):
    text = "the quick brown fox jumps over the lazy dog " * 3
    lib = library()
    df = spark.createDataFrame([(1, text, 0, ""), (2, None, 0, ""), (3, "", 0, "")], DOCS)
    rows = {r.doc_id: r for r in token_counts.truncated(df, PATH, 10).collect()}
    want = max(p for p in range(len(text) + 1) if len(lib.encode(text[:p])) <= 10)
    assert rows[1].text == text[:want] and rows[1].n_tokens <= 10 and rows[2].text is None and rows[3].text == ""
    table_rows = {r.doc_id: r.counts for r in token_counts.prefix_table(df, PATH).collect()}
    assert table_rows[2] == table_rows[3] == [0] and table_rows[1][-1] == len(lib.encode(text))


def test_odd_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert token_counts.counted(empty, PATH).count() == pieces.encoded(empty, PATH).count() == 0
    rows = [(None, None, 1, "x"), (1, "a b", 1, "x"), (1, "a b", 1, "x"), (2, "word " * 50_000 + "x" * 30_000, 1, "x")]
    df = spark.createDataFrame(rows, DOCS)
    got = sorted((r.doc_id or 0, r.n_tokens) for r in token_counts.counted(df, PATH).collect())
    lib = library()
    assert got == [(0, 0), (1, 2), (1, 2), (2, len(lib.encode(rows[3][1])))]
    whole = {r.doc_id: (r.n_tokens, r.ids[0], r.ids[-1], r.decoded) for r in pieces.encoded(df, PATH, keep_ids=True, keep_text=True).collect()}
    assert whole[None] == (2, 1, 2, "") and whole[2] == (got[3][1] + 2, 1, 2, rows[3][1])
