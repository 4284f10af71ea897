from __future__ import annotations

import base64
import gzip
import hashlib
import random

from cartlake.llm import queries, warc
from cartlake.llm.common import table

SF = "/root/testdata/sf0.001"
PAGES = "page_id bigint, url string, html string, payload string, record string"


def brute(rows):
    last = {}
    for page_id, html in rows:
        if page_id is not None:
            last[html or ""] = max(page_id, last.get(html or "", page_id))
    out = []
    for page_id, html in rows:
        data = (html or "").encode()
        revisit = page_id is not None and last[html or ""] != page_id
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", last[html or ""] if revisit else None))
    return sorted(out, key=repr)


def test_query_against_brute_force(spark):
    rows = [(r.page_id, r.html) for r in table(spark, SF, "pages").collect()]
    assert sorted(map(tuple, queries.QUERIES["op3_warc"](spark, SF).collect()), key=repr) == brute(rows)


def test_odd_pages(spark, tmp_path):
    rows = [(1, None, "same"), (2, "http://x/ü \r\nEvil: 1", "same"), (3, "u", None), (4, "u", ""), (None, "u", "same"), (5, None, "WARC/1.1\r\n\r\n\x1f"), (5, None, "other"), (6, "", "é" * 400_000), (7, "u", "last"), (7, "u", "last")]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], PAGES)
    folder = str(tmp_path / "out")
    got = warc.round_trip(df, folder)
    assert sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr) == brute([(r[0], r[2]) for r in rows])
    payloads = {r.page_id: bytes(r.payload).decode() for r in got.where("record_type = 'response'").collect()}
    assert payloads[6] == "é" * 400_000 and payloads[2] == "same"
    for path in (tmp_path / "out").glob("*.txt"):  # any gzip reader reads the archives
        assert gzip.decompress(path.read_bytes()).startswith(b"WARC/1.1\r\n")


def test_small_payloads_are_all_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "same", "", ""), (2, "u", "same", "", ""), (3, "u", "longer one", "", ""), (4, "u", "longer one", "", "")], PAGES)
    warc.write(df, str(tmp_path / "out"), least_bytes=5)
    got = {r.page_id: r.record_type for r in warc.read(spark, str(tmp_path / "out")).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_empty_table(spark, tmp_path):
    assert warc.round_trip(spark.createDataFrame([], PAGES), str(tmp_path / "out")).count() == 0


def ids(data):
    return [(f.heads["warc-record-id"][-2:-1] if f.reason is None else "gap") for f in warc.salvage(data)]


def test_salvage_compressed_and_plain():
    plain = [warc.record(k, "u", f"payload {k} ".encode() * 50, None, False) for k in range(5)]
    members = [warc.compressed(p) for p in plain]
    assert ids(b"".join(members)) == ids(b"".join(plain)) == ["0", "1", "2", "3", "4"]
    broken = bytearray(members[1])
    broken[40] ^= 255
    data = members[0] + bytes(broken) + members[2] + b"noise" + members[3] + members[4][:-9]
    assert ids(data) == ["0", "gap", "2", "gap", "3", "gap"]
    found = list(warc.salvage(data))
    assert found[1].start == len(members[0]) and found[1].end == len(members[0]) + len(broken)
    flipped = plain[1].replace(b"payload 1", b"payload 9", 1)
    assert ids(plain[0] + flipped + plain[2] + plain[3][:-30] + plain[4]) == ["0", "gap", "2", "gap", "4"]
    assert ids(b"") == [] and ids(b"only noise") == ["gap"]
    assert ids(warc.compressed(plain[0] + flipped + plain[2])) == ["0", "gap", "2"]


def test_gaps_and_records_cover_every_byte():
    rng = random.Random(7)
    members = [warc.compressed(warc.record(k, None, rng.randbytes(300), None, False)) for k in range(20)]
    data = bytearray(b"".join(members))
    for _ in range(6):
        data[rng.randrange(len(data))] ^= 1 + rng.randrange(255)
    at = 0
    for f in warc.salvage(bytes(data)):
        assert f.start == at and f.end > at
        at = f.end
    assert at == len(data)


def test_gaps_are_logged(spark, tmp_path):
    warc.write(spark.createDataFrame([(k, "u", f"page {k}", "", "") for k in range(30)], PAGES).coalesce(1), str(tmp_path / "out"))
    (path,) = (tmp_path / "out").glob("*.txt")
    data = bytearray(path.read_bytes())
    data[600] ^= 255
    path.write_bytes(data)
    (tmp_path / "out" / f".{path.name}.crc").unlink(missing_ok=True)
    rows = warc.read(spark, str(tmp_path / "out")).collect()
    gaps = [r for r in rows if r.reason]
    assert len(gaps) == 1 and gaps[0].start <= 600 < gaps[0].end and gaps[0].payload is None and len(rows) == 30
