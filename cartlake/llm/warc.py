"""WARC archives: records written through Spark's text writer, and a salvaging reader.

An archive is a file of gzip members, one per record, each followed by an empty member, which is what the text
writer puts between rows. Any file system that Spark writes to will do, and Spark's committer decides which
attempt of a task counts. Records with equal payloads are stored once: the others are ``revisit`` records.

The reader walks the bytes of an archive. Where a member or a record fails its checks, it looks for the next member
or version line that opens a valid record, goes on there, and logs the gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.llm.common import mapped
from cartlake.session import shared_dir

VERSION = b"WARC/1.1"
_MEMBER = b"\x1f\x8b\x08"
_OPENS = re.compile(rb"WARC/\d\.\d\r\n")
_URN = "urn:cartlake:page:"
#: An empty gzip member, as characters of one byte each: what stands between two records.
BETWEEN = (b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + bytes(8)).decode("latin-1")
#: Records of one archive file; what a reader's task holds at a time.
RECORDS_A_FILE = 2_000


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """An uncompressed record. A revisit has the headers of the response it stands for, and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if is_revisit else http + payload
    heads = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", f"<{_URN}{'' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        heads.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~")))
    if is_revisit:
        heads.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        heads.append(("WARC-Refers-To", f"<{_URN}{refers_to}>"))
    return b"\r\n".join([VERSION, *[f"{k}: {v}".encode() for k, v in heads], b"", block, b"", b""])


def compressed(data: bytes) -> bytes:
    """One gzip member without a time, so that a repeated task writes the same bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """A record for each row of ``pages(page_id, url, html)`` to archives in ``folder``.

    Payload: the html in UTF-8, a null html an empty one. Of the records with equal payloads of ``least_bytes`` or
    more, that with the largest page_id is the response (each of them, where rows repeat that page_id) and the
    others are revisits of it; smaller ones are all responses. A record with a null page_id is a response of its
    own. A null url gives no target header. An empty table gives an empty folder; other columns are ignored.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha", F.sha1("html"))
    last = rows.where("page_id is not null").groupBy("sha", F.octet_length("html").alias("n")).agg(F.max("page_id").alias("last"))
    rows = rows.withColumn("n", F.octet_length("html"))
    known = rows.join(last, ["sha", "n"], "left")

    def run(batch: pa.RecordBatch) -> dict:
        out = []
        for r in batch.to_pylist():
            revisit = r["page_id"] is not None and r["n"] >= least_bytes and r["last"] != r["page_id"]
            out.append(compressed(record(r["page_id"], r["url"], r["html"].encode("utf-8", "surrogatepass"), r["last"], revisit)))
        return {"record": pa.array(out, pa.binary())}

    made = mapped(known.select("page_id", "url", "html", "n", "last"), run, "record binary")
    text = made.select(F.col("record").cast("string").alias("value"))
    text.write.option("lineSep", BETWEEN).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", RECORDS_A_FILE).text(folder)


@dataclass
class Found:
    """A record that passed its checks, or with ``reason`` a quarantined gap of bytes."""

    start: int
    end: int
    reason: str | None = None
    heads: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""
    payload_bytes: int = 0


def _parsed(data: bytes, at: int) -> Found | str:
    """The record that opens at ``at`` of uncompressed bytes, or what is wrong with it."""
    if not _OPENS.match(data, at):
        return "no version line"
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return "headers without an end"
    heads = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "a header without a colon"
        heads[name.decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"\d+", heads.get("content-length", "")):
        return "no content length"
    start, size = end + 4, int(heads["content-length"])
    block = data[start : start + size]
    if len(block) < size or data[start + size : start + size + 4] != b"\r\n\r\n":
        return "the block is cut off"
    if heads.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        return "block digest"
    found = Found(at, start + size + 4, heads=heads)
    if heads.get("content-type", "").startswith("application/http"):
        http, gap, found.payload = block.partition(b"\r\n\r\n")
        length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        if not gap:
            return "no http headers"
        found.payload_bytes = int(length[1]) if length else len(found.payload)
    else:
        found.payload, found.payload_bytes = block, len(block)
    if heads.get("warc-type") != "revisit":
        want = heads.get("warc-payload-digest")
        if want and want != f"sha1:{digest(found.payload)}" or found.payload_bytes != len(found.payload):
            return "payload digest"
    return found


def _member(data: bytes, at: int) -> tuple[bytes, int] | str:
    """The uncompressed bytes of the gzip member at ``at`` and its end; zlib checks its sum."""
    unpacker, view, out, end = zlib.decompressobj(31), memoryview(data), [], at
    try:
        while end < len(data) and not unpacker.eof:
            out.append(unpacker.decompress(view[end : end + 65_536]))
            end += 65_536
    except zlib.error as error:
        return f"gzip: {error}"
    return (b"".join(out), min(end, len(data)) - len(unpacker.unused_data)) if unpacker.eof else "gzip: cut off"


def salvage(data: bytes) -> Iterator[Found]:
    """Records and gaps of an archive, compressed by member or not, in the order of their bytes.

    Offsets are those of the archive; records inside one member share its offsets.
    """
    at, gap, reason = 0, None, ""
    while at < len(data):
        found: list[Found] = []
        if data.startswith(_MEMBER, at):
            member = _member(data, at)
            if not isinstance(member, str):
                inside, end = member
                found, member = _records(inside, at, end)
        else:
            member = _parsed(data, at)
            if isinstance(member, Found):
                found, end, member = [member], member.end, None
        if isinstance(member, str) and not found:
            if gap is None:
                gap, reason = at, member
            later = [x for x in (data.find(_MEMBER, at + 1), _next_version(data, at + 1)) if x >= 0]
            at = min(later, default=len(data))
            continue
        if gap is not None:
            yield Found(gap, at, reason)
            gap = None
        yield from found
        at = end
    if gap is not None:
        yield Found(gap, len(data), reason)


def _next_version(data: bytes, at: int) -> int:
    opens = _OPENS.search(data, at)
    return opens.start() if opens else -1


def _records(inside: bytes, start: int, end: int) -> tuple[list[Found], str | None]:
    """Records of a member. One that fails is a gap with the member's offsets; the search goes on behind it."""
    out, at, wrong = [], 0, None
    while at < len(inside):
        found = _parsed(inside, at)
        if isinstance(found, Found):
            at, found.start, found.end = found.end, start, end
            out.append(found)
            continue
        wrong = wrong or found
        if not out or out[-1].reason is None:
            out.append(Found(start, end, found))
        at = _next_version(inside, at + 1)
        if at < 0:
            break
    return out, None if any(f.reason is None for f in out) or not wrong else wrong


def read(spark, folder: str) -> DataFrame:
    """Records and gaps of all archives in ``folder``.

    ``archive``, ``start``, ``end`` (bytes), ``reason`` (of a gap, else null), ``record_type``, ``page_id``, ``url``,
    ``payload`` (null for gaps and revisits), ``payload_bytes`` and ``payload_digest`` of the full payload, and
    ``refers_to`` (the response's page_id, for revisits).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select("path", "content")
    number = lambda text: int(m[1]) if (m := re.search(r":(-?\d+)>?$", text or "")) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path"), batch.column("content")):
                rows, size = [], 0
                for f in salvage(data.as_py()):
                    revisit, ok = f.heads.get("warc-type") == "revisit", f.reason is None
                    rows.append(
                        {
                            "archive": path.as_py(), "start": f.start, "end": f.end, "reason": f.reason, "record_type": f.heads.get("warc-type"),
                            "page_id": number(f.heads.get("warc-record-id")), "url": f.heads.get("warc-target-uri"),
                            "payload": f.payload if ok and not revisit else None, "payload_bytes": f.payload_bytes if ok else None,
                            "payload_digest": f.heads.get("warc-payload-digest", "").removeprefix("sha1:") or None if ok else None,
                            "refers_to": number(f.heads.get("warc-refers-to")) if revisit else None,
                        }
                    )
                    size += len(f.payload)
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, _READ)

    return files.mapInArrow(
        run,
        "archive string, start bigint, end bigint, reason string, record_type string, page_id bigint, url string, "
        "payload binary, payload_bytes bigint, payload_digest string, refers_to bigint",
    )


_READ = pa.schema(
    [("archive", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64())]
    + [("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the pages to ``folder`` (default: one of the shared folder) and reads the records back."""
    folder = folder or shared_dir(pages.sparkSession, "warc")
    write(pages, folder)
    return read(pages.sparkSession, folder).where("reason is null")
