"""WARC archives: writing with revisit records, and a splittable reader."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.session import materialize

# Payloads of fewer bytes are always stored.
LEAST_REVISIT = 1000

MAGIC = b"\x1f\x8b\x08"
# The writer ends each row with a zero byte, which gzip readers skip between members.
_SEPARATOR = "\x00"

_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _name(page: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"" if page is None else str(page).encode())


def _page(name: bytes) -> int | None:
    digits = name.removeprefix(b"<urn:page:").removesuffix(b">")
    return int(digits) if digits else None


def member(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record as a gzip member."""
    block = _HTTP if revisit else _HTTP + payload
    lines = [
        b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: " + _name(page),
        b"WARC-Date: 1970-01-01T00:00:00Z", b"WARC-Payload-Digest: sha1:" + digest.encode(), b"X-Payload-Length: %d" % len(payload),
    ]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], url.encode()))
    if revisit:
        lines += [b"WARC-Profile: " + _PROFILE, b"WARC-Refers-To: " + _name(refers_to)]
    lines += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block), b"", b""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(lines) + block + b"\r\n\r\n") + packer.flush()


def parse(record: bytes) -> dict:
    """The fields of one decoded record; an unknown form or a wrong digest raises."""
    head, found, rest = record.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
    block = rest[: int(fields[b"content-length"])]
    if len(block) != int(fields[b"content-length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a WARC record has another length than it says")
    payload = block.partition(b"\r\n\r\n")[2]
    kind = fields[b"warc-type"].decode()
    digest = fields[b"warc-payload-digest"].removeprefix(b"sha1:").decode()
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("a WARC record's payload does not match its digest")
    uri = fields.get(b"warc-target-uri")
    return {
        "page_id": _page(fields[b"warc-record-id"]), "url": None if uri is None else uri.decode(), "record_type": kind,
        "payload_bytes": len(payload) if kind == "response" else int(fields[b"x-payload-length"]), "payload_digest": digest,
        "refers_to": _page(fields[b"warc-refers-to"]) if kind == "revisit" else None, "payload": payload if kind == "response" else None,
    }


def decided(pages: DataFrame, least: int = LEAST_REVISIT, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as (page_id, url, html, digest, refers_to, revisit): which record stores a payload, and which refer to it.

    Of pages with equal payloads of at least ``least`` bytes, the one with the largest id is stored. Rows that repeat that id are
    stored too; rows with NULL id refer to it, and are stored if no row of the group has an id.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")
    ).withColumns({"digest": F.sha1("html"), "key": F.sha2("html", 256), "size": F.octet_length("html")})
    groups = rows.where(F.col("size") >= least).groupBy("key").agg(F.count("*").alias("n"), F.max("page_id").alias("largest")).where("n > 1")
    # Groups of several pages only, so that pages with a payload of their own need no partner.
    stored = materialize(groups.select(F.col("key").alias("shared"), "largest"), "payloads")
    joined = rows.join(stored, F.col("key") == F.col("shared"), "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.select("page_id", "url", "html", "digest", F.when(revisit, F.col("largest")).alias("refers_to"), revisit.alias("revisit"))


def write_archive(pages: DataFrame, path: str, least: int = LEAST_REVISIT, **names) -> None:
    """Write a WARC record per page below ``path``, a gzip member each, files dealt like the pages' partitions.

    NULL html is an empty payload, a NULL url is left out, white space and control characters of a url are
    percent-encoded. Spark's writer stores the bytes, so the path may be in any store Spark reaches.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, url, html, digest, refers, revisit = (batch.column(i) for i in range(6))
            html = html.cast(pa.large_binary())
            out = [
                member(page[i].as_py(), url[i].as_py(), html[i].as_py(), digest[i].as_py(), refers[i].as_py(), revisit[i].as_py())
                for i in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    rows = decided(pages, least, **names).mapInArrow(pack, "value binary").select(F.col("value").cast("string"))
    rows.write.option("encoding", "ISO-8859-1").option("lineSep", _SEPARATOR).text(path)


def _is_record(content: bytes) -> bool:
    return content.startswith(b"WARC/")


def inflate(data: bytes) -> tuple[str, bytes]:
    """Decode a gzip member: done, more (it ends too early) or bad; and the content if done."""
    reader = zlib.decompressobj(31)
    try:
        content = reader.decompress(data)
    except zlib.error:
        return "bad", b""
    if not reader.eof:
        return "more", b""
    return ("done", content) if not reader.unused_data.strip(b"\x00") else ("bad", b"")


def members_of_range(pieces: Iterator[bytes], at_start: bool, valid: Callable[[bytes], bool] = lambda content: True) -> Iterator[tuple[str, bytes]]:
    """Members that begin in a byte range, from its pieces between occurrences of the magic bytes.

    Yields ("record", content) for each decoded member. The magic bytes may also occur inside a member: a candidate that does
    not decode, or whose content is not ``valid``, is no member, and belongs to the one before it. What belongs to a
    member that began before the range comes as ("part", raw), and so does a last member that goes on behind the range's
    last piece. Bytes ahead of the first magic of a file are junk and raise, as does a member that cannot be decoded.
    """
    held: list[bytes] = []  # candidates that are no whole member yet
    began = at_start  # whether the next candidate starts a member for certain
    for n, piece in enumerate(pieces):
        if n == 0 and at_start:
            if piece.strip(b"\x00"):
                raise ValueError("an archive does not begin with a gzip member")
            continue
        held.append(MAGIC + piece)
        for first in range(1 if began else len(held)):
            state, content = inflate(b"".join(held[first:]))
            if state == "done" and (began or valid(content)):
                yield from (("part", p) for p in held[:first])
                yield "record", content
                held, began = [], True
                break
            if state == "bad" and began:
                raise ValueError("a gzip member cannot be decoded")
    yield from (("part", p) for p in held)


def stitched(parts: list[bytes]) -> Iterator[bytes]:
    """Contents of members from their parts in file order."""
    pending = b""
    for part in parts:
        pending += part
        state, content = inflate(pending)
        if state == "done":
            pending = b""
            yield content
    if pending:
        raise ValueError("an archive ends inside a gzip member")


_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ("file", pa.string()), ("start", pa.int64()), ("n", pa.int32()), ("part", pa.binary()),
])


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives below ``path``: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload.

    Each task scans a byte range of a file: Spark's line reader with the gzip magic as line end cuts the range at every
    candidate, and gives a task the candidates that start inside. Candidates are validated by decoding. Parts of a member that false
    candidates cut across a range's end are put together per file afterwards; there are hardly any. File names may end in
    anything but .gz and the like, which Spark would unpack as a whole. Revisit records have no payload of their own (NULL); a broken
    archive raises. ``payloads=False`` leaves the bytes out.
    """
    pieces = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("ISO-8859-1")).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = ((f, s, v) for b in batches for v, f, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()))
        row = next(stream, None)
        while row is not None:
            file, start, value = row
            following = [None]

            def own(value=value, key=(file, start), following=following):
                yield value
                for f, s, v in stream:
                    if (f, s) != key:
                        following[0] = (f, s, v)
                        return
                    yield v

            rows, size = [], 0
            for n, (kind, content) in enumerate(members_of_range(own(), start == 0, _is_record)):
                if kind == "record":
                    fields = parse(content)
                    rows.append(fields if payloads else fields | {"payload": None})
                else:
                    rows.append({"file": file, "start": start, "n": n, "part": content})
                size += len(content)
                if len(rows) >= 1000 or size > 1 << 23:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
            row = following[0]

    schema = RECORD + ", file string, start long, n int, part binary"
    scanned = pieces.mapInArrow(scan, schema)
    if payloads:
        whole = scanned
    else:
        whole = materialize(scanned, "records")
    fields = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]

    def mend(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["start", "n"])
        out = pd.DataFrame([parse(c) for c in stitched(frame["part"].tolist())], columns=fields)
        return (out if payloads else out.assign(payload=None)).astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    mended = whole.where("part is not null").select("file", "start", "n", "part").groupBy("file").applyInPandas(mend, RECORD)
    return whole.where("part is null").select(*fields).unionByName(mended)
