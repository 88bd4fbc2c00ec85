"""Legacy ARC archives converted to WARC: declared lengths, synthesised ids, times, types and digests."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from datetime import datetime
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import query, table
from lexmill.llm.files import as_batches, packed, read_files, write_files
from lexmill.session import scratch_path, stage

#: Fields of a record's header line by the version that the archive's first record declares.
ARC_FIELDS = {
    b"1": ("url", "ip", "date", "content_type", "length"),
    b"2": ("url", "ip", "date", "content_type", "status", "checksum", "location", "offset", "filename", "length"),
}
_ARC_NAMES = {
    b"1": b"URL IP-address Archive-date Content-type Archive-length",
    b"2": b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE, _REFERS = "X-Page-Id", "X-Refers-To-Page-Id"


class ArcRecord(NamedTuple):
    url: str
    ip: str
    date: str
    content_type: str
    block: bytes


def zipped(record: bytes) -> bytes:
    """A record as a gzip member of its own, as both formats have it."""
    return gzip.compress(record, 1, mtime=0)


def unzipped(content: bytes) -> bytes:
    """The records of a file, gzipped or not; the line feed after the last gzip member goes."""
    if content[:2] != b"\x1f\x8b":
        return content
    return gzip.GzipFile(fileobj=io.BytesIO(content.removesuffix(b"\n"))).read()


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------- ARC


def _arc_line(version: bytes, url: str, date: str, content_type: str, length: int) -> bytes:
    middle = " 200 - - 0 -" if version == b"2" else ""
    return f"{url} 0.0.0.0 {date} {content_type}{middle} {length}\n".encode()


def arc_head(version: bytes, name: str, date: str) -> bytes:
    """The version block that opens an ARC file."""
    body = version + b" 0 lexmill\n" + _ARC_NAMES[version] + b"\n"
    return _arc_line(version, f"filedesc://{name}", date, "text/plain", len(body)) + body + b"\n"


def arc_record(version: bytes, page_id: int | None, url: str | None, html: bytes, date: str) -> bytes:
    """One page as an ARC record; white space and control characters in a URL are percent-encoded, a missing URL is urn:page:id."""
    url = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n"
        f"{_PAGE}: {'' if page_id is None else page_id}\r\n\r\n").encode() + html
    return _arc_line(version, url, date, "text/html", len(block)) + block + b"\n"


def parse_arc(content: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file in order, the version block left out.

    The first record's body names the version, which fixes the fields of every header
    line; a body is taken by its declared length, whatever it holds. Line feeds
    between records are passed over. Raises on a header that does not fit.
    """
    at, fields = 0, None
    while True:
        while content[at:at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(content):
            return
        end = content.index(b"\n", at)
        line = content[at:end].decode().split(" ")
        if fields is None:
            size = int(line[-1])
            version = content[end + 1:end + 1 + size].split(b" ", 1)[0]
            fields = ARC_FIELDS[version]
        elif len(line) != len(fields):
            raise ValueError(f"header at byte {at} has {len(line)} fields instead of {len(fields)}")
        else:
            head = dict(zip(fields, line))
            size = int(head["length"])
            yield ArcRecord(head["url"], head["ip"], head["date"], head["content_type"], content[end + 1:end + 1 + size])
        if end + 1 + size > len(content):
            raise ValueError(f"record at byte {at} is shorter than declared")
        at = end + 1 + size


def write_arc(pages: DataFrame, id: str, url: str, html: str, path: str, date: str = "20240101000000") -> None:
    """Pages as ARC files, of version 1 and 2 in turn. Null html is empty."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = lambda number: (b"1", b"2")[number % 2]
        for part, batch in enumerate(batches):
            rows = zip(batch.column(0), batch.column(1), batch.column(2).cast(pa.large_binary()))
            records = (zipped(arc_record(version(part), i.as_py(), u.as_py(), h.as_py() or b"", date)) for i, u, h in rows)
            yield from as_batches(packed(records, lambda number, part=part: zipped(arc_head(version(part), f"{part}-{number}.arc.gz", date))))

    write_files(pages.select(F.col(id).cast("long"), F.col(url).cast("string"), F.col(html)).mapInArrow(write, "content binary"), path)


# ---------------------------------------------------------------- WARC


def record_id(page_id: int | None, digest: str) -> str:
    """The same page always gets the same identifier."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'urn:page:{page_id}:{digest}')}>"


def _headers(pairs: list[tuple[str, object]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in pairs) + "\r\n").encode()


def _iso(date: str) -> str:
    return datetime.strptime(date[:14].ljust(14, "0"), "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def warc_info(name: str) -> bytes:
    body = b"software: lexmill\r\nformat: WARC File Format 1.1\r\n"
    return _headers([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"), ("WARC-Date", "2024-01-01T00:00:00Z"),
                     ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", len(body))]) + body + b"\r\n\r\n"


def warc_record(url: str, ip: str, date: str, page_id: int | None, digest: str, refers_to: int | None, http: bytes, payload: bytes) -> bytes:
    """A response with its payload or, where `refers_to` is given, a revisit with the HTTP headers alone."""
    block = http + payload if refers_to is None else http
    pairs = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", _iso(date)), ("WARC-Target-URI", url), ("WARC-IP-Address", ip),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
    ]
    if refers_to is not None:
        pairs += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), (_REFERS, refers_to)]
    pairs += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    return _headers(pairs) + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record; raises if a block is cut short or its digest does not fit."""
    at = 0
    while (at := content.find(b"WARC/", at)) >= 0:
        end = content.index(b"\r\n\r\n", at)
        head = _fields(content[at:end])
        size = int(head["content-length"])
        block = content[end + 4:end + 4 + size]
        if len(block) < size or head.get("warc-block-digest", "sha1:" + base32_sha1(block)) != "sha1:" + base32_sha1(block):
            raise ValueError(f"damaged record at byte {at}")
        yield head, block
        at = end + 4 + size


_PARSED = "page_id long, url string, ip string, date string, digest string, http binary, payload binary"


def _read_arc(spark: SparkSession, path: str, with_payload: bool) -> DataFrame:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in _PARSED.split(", ")]

    def rows(content: bytes) -> Iterator[tuple]:
        for r in parse_arc(unzipped(content)):
            http, blank, payload = r.block.partition(b"\r\n\r\n")
            page = _fields(http).get(_PAGE.lower(), "")
            yield (int(page) if page else None, r.url, r.ip, r.date, base32_sha1(payload), *((http + blank, payload) if with_payload else (None, None)))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                if found := list(rows(content.as_py())):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names)

    return read_files(spark, path).select("content").mapInArrow(parse, _PARSED)


def arc_to_warc(spark: SparkSession, source: str, target: str, min_bytes: int = 0) -> None:
    """Converts the ARC files under `source` to WARC files under `target`.

    Of records with equal payloads of at least `min_bytes` bytes the one with the smallest page
    id (or all that share that id) is a response and the others are revisits that
    refer to it; a record without page id is never the smallest, and is a
    response if none of its equals has an id. Pages come from the X-Page-Id
    header of a record's HTTP response.

    The archives are read twice: once for a table of the digests that occur
    more than once, then for the payloads, which meet that table by digest. A
    digest that many pages share is one row of the table, and Spark splits the other side.
    """
    slim = _read_arc(spark, source, False).select("page_id", "digest")
    shared = slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = stage(shared.where((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first"), "shared-digests")
    parsed = _read_arc(spark, source, True).join(shared, "digest", "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.length("payload") >= min_bytes)
    ready = parsed.select("url", "ip", "date", "page_id", "digest", F.when(other, F.col("first")).alias("refers_to"), "http", "payload")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (zipped(warc_record(*(v.as_py() for v in row))) for batch in batches for row in zip(*batch.columns))
        return as_batches(packed(records, lambda number: zipped(warc_info(f"{number}.warc.gz"))))

    write_files(ready.mapInArrow(write, "content binary"), target)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, date, payload_bytes, payload_digest, record_type, refers_to of each page's record.

    The length of a revisit's payload is that of its HTTP header.
    """
    schema = "page_id long, url string, date string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def rows(content: bytes) -> Iterator[tuple]:
        for head, block in parse_warc(unzipped(content)):
            if head["warc-type"] not in ("response", "revisit"):
                continue
            http, _, payload = block.partition(b"\r\n\r\n")
            fields = _fields(http)
            page, refers = fields.get(_PAGE.lower(), ""), head.get(_REFERS.lower(), "")
            size = len(payload) if head["warc-type"] == "response" else int(fields["content-length"])
            digest = head["warc-payload-digest"].removeprefix("sha1:")
            yield (int(page) if page else None, head["warc-target-uri"], head["warc-date"], size, digest, head["warc-type"], int(refers) if refers else None)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                if found := list(rows(content.as_py())):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], [c.split()[0] for c in schema.split(", ")])

    return read_files(spark, path).select("content").mapInArrow(parse, schema)


_BASE32 = "list_reduce(list_transform(range(8), lambda j: list_reduce(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * j::int + 1, 5))::int >> s) & 31) + 1, 1)), lambda a, b: a || b)), lambda a, b: a || b)"


@query("op8_warc", f"""with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as h from pages),
f as (select *, min(page_id) over (partition by h) as first from p)
select page_id, payload_bytes, {_BASE32} as payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to from f""")
def op8_warc(spark, sf):
    """All pages through ARC files to WARC files, and what is read back from those."""
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(table(spark, sf, "pages"), "page_id", "url", "html", arc)
    arc_to_warc(spark, arc, warc)
    return read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
