"""Legacy ARC archives, their conversion to WARC, and reading WARC back (operator 3).

An ARC file opens with a version block that names the fields of its record lines: version 1 has url,
address, date, type and length, version 2 has ten fields. Records are found by their declared
lengths alone, never by searching. The converter turns each ARC file into one WARC file: ids are
made from the record's content and place, so a task that runs again writes the same; dates, types and
SHA-1 digests are those the record implies. Of equal payloads one is stored, the others revisit it.

Archives are files of the shared folder, compressed, written by Spark's text writer: a row is one
archive, closed at a record's end once it has ``ARCHIVE_BYTES``. So a file exceeds that by one
record at most, and no record needs another file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.batches import slices

#: Bytes after which an archive is closed.
ARCHIVE_BYTES = 16 << 20
#: The field names of the two versions' record lines.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: [
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code",
        "Checksum", "Location", "Offset", "Filename", "Archive-length",
    ],
}
#: Fixed value: the profile of a record that repeats an earlier payload.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The header that carries the row's id through both formats.
ROW_ID = "X-Row-Id"
NOWHERE = "0.0.0.0"
END = b"\r\n"


class Capture(NamedTuple):
    """A record of an ARC file."""

    offset: int
    url: str
    address: str
    date: str
    status: str
    head: bytes
    payload: bytes
    row_id: int | None


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_of(head: bytes, name: str) -> str | None:
    """The value of a header line; the first if there are several."""
    wanted = name.lower().encode()
    for line in head.split(END)[1:]:
        field, found, value = line.partition(b":")
        if found and field.strip().lower() == wanted:
            return value.strip().decode("utf-8", "replace")
    return None


# -- ARC ------------------------------------------------------------------------------------------


def arc_opening(version: int, name: str, date: str) -> bytes:
    """The version block; its declared length covers the lines below its own."""
    body = f"{version} 0 tessera\n{' '.join(ARC_FIELDS[version])}\n".encode()
    own = ["filedesc://" + name, NOWHERE, date, "text/plain"]
    if version == 2:
        own += ["200", "-", "-", "0", name]
    return " ".join([*own, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_record(version: int, offset: int, name: str, date: str, row_id: int | None, url: str | None, payload: bytes) -> bytes:
    """A record whose document is an HTTP response with ``payload`` as its body."""
    where = "".join("%%%02X" % ord(c) if c.isspace() or ord(c) < 32 else c for c in url or "") or "unknown:"
    lines = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload)]
    if row_id is not None:
        lines.append(f"{ROW_ID}: {row_id}".encode())
    document = END.join([*lines, b"", payload])
    own = [where, NOWHERE, date, "text/html"]
    if version == 2:
        own += ["200", payload_digest(payload), "-", str(offset), name]
    return " ".join([*own, str(len(document))]).encode() + b"\n" + document + b"\n"


def arc_captures(data: bytes) -> Iterator[Capture]:
    """The records of an ARC file of either version, without its version block."""
    at, fields = 0, []
    while at < len(data):
        if data[at : at + 1] == b"\n":
            at += 1  # the line end that closes a record
            continue
        stop = data.index(b"\n", at)
        parts = data[at:stop].decode("utf-8").split(" ")
        body = data[stop + 1 : stop + 1 + int(parts[-1])]
        if len(body) != int(parts[-1]):
            raise ValueError(f"the record at {at} declares {parts[-1]} bytes, {len(body)} are left")
        if parts[0].startswith("filedesc:"):
            first, names = body.decode("utf-8").split("\n")[:2]
            version = int(first.split(" ")[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} is unknown")
            fields = names.split(" ")
        else:
            if len(parts) != len(fields):
                raise ValueError(f"the record line at {at} has {len(parts)} fields, not {len(fields)}")
            record = dict(zip(fields, parts))
            head, _, payload = body.partition(END + END)
            row_id = header_of(head, ROW_ID)
            yield Capture(
                at, record["URL"], record["IP-address"], record["Archive-date"],
                record.get("Result-code", head.split(b" ", 2)[1].decode() if b" " in head else "-"),
                head, payload, None if row_id is None else int(row_id),
            )
        at = stop + 1 + len(body)


def write_arc(pages: DataFrame, path: str, date: str, key: str, url: str, html: str) -> None:
    """One ARC record per row, in files of both versions below ``path``."""

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size, name, version = 0, [], 0, "", 1
        for part in slices(batches):
            for row_id, where, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                if not held:
                    version, name = 1 + number % 2, f"pages-{number:05d}.arc"
                    held, number = [arc_opening(version, name, date)], number + 1
                    size = len(held[0])
                held.append(arc_record(version, size, name, date, row_id, where, (text or "").encode()))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield one_row(held)
                    held = []
        if held:
            yield one_row(held)

    rows = pages.select(F.col(key).cast("long"), F.col(url).cast("string"), F.col(html).cast("string"))
    save_archives(rows.mapInArrow(archives, "archive string"), path)


def one_row(pieces: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b"".join(pieces).decode()], pa.string())], names=["archive"])


def save_archives(archives: DataFrame, path: str) -> None:
    archives.write.option("compression", "gzip").option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def load_archives(like: DataFrame, path: str) -> DataFrame:
    """``path`` and ``content`` of every archive."""
    return like.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def unpacked(content: bytes) -> bytes:
    return zlib.decompress(content, wbits=47)  # gzip or zlib


# -- WARC -----------------------------------------------------------------------------------------


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", *(f"{name}: {value}".encode() for name, value in [*fields, ("Content-Length", str(len(block)))])]
    return END.join([*lines, b"", block]) + END + END


def record_id(*parts: object) -> str:
    """The same parts give the same id."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(map(str, parts)))}>"


def iso_date(date: str) -> str:
    """14 digits (older archives have 12) as a WARC date."""
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_of(name: str, data: bytes, firsts: dict[int, tuple[str, int, int | None]]) -> bytes:
    """The WARC file of an ARC file. ``firsts``: for each offset that repeats a payload, where the
    stored one is (file, offset, row id)."""
    captures = arc_captures(data)
    date = "-"
    records = []
    for c in captures:
        if not records:
            date = c.date
            body = b"software: tessera\r\nformat: WARC File Format 1.1\r\n"
            records.append(
                warc_record(
                    [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("warcinfo", name)), ("WARC-Date", iso_date(date)), ("Content-Type", "application/warc-fields")],
                    body,
                )
            )
        fields = [
            ("WARC-Record-ID", record_id(name, c.offset)), ("WARC-Date", iso_date(c.date)), ("WARC-Target-URI", c.url),
            ("WARC-IP-Address", c.address), ("WARC-Payload-Digest", f"sha1:{payload_digest(c.payload)}"),
            ("Content-Type", "application/http; msgtype=response"),
        ]
        first = firsts.get(c.offset)
        if first is None:
            block = c.head + END + END + c.payload
            records.append(warc_record([("WARC-Type", "response"), *fields], block))
        else:
            to = [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(first[0], first[1]))]
            if first[2] is not None:
                to.append(("X-Refers-To-Row", str(first[2])))
            records.append(warc_record([("WARC-Type", "revisit"), *fields, *to], c.head + END + END))
    return b"".join(records)


def warc_records(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Header and block of every record, found by the declared lengths."""
    at = 0
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        stop = data.index(END + END, at)
        head = data[at:stop]
        length = int(header_of(head, "Content-Length") or 0)
        yield head, data[stop + 4 : stop + 4 + length]
        at = stop + 4 + length


def convert(arcs: DataFrame, path: str, revisit_from: int = 0) -> None:
    """Write the WARC files of ``arcs`` (``path``, ``content``) below ``path``.

    Of records with equal payloads of at least ``revisit_from`` bytes, the one with the smallest row
    id (a null id comes last, then the place decides) is stored as a response, the others revisit it.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = [
                    (name, c.offset, c.row_id, payload_digest(c.payload))
                    for c in arc_captures(unpacked(content.as_py()))
                    if len(c.payload) >= revisit_from
                ]
                columns = list(zip(*found)) or [[]] * 4
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], names=["path", "offset", "row_id", "digest"]
                )

    seen = arcs.mapInArrow(keys, "path string, offset long, row_id long, digest string")
    order: Column = F.struct(F.col("row_id").isNull().alias("none"), "row_id", "path", "offset")
    stored = seen.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    repeats = (
        seen.join(stored, "digest")
        .where((F.col("path") != F.col("first.path")) | (F.col("offset") != F.col("first.offset")))
        .groupBy("path")
        .agg(F.collect_list(F.struct("offset", "first.path", "first.offset", "first.row_id")).alias("repeats"))
    )

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                firsts = {r["c0"]: (r["c1"], r["c2"], r["c3"]) for r in found or []}
                yield one_row([warc_of(name, unpacked(content.as_py()), firsts)])

    renamed = F.col("repeats").cast("array<struct<c0:bigint,c1:string,c2:bigint,c3:bigint>>").alias("repeats")
    joined = arcs.join(repeats, "path", "left").select("path", "content", renamed)
    save_archives(joined.mapInArrow(files, "archive string"), path)


def read_warc(warcs: DataFrame) -> DataFrame:
    """``page_id, url, date, payload_bytes, payload_digest, record_type, refers_to, payload`` per record.

    A response whose payload does not match its declared digest is an error. Revisits have no payload.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {
            "page_id": pa.int64(), "url": pa.string(), "date": pa.string(), "payload_bytes": pa.int64(),
            "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(),
        }
        for batch in batches:
            for content in batch.column(1):
                out: list[tuple] = []
                for head, block in warc_records(unpacked(content.as_py())):
                    kind = header_of(head, "WARC-Type")
                    if kind not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(END + END)
                    digest = header_of(head, "WARC-Payload-Digest").removeprefix("sha1:")
                    if kind == "response" and payload_digest(payload) != digest:
                        raise ValueError(f"{header_of(head, 'WARC-Record-ID')} does not match its digest")
                    row_id, to = header_of(http, ROW_ID), header_of(head, "X-Refers-To-Row")
                    out.append(
                        (
                            None if row_id is None else int(row_id), header_of(head, "WARC-Target-URI"), header_of(head, "WARC-Date"),
                            len(payload) if kind == "response" else int(header_of(http, "Content-Length")),
                            digest, kind, None if to is None else int(to), payload if kind == "response" else None,
                        )
                    )
                columns = list(zip(*out)) or [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], names=list(kinds))

    return warcs.mapInArrow(
        rows,
        "page_id long, url string, date string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )


def archive_pages(
    pages: DataFrame, folder: str, date: str = "20200101000000", key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write the rows as ARC files, convert these to WARC files, and read the records back.

    A null html is an empty payload, a null id stays null, a null url becomes ``unknown:``. Repeated
    rows are records of their own: the first of them is the response. An empty table gives no
    records. Other columns are not read. Both sets of files stay below ``folder``.
    """
    write_arc(pages, f"{folder}/arc", date, key, url, html)
    convert(load_archives(pages, f"{folder}/arc"), f"{folder}/warc")
    return read_warc(load_archives(pages, f"{folder}/warc"))


#: The base32 alphabet picks a character for every five of the digest's 160 bits.
SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM p
), b AS (
  SELECT *, list_aggregate(list_transform(range(0, 40), lambda i: lpad(bin(strpos('0123456789abcdef', hex[i + 1]) - 1), 4, '0')), 'string_agg', '') AS bits FROM d
), t AS (
  SELECT *, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (list_sum(list_transform(range(0, 5), lambda j: CASE WHEN bits[i * 5 + j + 1] = '1' THEN (16 >> j) ELSE 0 END)) + 1)::BIGINT, 1)), 'string_agg', '') AS payload_digest,
    min(page_id) OVER (PARTITION BY hex) AS first
  FROM b
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM t
"""
