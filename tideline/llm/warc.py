"""Converter of legacy ARC archives to WARC, and a table of pages archived and read back.

An ARC file is a run of records, each a header line and as many bytes as the line declares, plain or in gzip members.
Version 1 lines have five fields (URL, IP address, date, content type, length); version 2 lines have ten (URL, IP
address, date, content type, result code, checksum, location, offset, file name, length). The first record,
`filedesc://`, names the version and becomes a `warcinfo` record. A record of a web server's answer holds the whole HTTP
message: it becomes a `response` of type application/http whose block is the message and whose payload digest is that of
the body after its header. Other records (dns and such) become a `resource`. Identifiers are UUIDs of URL, date and
payload digest, timestamps come from ARC dates, digests are SHA-1. A record whose payload another one carries becomes a
`revisit`, whose block is the HTTP header alone and which refers to the other's identifier.

WARC files are runs of gzip members, one for each record, a warcinfo first, written for each partition under the shared
folder and read back by parsing: lengths are declared, digests of blocks and payloads are checked. A page's identifier is
a UUID of version 8 (free form) made of its page_id and digest, so a revisit's page and that of the response it refers to
are read from the identifiers.

Defined cases: header bytes that aren't UTF-8 are percent-encoded; an ARC record that breaks off or has no header line of
its version is an error, or with `strict` off one row that says what is wrong, for the rest of its file; an HTTP message
without an empty line is all header. A null page html is an empty payload; a null or blank URL is archived as `-`, white
space in URLs is percent-encoded; payloads shorter than `least` bytes never become revisits; rows that repeat the
smallest page_id of their payload are all responses; rows without page_id are responses if no row with one has their
payload, else revisits. Very long pages are written whole. Only page_id, url and html are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _common as common

#: Fixed values of the formats.
ARC_VERSIONS = {1: b"URL IP-address Archive-date Content-type Archive-length", 2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
WARC_VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    content_type: str
    payload: bytes
    version: int
    result_code: str = "-"
    checksum: str = "-"
    location: str = "-"
    filename: str = "-"


def arc_bytes(records: list[ArcRecord], version: int, filename: str = "pages.arc") -> bytes:
    """An ARC file of the version with the records."""
    head = b"%d 0 tideline\n%s\n\n" % (version, ARC_VERSIONS[version])
    own = [ArcRecord(f"filedesc://{filename}", "0.0.0.0", records[0].date if records else "19700101000000", "text/plain", head, version, "200", "-", "-", filename), *records]
    out, at = [], 0
    for r in own:
        fields = [r.url, r.ip, r.date, r.content_type]
        if version == 2:
            fields += [r.result_code, r.checksum, r.location, str(at), r.filename]
        out.append(f"{' '.join(fields)} {len(r.payload)}\n".encode() + r.payload + b"\n")
        at += len(out[-1])
    return b"".join(out)


_LINES = {
    1: re.compile(rb"(.+) ([0-9A-Fa-f.:]+|-) (\d{8,17}) (.*) (\d+)"),
    2: re.compile(rb"(.+) ([0-9A-Fa-f.:]+|-) (\d{8,17}) (.*) (\d{3}|-) (\S+) (\S+) (\d+|-) (\S+) (\d+)"),
}


def _text(data: bytes) -> str:
    """A header field's bytes; those of a field that isn't UTF-8 percent-encoded."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        return "".join(chr(b) if b < 0x80 else f"%{b:02X}" for b in data)


def _stream(source: bytes | io.BufferedIOBase) -> io.BufferedIOBase:
    """An ARC or WARC source as a stream, unpacked if it is in gzip members."""
    stream = io.BytesIO(source) if isinstance(source, bytes) else io.BufferedReader(source) if not hasattr(source, "peek") else source
    start = source[:2] if isinstance(source, bytes) else stream.peek(2)[:2]
    return gzip.GzipFile(fileobj=stream) if start == b"\x1f\x8b" else stream


def read_arc(source: bytes | io.BufferedIOBase) -> Iterator[ArcRecord]:
    """All records of an ARC file, the first `filedesc://`, by header lines of its version and declared lengths."""
    stream, version = _stream(source), None
    while line := stream.readline():
        line = line.rstrip(b"\r\n")
        if not line:
            continue
        # The file's own line has the fields that its body names; both versions' lines start and end alike.
        found = _LINES[version].fullmatch(line) if version else line.startswith(b"filedesc://") and (_LINES[2].fullmatch(line) or _LINES[1].fullmatch(line))
        if not found:
            raise ValueError(f"ARC header line of version {version or 'one or two'} expected: {line[:80]!r}")
        fields = [_text(x) for x in found.groups()]
        payload = stream.read(int(fields[-1]))
        if len(payload) != int(fields[-1]):
            raise ValueError(f"the ARC file ends within a record of {fields[-1]} bytes")
        if version is None:
            head = payload.split(b" ", 1)[0]
            version = int(head) if head.isdigit() else None
            if version not in ARC_VERSIONS:
                raise ValueError(f"not an ARC file of a known version: {payload[:80]!r}")
        more = dict(zip(("result_code", "checksum", "location", "_", "filename"), fields[4:9], strict=True)) if len(fields) == 10 else {}
        more.pop("_", None)
        yield ArcRecord(*fields[:4], payload, version, **more)


def http_parts(message: bytes) -> tuple[bytes, bytes]:
    """(header with its empty line, body) of an HTTP message."""
    end = re.search(rb"\r?\n\r?\n", message)
    return (message[: end.end()], message[end.end() :]) if end else (message, b"")


def digest(payload: bytes) -> str:
    """Base32 SHA-1, as archives write it after `sha1:`."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def timestamp(date: str) -> str:
    """An ARC date of 8 to 17 digits as a WARC date, to the second."""
    d = date[:14].ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(name: str, date: str, payload_digest: str) -> str:
    """An identifier that depends on what is archived alone, so others can name the record without reading it."""
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{name} {date} {payload_digest}')}>"


def page_record_id(page_id: int, payload_digest: str) -> str:
    """A page's identifier: a UUID of version 8 with the page_id's 64 bits and the first 58 of the digest."""
    page, mark = page_id & 0xFFFFFFFFFFFFFFFF, int.from_bytes(base64.b32decode(payload_digest)[:8], "big") >> 6
    value = (page >> 16) << 80 | 8 << 76 | (page >> 4 & 0xFFF) << 64 | 2 << 62 | (page & 0xF) << 58 | mark
    return f"<urn:uuid:{uuid.UUID(int=value)}>"


def page_of(identifier: str) -> int | None:
    """The page_id in such an identifier; None for identifiers of other versions."""
    value = uuid.UUID(identifier[10:-1]).int
    if value >> 76 & 0xF != 8:
        return None
    page = (value >> 80) << 16 | (value >> 64 & 0xFFF) << 4 | value >> 58 & 0xF
    return page - (1 << 64) if page >> 63 else page


def warc_record(arc: ArcRecord, revisit_of: str | None = None, identifier: str | None = None) -> bytes:
    """One WARC record of an ARC record: `warcinfo`, `response`, `resource`, or `revisit` of the identifier given."""
    info, web = arc.url.startswith("filedesc://"), arc.payload.startswith(b"HTTP/")
    head, payload = http_parts(arc.payload) if web else (b"", arc.payload)
    named = digest(payload)
    if info:
        origin = _text(payload.split(b"\n", 1)[0])
        block = f"software: tideline\r\nformat: WARC File Format 1.1\r\nconverted-from: ARC version {arc.version}\r\ndescription: {origin}\r\n".encode()
        kind, content = "warcinfo", "application/warc-fields"
    elif revisit_of:
        kind, content, block = "revisit", "application/http;msgtype=response", head
    elif web:
        kind, content, block = "response", "application/http;msgtype=response", arc.payload
    else:
        kind, content, block = "resource", arc.content_type if arc.content_type not in ("", "-") else "application/octet-stream", arc.payload
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": identifier or record_id(arc.url, arc.date, named),
        "WARC-Date": timestamp(arc.date),
        **({"WARC-Filename": arc.url.removeprefix("filedesc://")} if info else {"WARC-Target-URI": arc.url}),
        **({} if info or arc.ip in ("-", "0.0.0.0") else {"WARC-IP-Address": arc.ip}),
        **({} if info else {"WARC-Payload-Digest": f"sha1:{named}"}),
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        **({"WARC-Refers-To": revisit_of, "WARC-Profile": REVISIT_PROFILE} if revisit_of else {}),
        "Content-Type": content,
        "Content-Length": str(len(block)),
    }
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items())
    return b"".join((WARC_VERSION, b"\r\n", lines, b"\r\n", block, b"\r\n\r\n"))


def _member(record: bytes) -> bytes:
    return gzip.compress(record, compresslevel=3, mtime=0)


def _warcinfo(version: int, date: str, name: str) -> bytes:
    body = b"%d 0 tideline\n%s\n" % (version, ARC_VERSIONS[version])
    return _member(warc_record(ArcRecord(f"filedesc://{name}", "0.0.0.0", date, "text/plain", body, version)))


def read_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an uncompressed WARC stream; a block that doesn't fit its digest is an error."""
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"a WARC record expected: {line[:80]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name] = value.strip()
        block = stream.read(int(headers["Content-Length"]))
        if len(block) != int(headers["Content-Length"]) or f"sha1:{digest(block)}" != headers["WARC-Block-Digest"]:
            raise ValueError(f"the record {headers.get('WARC-Record-ID')} is damaged")
        yield headers, block


_UNSAFE = re.compile(r"[\x00-\x20\x7f-\xa0  -     　]")


def safe_url(url: str | None) -> str:
    """A URL for a header line: white space and control characters percent-encoded; `-` if there is none."""
    return _UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "-"


def payload_keys(pages: DataFrame) -> DataFrame:
    """page_id, rid, SHA-1 and length of the payload of each row, written once."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return common.written(pages.select("page_id", "rid", F.sha1(payload).alias("sha1"), F.length(payload).alias("size")), "payloads")


def originals(keys: DataFrame, least: int = 0) -> DataFrame:
    """For payloads (by digest and length) that several rows have: the smallest page_id (`first`) and the number of rows.
    Grouped with partial minima, so a payload that a third of all rows share is a few rows to the exchange."""
    found = keys.filter(F.col("size") >= least).groupBy("sha1", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    return found.filter("n > 1 and first is not null")


def write_archives(pages: DataFrame, folder: str, least: int = 0, version: int = 2, date: str = "20240101000000") -> DataFrame:
    """Archives every row of pages (page_id, url, html): an ARC record of an HTTP message, converted to WARC, in files
    under folder.

    Returns the list of files (file, n). Running it writes; so write its result to a table before use. Rows meet their
    payload's first page by its digest, where they lie if very many share it, and then by row key.
    """
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    keyed = common.row_keyed(base, F.col("page_id"), F.col("url"), F.col("html"))
    keys = payload_keys(keyed)
    again = common.joined(keys.filter(F.col("size") >= least), common.written(originals(keys, least), "originals"), ["sha1", "size"], "n")
    again = common.written(again.filter(~F.col("page_id").eqNullSafe(F.col("first"))).select("rid", "first"), "revisits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = f"pages-{TaskContext.get().partitionId():06d}.warc.gz"
        file, n = f"{folder}/{name}", 0

        def members() -> Iterator[bytes]:
            nonlocal n
            for batch in batches:
                for a in range(0, batch.num_rows, 128):
                    part = batch.slice(a, 128).to_pylist()
                    if not n:
                        yield _warcinfo(version, date, name)
                    arc = arc_bytes([ArcRecord(safe_url(r["url"]), "0.0.0.0", date, "text/html", _message((r["html"] or "").encode()), version, "200") for r in part], version)
                    records = read_arc(arc)
                    next(records)  # filedesc
                    for r, record in zip(part, records, strict=True):
                        named = digest(http_parts(record.payload)[1])
                        refers = None if r["first"] is None else page_record_id(r["first"], named)
                        own = record_id(f"row {r['rid']}", date, named) if r["page_id"] is None else page_record_id(r["page_id"], named)
                        n += 1
                        yield _member(warc_record(record, refers, own))

        common.write_file(file, members())
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([n], pa.int64())], ["file", "n"])

    return keyed.join(again, "rid", "left").select("page_id", "url", "html", "first", "rid").mapInArrow(run, "file string, n long")


def _message(body: bytes) -> bytes:
    """A page as a web server's answer."""
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body


RECORD_SCHEMA = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, record_id string, date string"
_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$")


def read_archives(files: DataFrame) -> DataFrame:
    """The records of the listed files but warcinfo. Of responses and resources length and digest are measured on the
    payload; of revisits they are those of the full payload, by the record's digest and HTTP header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows: list[tuple] = []
                system, path = common.file_system(file)
                with system.open_input_stream(path, compression=None) as source, gzip.GzipFile(fileobj=source) as stream:
                    for h, block in read_warc(stream):
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        head, payload = http_parts(block) if h["Content-Type"].startswith("application/http") else (b"", block)
                        named, refers = h["WARC-Payload-Digest"].removeprefix("sha1:"), None
                        if h["WARC-Type"] == "revisit":
                            length = _LENGTH.search(head)
                            size = int(length[1]) if length else None
                            refers = page_of(h["WARC-Refers-To"])
                            if refers is not None and page_record_id(refers, named) != h["WARC-Refers-To"]:
                                raise ValueError(f"{h['WARC-Record-ID']} refers to a record of another payload")
                        else:
                            size = len(payload)
                            if digest(payload) != named:
                                raise ValueError(f"the payload of {h['WARC-Record-ID']} is damaged")
                        rows.append((page_of(h["WARC-Record-ID"]), h["WARC-Target-URI"], h["WARC-Type"], named, size, refers, h["WARC-Record-ID"], h["WARC-Date"]))
                        if len(rows) == 2000:
                            yield _records(rows, RECORD_SCHEMA)
                            rows = []
                if rows:
                    yield _records(rows, RECORD_SCHEMA)

    return files.select("file").repartition(max(1, common.partitions(files.sparkSession)), "file").mapInArrow(run, RECORD_SCHEMA)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _records(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


def archive_round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Archives all pages in the shared folder and reads the archives back."""
    spark = pages.sparkSession
    return read_archives(common.written(write_archives(pages, common.new_folder(spark, "warc"), least), "warc-files"))


ARC_SCHEMA = "file string, position long, url string, ip string, date string, content_type string, version int, result_code string, checksum string, location string, record_type string, record_id string, payload_digest string, payload binary, problem string"


def read_arc_files(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """A table of the records of the ARC files at a path that Spark reads, `filedesc` records too, with the type, identifier
    and digest that the converter gives them; payload is the body of an HTTP message, else the record's bytes. A task holds
    one file. With strict off, a damaged record ends its file's rows with one whose `problem` says what is wrong."""
    common.bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                k = -1
                try:
                    for k, r in enumerate(read_arc(content.as_py())):
                        web, info = r.payload.startswith(b"HTTP/"), r.url.startswith("filedesc://")
                        payload = http_parts(r.payload)[1] if web else r.payload
                        named, kind = digest(payload), "warcinfo" if info else "response" if web else "resource"
                        row = (file, k, r.url, r.ip, timestamp(r.date), r.content_type, r.version, r.result_code, r.checksum, r.location, kind, record_id(r.url, r.date, named), named, payload, None)
                        yield _records([row], ARC_SCHEMA)
                except (ValueError, EOFError, OSError, zlib.error) as e:
                    if strict:
                        raise
                    yield _records([(file, k + 1, *[None] * 12, str(e))], ARC_SCHEMA)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, ARC_SCHEMA)


def convert_arc_files(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """Converts the ARC files at a path that Spark reads, one WARC file for each, under folder. Returns the list of files
    (file, n); running it writes, so write its result to a table before use."""
    common.bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                base = re.sub(r"\.arc(\.gz)?$", "", file.rsplit("/", 1)[-1])
                out, n = f"{folder}/{uuid.uuid5(SPACE, file)}-{base}.warc.gz", 0

                def members(data: bytes = content.as_py()) -> Iterator[bytes]:
                    nonlocal n
                    for r in read_arc(data):
                        n += 1
                        yield _member(warc_record(r))

                common.write_file(out, members())
                yield pa.RecordBatch.from_arrays([pa.array([out]), pa.array([n], pa.int64())], ["file", "n"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, n long")
