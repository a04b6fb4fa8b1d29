"""Legacy archives as WARC: ARC header lines of either version are parsed by their own field list, and each document becomes an
equivalent WARC record with a synthesised identifier, timestamp, type and digests.

An ARC file begins with a ``filedesc`` document whose second line gives the version and whose third names the fields of every
header line; the last field is the length of the document that follows. Header lines are split from the right, since old
crawlers left spaces in URLs.

Archives are written through Spark's own writers, in the shared folder or wherever the path leads, so that a lost task leaves
no half file: each row is a run of gzip members, one to a record, and the line separator is an empty gzip member. Readers take
members one after another and records by their declared lengths.

Defined results: null payloads are empty; a null URL is ``unknown:``; white space and control characters in URLs are
percent-encoded. Rows with a null or repeated id each get a record; of equal payloads the rows with the largest id are
responses and rows with smaller ids revisit it; a null id is always a response. Extra columns aren't read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.common import scratch, slices, utf8

FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
DATE = "19970101000000"
#: Header fields of archived pages: a page's id, and the id of the page whose payload it has.
PAGE, SAME = "X-Page-Id", "X-Same-Payload-As"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of payloads in a row of an archive, and rows in a file.
RUN_BYTES, RUNS = 4 << 20, 8
#: Bytes fed to the decompressor at once.
FED = 4096
EMPTY_MEMBER = gzip.compress(b"", 9, mtime=0)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def safe_url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "unknown:"


def arc_file(name: str, version: int, documents: list[tuple[str, str, str, bytes]]) -> bytes:
    """An ARC file of (url, date, content type, network document)."""
    names = " ".join(FIELDS[version])
    body = f"{version} 0 webloom\n{names}\n\n".encode()
    extra = f" 200 - - 0 {name}" if version == 2 else ""
    out, offset = [f"filedesc://{name} 0.0.0.0 {DATE} text/plain{extra} {len(body)}\n".encode(), body], 0
    for url, date, kind, document in documents:
        offset = sum(map(len, out)) if version == 2 and len(out) < 3 else offset
        more = f" {_status(document)} {base32_sha1(document)} - {offset} {name}" if version == 2 else ""
        head = f"\n{url} 0.0.0.0 {date} {kind}{more} {len(document)}\n".encode()
        out += [head, document]
        offset += len(head) + len(document)
    return b"".join(out)


def _status(document: bytes) -> int:
    found = re.match(rb"HTTP/\d\.\d (\d{3})", document)
    return int(found[1]) if found else 200


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, document) of every record, the file's description first."""
    at, names = 0, None
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.index(b"\n", at)
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        length = int(line.rpartition(" ")[2])
        document = data[end + 1 : end + 1 + length]
        if len(document) < length:
            raise ValueError("the archive ends inside a document")
        if names is None:
            lines = document.decode("utf-8", "replace").splitlines()
            version, names = int(lines[0].split()[0]), lines[1].split()
            own = FIELDS.get(version, names) if len(line.split(" ")) >= len(names) else FIELDS[1]
            yield dict(zip(own, line.rsplit(" ", len(own) - 1), strict=True)) | {"version": str(version)}, document
        else:
            yield dict(zip(names, line.rsplit(" ", len(names) - 1), strict=True)), document
        at = end + 1 + length


def timestamp(date: str) -> str:
    """ISO 8601 from an archive date of 4 to 14 digits; what is missing counts as its least value."""
    digits = re.sub(r"\D", "", date)[:14]
    full = digits + "00000101000000"[len(digits) :] if len(digits) >= 4 else DATE
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def split_http(document: bytes) -> tuple[bytes, bytes]:
    """(header with its empty line, entity) of an HTTP response; no header: all is entity."""
    if not document.startswith(b"HTTP/"):
        return b"", document
    found = re.search(rb"\r?\n\r?\n", document)
    return (document[: found.end()], document[found.end() :]) if found else (document, b"")


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def named(url: str, date: str, digest: str, own: str | None = None) -> str:
    """A record's identifier from what tells its document from others: always the same for the same document."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join([url, timestamp(date), digest, *([own] if own else [])]))}>"


def identifier(fields: dict[str, str], head: bytes, entity: bytes) -> str:
    return named(fields["URL"], fields["Archive-date"], base32_sha1(entity), http_field(head, PAGE))


def convert(data: bytes, refers: Callable | None = None) -> Iterator[bytes]:
    """The WARC records of an ARC file. refers(fields, head, entity): (identifier, URL) of the record that this one revisits, or None."""
    for i, (fields, document) in enumerate(parse_arc(data)):
        date = timestamp(fields["Archive-date"])
        if not i:
            note = f"software: webloom\r\nformat: WARC File Format 1.1\r\ndescription: converted from an ARC file of version {fields['version']}\r\n".encode()
            yield record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", identifier(fields, b"", document)), ("WARC-Date", date), ("WARC-Filename", fields["URL"].removeprefix("filedesc://")), ("Content-Type", "application/warc-fields")], note)
            continue
        head, entity = split_http(document)
        target = refers(fields, head, entity) if refers and head else None
        block = head if target else document
        kind = "revisit" if target else "response" if head else "resource"
        own = [("WARC-Type", kind), ("WARC-Record-ID", identifier(fields, head, entity)), ("WARC-Date", date), ("WARC-Target-URI", fields["URL"]), ("WARC-Payload-Digest", f"sha1:{base32_sha1(entity)}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
        if fields["IP-address"] not in ("0.0.0.0", "-"):
            own.append(("WARC-IP-Address", fields["IP-address"]))
        if target:
            own += [("WARC-Refers-To", target[0]), ("WARC-Refers-To-Target-URI", target[1]), ("WARC-Profile", REVISIT)]
        yield record([*own, ("Content-Type", "application/http; msgtype=response" if head else fields["Content-type"])], block)


def members(data: bytes) -> Iterator[bytes]:
    """The contents of a gzip file's members; bytes that aren't gzip come as they are."""
    view, at = memoryview(data), 0
    while at < len(view):
        if bytes(view[at : at + 2]) != b"\x1f\x8b":
            yield bytes(view[at:])
            return
        one, out = zlib.decompressobj(31), []
        while not one.eof:  # a little at a time: what is left over behind a member is copied
            if at >= len(view):
                raise ValueError("the archive ends inside a member")
            piece = view[at : at + FED]
            out.append(one.decompress(piece))
            at += len(piece)
        at -= len(one.unused_data)
        if any(out):
            yield b"".join(out)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named fields, block) of every record, by declared lengths."""
    for member in members(data):
        at = 0
        while at < len(member):
            end = member.index(b"\r\n\r\n", at)
            lines = member[at:end].decode("utf-8", "replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("no WARC record where one should begin")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            length = int(fields["Content-Length"])
            yield fields, member[end + 4 : end + 4 + length]
            at = end + 4 + length + 4


def write_archives(rows: DataFrame, path: str) -> None:
    """Write rows of ``run`` (gzip members in a binary column) as archives."""
    rows.select(F.col("run").cast("string").alias("value")).write.option("maxRecordsPerFile", RUNS).option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path)


def read_archives(spark, path: str) -> DataFrame:
    """(path, content): archives under a path, a row to a file."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def convert_archives(arcs: DataFrame, content_col: str = "content") -> DataFrame:
    """(run): ARC files, gzipped or not, as runs of WARC members."""

    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                whole = b"".join(members(data or b""))
                if whole:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(gzip.compress(r, 1, mtime=0) for r in convert(whole))], pa.binary())], ["run"])

    return arcs.select(F.col(content_col).cast("binary")).mapInArrow(run, "run binary")


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(run): one WARC record for each page by way of ARC files, in runs of about ``RUN_BYTES``; versions of ARC take turns."""
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    hashed = source.withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    last = F.max(F.struct("id", "url")).alias("best")
    again = hashed.groupBy("sha").agg(last, F.count("*").alias("n")).where("n > 1").select("sha", "best")
    revisits = F.col("best.id") > F.col("id")
    rows = hashed.join(again, "sha", "left").select(F.col("id").cast("string").alias("id"), "url", "payload", F.when(revisits, F.col("best.id")).cast("string").alias("to"), F.when(revisits, F.col("best.url")).alias("there"))

    def run(batches):
        turn = 0
        for batch in batches:
            for part in slices(batch, "payload", RUN_BYTES):
                documents, targets = [], []
                for i, url, payload, to, there in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), utf8(part.column(2)), part.column(3).to_pylist(), part.column(4).to_pylist(), strict=True):
                    same = "" if to is None else f"{SAME}: {to}\r\n"
                    head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{PAGE}: {'' if i is None else i}\r\n{same}Content-Length: {len(payload)}\r\n\r\n".encode()
                    documents.append((safe_url(url), DATE, "text/html", head + payload))
                    targets.append(None if to is None else (named(safe_url(there), DATE, base32_sha1(payload), to), safe_url(there)))
                turn += 1
                legacy = arc_file(f"pages-{turn:05d}.arc", 1 + turn % 2, documents)
                records = convert(legacy, lambda fields, head, entity, each=iter(targets): next(each))
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(gzip.compress(r, 1, mtime=0) for r in records)], pa.binary())], ["run"])

    return rows.mapInArrow(run, "run binary")


READ = "payload_bytes long, payload_digest string, record_type string"


def page_records(archives: DataFrame, id_type: T.DataType) -> DataFrame:
    """What archives of pages hold: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                out = []
                for fields, block in parse_warc(data):
                    if fields["WARC-Type"] not in ("response", "revisit"):
                        continue
                    head, entity = split_http(block)
                    revisit = fields["WARC-Type"] == "revisit"
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    own, same = http_field(head, PAGE) or None, http_field(head, SAME) if revisit else None
                    if not revisit and base32_sha1(entity) != digest:
                        raise ValueError(f"digest of {fields['WARC-Record-ID']}")
                    if named(fields["WARC-Target-URI"], fields["WARC-Date"], digest, own) != fields["WARC-Record-ID"] or (revisit and named(fields["WARC-Refers-To-Target-URI"], DATE, digest, same) != fields["WARC-Refers-To"]):
                        raise ValueError(f"identifiers of {fields['WARC-Record-ID']}")
                    out.append((own, int(http_field(head, "Content-Length")) if revisit else len(entity), digest, fields["WARC-Type"], same))
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    found = archives.select("content").mapInArrow(run, f"page_id string, {READ}, refers_to string")
    return found.select(F.col("page_id").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write an archive of every page, and what reading it back gives."""
    path = path or scratch(pages.sparkSession, "warc")
    write_archives(archive_pages(pages), path)
    return page_records(read_archives(pages.sparkSession, path), pages.schema["page_id"].dataType)


_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, {i} * 5 + 1, 5) AS INTEGER) >> {shift}) & 31), 1)"
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages), g AS (SELECT html, max(page_id) AS best FROM p GROUP BY html)
SELECT page_id, strlen(html) AS payload_bytes, {" || ".join(_DIGIT.format(i=i, shift=shift) for i in range(8) for shift in (15, 10, 5, 0))} AS payload_digest,
  CASE WHEN best > page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN best > page_id THEN best END AS refers_to
FROM p JOIN g USING (html)
"""
