import base64
import gzip
import hashlib

from tests.llm.conftest import clashing, rows_of
from webloom.llm import catalog, warc


def expected(rows):
    """By rows (page_id, html)."""
    last = {}
    for i, html in rows:
        if i is not None:
            last[html or ""] = max(i, last.get(html or "", i))
    out = []
    for i, html in rows:
        data = (html or "").encode()
        best = last.get(html or "")
        revisit = i is not None and best > i
        out.append((repr(i), repr(len(data)), repr(base64.b32encode(hashlib.sha1(data).digest()).decode()), repr("revisit" if revisit else "response"), repr(best if revisit else None)))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    order = [names.index(n) for n in sorted(names)]
    return sorted(tuple(x[k] for k in order) for x in out)


ROWS = [
    (1, "http://a/x", "<p>same</p>"), (2, "http://a/y", "<p>same</p>"), (3, None, "<p>same</p>"), (4, "http://b/ with space\n", None), (5, "", ""), (6, "http://c", "WARC/1.1\r\n\r\nfiledesc://x 0.0.0.0\r\n\r\n"),
    (7, "http://d", "\n\n\n"), (8, "http://e", "ümläut 🙂 " * 40_000), (9, "http://f", "x" * 6_000_000), (None, "http://g", "<p>same</p>"), (None, None, None), (10, "http://h", "line\r\n\r\nHTTP/1.0 200 OK\r\n\r\n\x00\x1f\x8b"), (10, "http://h", "twice the id"), (11, "http://é.example/ü", "z"),
]
KIND = "page_id long, url string, html string"


def test_round_trip(spark):
    pages = clashing(spark.createDataFrame(ROWS, KIND).repartition(3))
    assert rows_of(warc.round_trip(pages)) == expected([(i, h) for i, _, h in ROWS])


def test_the_query_over_the_table(spark, sf_dir):
    rows = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert rows_of(catalog.op3_warc(spark, sf_dir)) == expected(rows)


def test_an_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], KIND)).collect() == []


def test_both_versions_of_the_legacy_format_are_read():
    documents = [("http://a/ b", "19961231235959", "text/html", b"HTTP/1.0 404 No\r\nA: b\r\n\r\nbody"), ("http://c", "1997", "text/plain", b"no header at all\n\n")]
    for version in (1, 2):
        data = warc.arc_file("x.arc", version, documents)
        parsed = list(warc.parse_arc(data))
        assert parsed[0][0]["version"] == str(version)
        assert [(f["URL"], f["Archive-date"], d) for f, d in parsed[1:]] == [(u, d, b) for u, d, _, b in documents]
        if version == 2:
            assert [f["Result-code"] for f, _ in parsed[1:]] == ["404", "200"]
            for fields, document in parsed[1:]:
                at = int(fields["Offset"])
                assert data[at:].lstrip(b"\n").startswith(fields["URL"].encode()) and fields["Checksum"] == warc.base32_sha1(document)


def test_converted_records():
    data = warc.arc_file("x.arc", 1, [("http://a", "19961231235959", "text/html", b"HTTP/1.0 200 OK\r\n\r\nbody"), ("http://c", "1997", "text/plain", b"plain")])
    records = list(warc.parse_warc(b"".join(gzip.compress(r) for r in warc.convert(data))))
    assert [f["WARC-Type"] for f, _ in records] == ["warcinfo", "response", "resource"]
    assert [f["WARC-Date"] for f, _ in records[1:]] == ["1996-12-31T23:59:59Z", "1997-01-01T00:00:00Z"]
    assert records[1][0]["WARC-Payload-Digest"] == "sha1:" + warc.base32_sha1(b"body")
    assert records[1][0]["WARC-Block-Digest"] == "sha1:" + warc.base32_sha1(records[1][1])
    assert list(warc.convert(data)) == list(warc.convert(data))


def test_archives_from_elsewhere(spark):
    data = warc.arc_file("x.arc", 2, [("http://a", "19961231235959", "text/html", b"HTTP/1.0 200 OK\r\n\r\nbody")])
    df = spark.createDataFrame([(bytearray(data), "x"), (bytearray(gzip.compress(data)), "y"), (None, "z")], "content binary, run string")
    runs = [bytes(r["run"]) for r in warc.convert_archives(df).collect()]
    assert len(runs) == 2 and runs[0] == runs[1]
    assert [f["WARC-Type"] for f, _ in warc.parse_warc(runs[0])] == ["warcinfo", "response"]
