import base64
import gzip
import hashlib
from collections import Counter

import pytest

from viewpulse.llm import warc

ROWS = [(1, "http://a.example/x y", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://c.example/ü", None), (4, "u", ""), (4, "u", ""),
        (5, "v", "WARC/1.1\r\n\r\nfiledesc://x\nhttp://y 0.0.0.0 20240101000000 text/html 5\nbody\n\r\n\r\n"), (6, "w", "ü" * 70_000),
        (None, "n", "<p>no number</p>"), (7, "n", "<p>no number</p>"), (None, "n", "<p>no number</p>")]


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("file_bytes", [200, 1 << 24])
def test_round_trip(spark, file_bytes):
    pages = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "page_id long, url string, html string, number int, file string")
    got = warc.archive_pages(pages.repartition(2), file_bytes=file_bytes).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == Counter(
        (i, len((h or "").encode()), sha(h)) for i, _, h in ROWS)
    by = {}
    for r in got:
        by.setdefault(r.payload_digest, []).append(r)
    for own in by.values():
        heads = [r for r in own if r.record_type == "response"]
        assert len(heads) == 1 and heads[0].page_id == max((r.page_id for r in own), key=lambda x: -1 if x is None else x)
        assert all(r.record_type == "revisit" and r.refers_to == heads[0].page_id for r in own if r is not heads[0])
    assert len({r.record_id for r in got}) == len(ROWS) and {r.date for r in got} == {"2024-01-01T00:00:00Z"}
    assert "http://a.example/x%20y" in {r.uri for r in got}


def test_small_payloads_are_not_compared(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    got = warc.archive_pages(pages, min_bytes=11).collect()
    assert {r.record_type for r in got if r.payload_bytes < 11} == {"response"}
    assert any(r.record_type == "revisit" for r in got)


def test_no_pages(spark):
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_both_header_versions():
    block = b"HTTP/1.1 200 OK\r\nX-Page-Id: 9\r\n\r\nhello\nthere"
    for version in (1, 2):
        data = warc.arc_header(version, "f.arc", "19990203040506") + b"\n"
        data += warc.arc_record(version, "http://x.example/", "19990203040506", 9, b"hello\nthere", "f.arc", len(data)) + b"\n"
        line = f"http://y.example/ 1.2.3.4 20000101 text/plain {'' if version == 1 else '200 - - 0 f.arc '}3\n".encode()
        data += line + b"abc\n" + line.replace(b" 3\n", b" 9\n") + b"abc"
        for content in (data, gzip.compress(data[:50]) + gzip.compress(data[50:])):
            first, second, third = warc.arc_records(content)
            assert first["URL"] == "http://x.example/" and first["block"].endswith(block[-11:]) and not first["cut"]
            assert second["block"] == b"abc" and second["IP-address"] == "1.2.3.4" and not second["cut"] and third["cut"]
            records = list(warc.warc_records(warc.converted("s3://b/f.arc.gz", content, {0: ("s3://b/g.arc", 4)}) + b"\r\n\r\n"))
            kinds = [f["warc-type"] for f, _ in records]
            assert kinds == ["warcinfo", "revisit", "resource", "resource"]
            assert records[1][0]["warc-date"] == "1999-02-03T04:05:06Z"
            assert records[1][0]["warc-refers-to"] == warc.record_id("elsewhere/g.arc", 4)
            assert records[1][0]["warc-payload-digest"] == f"sha1:{warc.digest(block[-11:])}"
            assert records[2][1] == b"abc" and records[3][0]["warc-truncated"] == "length"


def test_damaged_archive():
    with pytest.raises(ValueError, match="no ARC header line"):
        list(warc.arc_records(b"this is not an archive\n"))
