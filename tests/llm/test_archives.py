"""Legacy archives: formats, round trip and odd input."""

import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from tierflow.llm.archives import (arc_record, arc_version_block, archive, convert, digest_of, parse_arc, parse_warc, read_warc,
                                   warc_date, warc_record)

SCHEMA = "page_id bigint, url string, html string, digest string, length int"
BODY = "zwei\r\n\r\nWARC/1.0\r\nContent-Length: 3\n1 0 x\n\n" * 3


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_are_read_by_declared_length(version):
    bodies = [b"", BODY.encode(), b"\n\n\n", "é".encode() * 5000]
    data = arc_version_block(version, "20010203040506") + b"\n"
    for k, body in enumerate(bodies):
        data += arc_record(version, f"http://x/{k} y", body, "20010203040506", 200, k) + b"\n"
    got = list(parse_arc(data))
    assert [c.payload for c in got] == bodies
    assert [c.url for c in got] == [f"http://x/{k}%20y" for k in range(4)]
    assert [c.headers["x-page-id"] for c in got] == ["0", "1", "2", "3"]
    assert {(c.date, c.mime) for c in got} == {("20010203040506", "text/html")}
    with pytest.raises(ValueError):
        list(parse_arc(data[:-10]))
    with pytest.raises(ValueError):
        list(parse_arc(data.replace(b"\n%d 0 tierflow" % version, b"\n7 0 tierflow")))


def test_warc_records_round_trip_and_damage_is_noticed():
    digest, head = digest_of(BODY.encode()), b"HTTP/1.1 200 OK\r\nX-Page-Id: 5"
    assert digest == base64.b32encode(hashlib.sha1(BODY.encode()).digest()).decode()
    first = {"page_id": "5", "url": "http://x/", "date": "20010203040506"}
    one = warc_record("http://x/", "1.2.3.4", "20010203040506", "text/html", "5", digest, len(BODY), head, BODY.encode())
    two = warc_record("http://y/", "0.0.0.0", "2001", "text/html", "6", digest, len(BODY), head, None, first)
    data = one + b"\r\n\r\n" + two + b"\r\n\r\n"
    (h1, t1, p1), (h2, t2, p2) = parse_warc(data)
    assert (h1["warc-type"], p1, h1["warc-date"], t1) == ("response", BODY.encode(), "2001-02-03T04:05:06Z", head)
    assert (h2["warc-type"], p2, h2["x-refers-to-page"], h2["warc-date"]) == ("revisit", b"", "5", "2001-01-01T00:00:00Z")
    assert h2["warc-refers-to"] == h1["warc-record-id"] != h2["warc-record-id"]
    assert (h2["warc-refers-to-target-uri"], h2["warc-refers-to-date"]) == ("http://x/", h1["warc-date"])
    assert h1["warc-ip-address"] == "1.2.3.4" and "warc-ip-address" not in h2
    with pytest.raises(ValueError):
        list(parse_warc(data.replace(b"zwei", b"drei")))
    assert warc_date("nonsense") == warc_date("20011332") == "1970-01-01T00:00:00Z"


def test_captures_keep_what_they_are(spark, area):
    """Status, headers, type and address of foreign captures, bytes that are no text, and documents that are no responses."""
    image = bytes(range(256)) * 3
    missing = b"HTTP/1.0 404 Not Found\r\nContent-Type: image/png\r\nServer: old\r\n\r\n" + image
    lookup = b"20010203040506\nwww.x.org 10.0.0.1"
    lines = [("http://x.org/a.png", "10.0.0.1", "20010203040506", "image/png", missing), ("dns:www.x.org", "10.0.0.9", "2001", "text/dns", lookup),
             ("http://x.org/b.png", "10.0.0.2", "20020203040506", "image/png", missing), ("dns:www.x.org", "10.0.0.9", "2002", "text/dns", lookup)]
    data = arc_version_block(1, "2001") + b"\n" + b"".join(
        " ".join([*map(str, line[:4]), str(len(line[4]))]).encode() + b"\n" + line[4] + b"\n" for line in lines)
    (tmp := Path(area, "arc")).mkdir()
    (tmp / "part-0.gz").write_bytes(gzip.compress(data))
    convert(spark, f"{area}/arc", f"{area}/warc")
    got = sorted(read_warc(spark, f"{area}/warc").collect(), key=lambda r: (r.url, r.date))
    assert [r.record_type for r in got] == ["resource", "resource", "response", "response"]
    assert bytes(got[0].payload) == lookup and bytes(got[2].payload) == bytes(got[3].payload) == image
    assert bytes(got[2].head) == missing.partition(b"\r\n\r\n")[0] and got[2].payload_digest == digest_of(image)
    files = [bytes(f.content) for f in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{area}/warc").collect()]
    heads = {h["warc-target-uri"]: h for f in files for h, *_ in parse_warc(gzip.decompress(f))}
    assert heads["dns:www.x.org"]["content-type"] == "text/dns" and heads["http://x.org/a.png"]["warc-ip-address"] == "10.0.0.1"


def test_binary_pages_and_ids_that_are_no_numbers(spark):
    pages = [("b", "u", b"\xff\xfe" * 9), ("a", "u", b"\xff\xfe" * 9), ("10", "u", b"\xff\xfe" * 9), ("9", "v", b"\x00"), (None, "v", b"\x00")]
    got = archive(spark.createDataFrame(pages, "page_id string, url string, html binary")).collect()
    assert sorted((r.page_id or "", r.refers_to) for r in got) == [("", "9"), ("10", None), ("9", None), ("a", "10"), ("b", "10")]
    assert {bytes(r.payload) for r in got if r.payload is not None} == {b"\xff\xfe" * 9, b"\x00"}


def test_pages_through_both_formats(spark, monkeypatch):
    from tierflow.llm import archives

    monkeypatch.setattr(archives, "FILE_BYTES", 4000)  # several files of each version
    pages = [(1, "http://a/x y", "same", "d", 1), (7, None, "same", "d", 1), (3, "http://b/\n", BODY, "d", 1), (4, "u", None, "d", 1),
             (9, "u", "", "d", 1), (2, "v", "é" * 40_000, "d", 1), (None, "w", "same", "d", 1), (5, "v", "x", "d", 1), (5, "v", "x", "d", 1)]
    got = archive(spark.createDataFrame(pages, SCHEMA)).collect()
    assert len(got) == len(pages)
    want = {"1": (None, "same"), "7": ("1", "same"), "3": (None, BODY), "4": (None, ""), "9": ("4", ""), "2": (None, "é" * 40_000),
            None: ("1", "same"), "5": (None, "x")}
    for r in got:
        refers, body = want[r.page_id]
        assert (r.refers_to, r.payload_bytes, r.payload_digest) == (refers, len(body.encode()), digest_of(body.encode()))
        assert r.record_type == ("revisit" if refers else "response")
        assert r.payload is None if refers else bytes(r.payload).decode() == body
    assert archive(spark.createDataFrame([], SCHEMA)).collect() == []
    small = archive(spark.createDataFrame(pages, SCHEMA), least=5).collect()
    assert all(r.record_type == "response" for r in small)


def test_files_are_archives_on_their_own(spark, area):
    from tierflow.llm.archives import convert, write_arc

    write_arc(spark.createDataFrame([(1, "u", BODY, "", 0)], SCHEMA), f"{area}/arc")
    convert(spark, f"{area}/arc", f"{area}/warc")
    files = spark.read.format("binaryFile").load(f"{area}/warc").collect()
    heads = [h for f in files for h, *_ in parse_warc(gzip.decompress(bytes(f.content)))]
    assert [h["warc-type"] for h in heads] == ["response"]
    assert read_warc(spark, f"{area}/warc").count() == 1
