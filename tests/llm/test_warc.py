"""ARC parsing, WARC round trips, revisits against brute force."""

import base64
import gzip
import hashlib
import io

import pytest
from tideline.llm import warc

NASTY = "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc http://x 0.0.0.0 20240101 text/html 7\n"


#: Archives as they are found: a version 1 file and a version 2 file, written out by hand.
BODY = b"<html>caf\xc3\xa9</html>\n"
MESSAGE = b"HTTP/1.0 200 OK\r\nServer: x\r\nContent-Type: text/html\r\n\r\n" + BODY
V1 = (
    b"filedesc://old.arc 0.0.0.0 19970621104500 text/plain 74\n1 0 Some Archive\nURL IP-address Archive-date Content-type Archive-length\n\n\n"
    b"http://www.a.test:80/x y?q=1 10.1.2.3 19970621104512 text/html %d\n%s\n" % (len(MESSAGE), MESSAGE)
    + b"dns:www.a.test 10.1.2.9 19970621104513 text/dns 33\n19970621104513\nwww.a.test A 10.1\n\n"
    + b"http://www.a.test/\xe9\xff 10.1.2.3 199706211045 text/html; charset=x 12\nHTTP/1.0 500\n"
)
V2 = (
    b"filedesc://new.arc 0.0.0.0 20020304050607 text/plain 200 - - 0 new.arc 121\n2 0 Other Archive\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n\n\n"
    b"https://b.test/ - 20020304050608 text/html 302 a1b2c3 http://b.test/z 209 new.arc 28\nHTTP/1.1 302 Found\nX: 1\n\nok\n\n"
)


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_literal_archives():
    assert V1[V1.index(b"\n") + 1 :][:74].endswith(b"length\n\n") and V2[V2.index(b"\n") + 1 :][:121].endswith(b"length\n\n")
    one, two = list(warc.read_arc(V1)), list(warc.read_arc(V2))
    assert [(r.url, r.ip, r.date, r.content_type, r.version) for r in one] == [
        ("filedesc://old.arc", "0.0.0.0", "19970621104500", "text/plain", 1),
        ("http://www.a.test:80/x y?q=1", "10.1.2.3", "19970621104512", "text/html", 1),
        ("dns:www.a.test", "10.1.2.9", "19970621104513", "text/dns", 1),
        ("http://www.a.test/%E9%FF", "10.1.2.3", "199706211045", "text/html; charset=x", 1),
    ]
    assert one[1].payload == MESSAGE
    assert (two[1].result_code, two[1].checksum, two[1].location, two[1].filename, two[1].ip) == ("302", "a1b2c3", "http://b.test/z", "new.arc", "-")
    for packed in (gzip.compress(V1), gzip.compress(V1[:60]) + gzip.compress(V1[60:])):
        assert list(warc.read_arc(packed)) == one
    info, page, dns, bad = [next(warc.read_warc(io.BytesIO(warc.warc_record(r)))) for r in one]
    assert info[0]["WARC-Type"] == "warcinfo" and info[0]["WARC-Filename"] == "old.arc" and b"1 0 Some Archive" in info[1]
    assert page[0]["WARC-Type"] == "response" and page[0]["Content-Type"] == "application/http;msgtype=response" and page[1] == MESSAGE
    assert page[0]["WARC-Payload-Digest"] == f"sha1:{b32(BODY)}" and page[0]["WARC-Block-Digest"] == f"sha1:{b32(MESSAGE)}"
    assert page[0]["WARC-Date"] == "1997-06-21T10:45:12Z" and page[0]["WARC-IP-Address"] == "10.1.2.3" and page[0]["WARC-Target-URI"] == one[1].url
    assert dns[0]["WARC-Type"] == "resource" and dns[0]["Content-Type"] == "text/dns" and dns[1] == one[2].payload
    assert bad[0]["WARC-Payload-Digest"] == f"sha1:{b32(b'')}" and bad[0]["WARC-Date"] == "1997-06-21T10:45:00Z"
    assert "WARC-IP-Address" not in next(warc.read_warc(io.BytesIO(warc.warc_record(two[1]))))[0]
    h, block = next(warc.read_warc(io.BytesIO(warc.warc_record(one[1], "<urn:uuid:x>"))))
    assert (h["WARC-Type"], h["WARC-Refers-To"], h["WARC-Payload-Digest"]) == ("revisit", "<urn:uuid:x>", f"sha1:{b32(BODY)}") and block == MESSAGE[: -len(BODY)]


@pytest.mark.parametrize("version", [1, 2])
def test_arc(version):
    payloads = [b"", b"\n", b"a\n\nb", NASTY.encode(), bytes(range(256))]
    records = [warc.ArcRecord(f"http://x.test/{i} with space 1.2.3.4 20010203", "1.2.3.4", "20010203040506", "text/html", p, version, "200") for i, p in enumerate(payloads)]
    first, *got = warc.read_arc(warc.arc_bytes(records, version))
    assert first.url.startswith("filedesc://")
    assert [(g.url, g.ip, g.date, g.content_type, g.payload, g.version) for g in got] == [(r.url, r.ip, r.date, r.content_type, r.payload, r.version) for r in records]
    assert (got[0].result_code == "200") == (version == 2)
    with pytest.raises(ValueError):
        list(warc.read_arc(warc.arc_bytes(records, version)[:-20]))
    with pytest.raises(ValueError):
        list(warc.read_arc(b"http://x 1.2.3.4 20010203 text/html 3\nabc"))
    with pytest.raises(ValueError):
        list(warc.read_warc(io.BytesIO(warc.warc_record(got[3]).replace(b"abc", b"abd"))))


def test_page_identifiers():
    for page in (0, 1, -1, 15, 16, 65535, 1 << 40, (1 << 63) - 1, -(1 << 63)):
        assert warc.page_of(warc.page_record_id(page, b32(b"x"))) == page
    assert warc.page_of(warc.record_id("a", "b", "c")) is None


def test_arc_files(spark, tmp_path):
    folder = tmp_path / "arcs"
    folder.mkdir()
    (folder / "one.arc").write_bytes(V1)
    (folder / "two.arc.gz").write_bytes(gzip.compress(V2))
    got = sorted(warc.read_arc_files(spark, str(folder)).collect(), key=lambda r: (r.file, r.position))
    assert [r.record_type for r in got] == ["warcinfo", "response", "resource", "response", "warcinfo", "response"]
    assert bytes(got[1].payload) == BODY and got[1].payload_digest == b32(BODY) and got[5].result_code == "302"
    files = warc.convert_arc_files(spark, str(folder), f"file://{tmp_path}/warcs").collect()
    assert sorted(r.n for r in files) == [2, 4]
    back = {r.record_id: r for r in warc.read_archives(spark.createDataFrame(files)).collect()}
    want = {r.record_id: (r.record_type, r.payload_digest, len(r.payload), r.url, r.date) for r in got if r.record_type != "warcinfo"}
    assert {k: (r.record_type, r.payload_digest, r.payload_bytes, r.url, r.date) for k, r in back.items()} == want
    (folder / "cut.arc").write_bytes(V1[:-300] + b"x")
    (folder / "torn.arc.gz").write_bytes(gzip.compress(V2)[:-40])
    rows = warc.read_arc_files(spark, str(folder), strict=False).collect()
    assert sum(r.problem is not None for r in rows) == 2 and sum(r.problem is None for r in rows) >= 6
    with pytest.raises(Exception, match="ARC"):
        warc.read_arc_files(spark, str(folder)).collect()


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip(spark, least):
    rows = [(10 - i, f"http://x.test/{i}", h) for i, h in enumerate(["same", "same", "é", "é", None, "", NASTY, "x" * 200_000])]
    rows += [(3, "u", "twice"), (3, "u", "twice"), (4, "u", "twice"), (None, "u", "same"), (None, None, "lonely"), (None, "a b\nc", "lonely"), (50, "", "abc")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, rid int, first string")
    first = {}
    for p, _, h in rows:
        if p is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(p, first.get(h or "", p))
    expected = []
    for p, _, h in rows:
        data = (h or "").encode()
        other = first.get(h or "")
        again = other is not None and other != p
        expected.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", other if again else None))
    got = warc.archive_round_trip(df, least).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(expected, key=str)
    assert warc.archive_round_trip(df.limit(0)).collect() == []
