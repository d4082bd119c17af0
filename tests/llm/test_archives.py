from __future__ import annotations

import gzip
import hashlib

import pytest

from tallylog.llm import archives
from tallylog.llm.common import shared_path

LONG = "<p>größer \r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n</p>" * 60
PAGES = [
    (1, "http://a.example/x y", LONG), (2, None, LONG), (3, "http://b.example/", LONG), (3, "http://b.example/", LONG),
    (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", "x" * 999), (9, "u", "x" * 999),
    (10, "u", "y" * 1000), (11, "u", "y" * 1000), (12, "http://é.example/ü\nz", "\r\n\r\n"), (-5, "u", LONG + "!"),
]


def round_trip(spark, rows):
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, path string")
    path = shared_path(spark, "warc")
    archives.write_warc(archives.to_warc(archives.from_arc(archives.arc_files(pages))), path)
    return archives.read_warc(spark, path, with_payload=True)


def test_round_trip_and_revisits(spark):
    records = round_trip(spark, PAGES)
    whole = {(r.page_id, r.payload) for r in records.collect() if r.record_type == "response"}
    assert (6, b"short") in whole and (12, b"\r\n\r\n") in whole and (3, LONG.encode()) in whole
    got = sorted((tuple(r) for r in archives.resolved(records).collect()), key=repr)
    expected = []
    for k, (page, _, html) in enumerate(PAGES):
        payload = (html or "").encode()
        same = [(p, n) for n, (p, _, h) in enumerate(PAGES) if (h or "").encode() == payload]
        revisit = len(payload) >= 1000 and max(same) != (page, k)
        kind = ("revisit", max(same)[0]) if revisit else ("response", None)
        expected.append((page, len(payload), hashlib.sha1(payload).hexdigest(), *kind))
    assert got == sorted(expected, key=repr)


def test_empty_table(spark):
    assert archives.resolved(round_trip(spark, [])).collect() == []


@pytest.mark.parametrize("version", [b"1", b"2"])
def test_arc_versions(version):
    records = [(b"http://x/ a", b"20010203040506", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\n\n"), (b"", b"20010203040507", b"")]
    content = archives.arc_block(version, "f.arc", records)
    got = list(archives.arc_records(content + b"\n\n"))
    assert [(r["URL"], r["Archive-date"], r["content"]) for r in got] == [
        (b"http://x/%20a".replace(b"%20a", b"%20a"), records[0][1], records[0][2]), (b"-", records[1][1], b"")
    ]
    assert set(got[0]) - {"offset", "content"} == {f.decode() for f in archives.ARC_FIELDS[version]}
    for broken in (content[:-5], content.replace(b"URL", b"XRL", 1), content + b"x 1\n"):
        with pytest.raises(ValueError):
            list(archives.arc_records(broken))


def test_short_dates_and_headers_without_a_length(spark):
    dates = [b"20010203040506", b"200102030405", b"20010203", b"2001", b"20010203040", b"20010231000000", b"-", b"2001020304050607"]
    head = b"HTTP/1.1 200 OK\r\nX-Page-Id: %d\r\n\r\n"
    records = [(b"http://x/", date, head % k + b"z" * 2000) for k, date in enumerate(dates)]
    files = spark.createDataFrame([("a.arc", archives.arc_block(b"1", "a.arc", records))], "path string, content binary")
    warc = archives.to_warc(archives.from_arc(files))
    found = {}
    for (record,) in warc.collect():
        fields = dict(line.split(": ", 1) for line in record.split("\r\n\r\n")[0].split("\r\n")[1:])
        found[record.split("X-Page-Id: ")[1].split("\r\n")[0]] = fields["WARC-Date"]
    day, none = "2001-02-03T", "1970-01-01T00:00:00Z"
    expected = ["04:05:06Z", "04:05:00Z", "00:00:00Z"]
    assert [found[str(k)] for k in range(8)] == [*[day + t for t in expected], "2001-01-01T00:00:00Z", day + "04:00:00Z", none, none, none]
    path = shared_path(spark, "warc")
    archives.write_warc(warc, path)
    got = archives.resolved(archives.read_warc(spark, path)).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == [
        *[(k, 2000, "revisit", 7) for k in range(7)], (7, 2000, "response", None)
    ]


def test_many_gzip_members_and_small_steps(monkeypatch):
    monkeypatch.setattr(archives._Unpacked, "STEP", 7)
    records = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (k, b"z" * k) for k in (0, 1, 500)]
    for content in (b"".join(map(gzip.compress, records)), b"".join(records), gzip.compress(b"".join(records))):
        assert [block for _, block in archives.warc_records(content)] == [b"", b"z", b"z" * 500]


def test_content_without_http_headers():
    assert archives.split_http(b"plain\r\n\r\nx") == (b"", b"plain\r\n\r\nx")
    assert archives.split_http(b"HTTP/1.1 200\r\nX-Page-Id: 7\r\n\r\nx") == (b"HTTP/1.1 200\r\nX-Page-Id: 7\r\n\r\n", b"x")
