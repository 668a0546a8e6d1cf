import base64
import gzip
import hashlib
import io
import os
import zlib

import pytest
from pyspark.sql import functions as F

from linedocs.llm import warc

LONG = "lorem ipsum " * 200_000


def expected(rows, min_bytes=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        f = first.get(h or "") if len(data) >= min_bytes else None
        again = f is not None and f != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


ROWS = [(7, "http://a/", "<p>x</p>"), (3, "http://b/ \r\nX: y%20é", "<p>x</p>"), (3, "http://b/", "<p>x</p>"), (None, None, "<p>x</p>"), (None, None, "alone"),
        (4, "", None), (5, None, ""), (8, "u", LONG), (9, "v", LONG), (10, "w", "漢字 😀"), (11, "w", "\r\n\r\nWARC/1.1\r\n"), (2, "z", "WARC/1.0")]


@pytest.mark.parametrize("min_bytes", [0, 8, 1000])
def test_round_trip(spark, min_bytes):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("path", "bytes", "x.y", "payload")})
    files = warc.write_warc(spark, pages, min_bytes=min_bytes)
    for split in (64 << 20, 200):
        records = warc.read_warc(spark, files, split_bytes=split)
        assert sorted(map(tuple, warc.page_records(records).collect()), key=str) == expected(ROWS, min_bytes)
    uris = {r["uri"] for r in records.where("record_type <> 'warcinfo'").collect()}
    assert uris == {u for _, u, _ in ROWS}


def test_payloads_and_listing(spark, tmp):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    warc.write_warc(spark, pages, f"{tmp}/a b", file_bytes=2000)
    files = warc.archives(spark, f"{tmp}/a b")
    assert files.count() > 1
    read = warc.read_warc(spark, files, payload=True, split_bytes=300).where("record_type = 'response'")
    want = {(i, h or "") for i, _, h in ROWS if (i, h) != (None, "<p>x</p>") and i not in (7, 5, 9)}
    assert {(None if r["record_id"] == "urn:page:" else int(r["record_id"][9:]), bytes(r["payload"]).decode()) for r in read.collect()} == want


def test_files_are_plain_warc(spark, tmp):
    pages = spark.createDataFrame(ROWS[:2], "page_id long, url string, html string").coalesce(1)
    path = warc.write_warc(spark, pages, f"{tmp}/b").first()["path"]
    text = gzip.open(path).read()
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == 3 and text.endswith(b"\r\n\r\n")
    assert b"WARC-Target-URI: http://b/%20%0D%0AX:%20y%2520%C3%A9\r\n" in text


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.page_records(warc.read_warc(spark, warc.write_warc(spark, pages))).collect() == []


def members(n, payload, level=6):
    out = []
    for i in range(n):
        block = warc.HTTP_HEAD + b"\r\n" + payload(i)
        out.append(warc.record_bytes("response", f"urn:page:{i}", "2020-01-01T00:00:00Z", [("Content-Type", "application/http;msgtype=response")], block))
    return out


def test_every_range_owns_the_records_that_start_in_it():
    parts = members(30, lambda i: bytes([i]) * i * 7)
    data, starts = b"".join(parts), [sum(map(len, parts[:i])) for i in range(30)]
    for width in (1, 2, 3, 50, 97, 1000):
        found = [r["offset"] for a in range(0, len(data), width) for r in warc.records_in(io.BytesIO(data), a, min(a + width, len(data)))]
        assert found == starts
    torn = data[:starts[-1] + 40]
    assert [r["offset"] for r in warc.records_in(io.BytesIO(torn), 0, len(torn))] == starts[:-1]


def test_records_stored_inside_a_payload_are_not_read(spark, tmp):
    inner = b"".join(members(20, lambda i: os.urandom(1000))) + warc.MAGIC + os.urandom(50) + warc.MAGIC + b"WARC/1.1"
    stored = []
    for record in members(4, lambda i: inner + bytes([i])):
        packer = zlib.compressobj(0, zlib.DEFLATED, 31)
        stored.append(packer.compress(gzip.decompress(record)) + packer.flush())
    blob = b"".join(stored)
    (tmp / "c").mkdir()
    (tmp / "c" / "x.warc.gz").write_bytes(blob)
    alone = [r for a in range(0, len(blob), 500) for r in warc.records_in(io.BytesIO(blob), a, min(a + 500, len(blob)))]
    assert len(alone) > 40  # ranges that start inside a payload do find the inner records
    files = warc.archives(spark, f"{tmp}/c")
    for payload in (False, True):
        got = warc.read_warc(spark, files, payload=payload, split_bytes=500).collect()
        assert sorted(r["record_id"] for r in got) == [f"urn:page:{i}" for i in range(4)]
    assert all(bytes(r["payload"])[:-1] == inner for r in got)


def test_damage_is_seen(spark, tmp):
    from pyspark.errors import PySparkException

    block = warc.HTTP_HEAD + b"\r\nbody"
    wrong = warc.record_bytes("response", "urn:page:1", "d", [("WARC-Payload-Digest", "sha1:AAAA"), ("Content-Type", "application/http")], block)
    (tmp / "d").mkdir()
    (tmp / "d" / "x.warc.gz").write_bytes(wrong)
    records = warc.read_warc(spark, warc.archives(spark, f"{tmp}/d"))
    assert [r["intact"] for r in records.collect()] == [False]
    with pytest.raises(PySparkException):
        warc.page_records(records).collect()
