"""SRC3 by byte ranges: every line once, whatever its end and wherever the ranges cut."""

import bz2
import gzip
import io
import random
import re

import pytest

from linedocs.sources import ranges
from linedocs.sources.files import read_lines


def reference(data):
    out, at = [], 0
    for m in re.finditer(rb"([^\r\n]*)(\r\n|\n|\r)|([^\r\n]+)$", data):
        out.append((m.start(), m[1] if m[3] is None else m[3]))
    return out


def by_ranges(data, width):
    out = []
    for a in range(0, len(data), width):
        source = io.BytesIO(data)
        source.seek(max(0, a - 1))
        out += ranges.lines_of(source, a, min(a + width, len(data)))
    return out


@pytest.mark.parametrize("block", [1, 2, 7, 1000])
def test_any_cut(monkeypatch, block):
    monkeypatch.setattr(ranges, "BLOCK", block)
    r = random.Random(block)
    for _ in range(400):
        data = b"".join(r.choice([b"\n", b"\r", b"\r\n", b"a", b"bc", "é".encode(), b"\xff", b"long line"]) for _ in range(r.randrange(30)))
        for width in (1, 2, 3, 5, 50):
            assert by_ranges(data, width) == reference(data), (data, width)


def test_a_range_inside_one_line_stops_at_its_end(monkeypatch):
    monkeypatch.setattr(ranges, "BLOCK", 10)

    class Counting(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            got = super().read(n)
            self.taken += len(got)
            return got

    source = Counting(b"x" * 100_000 + b"\n")
    source.seek(499)
    assert list(ranges.lines_of(source, 500, 600)) == [] and source.taken < 130


def found(spark, path, **kw):
    return sorted((r["path"].rsplit("/", 1)[1], r["offset"], r["line"]) for r in ranges.read_line_ranges(spark, path, **kw).collect())


def test_same_as_the_line_reader(spark, tmp):
    (tmp / "sub dir").mkdir()
    (tmp / "a+b%.txt").write_bytes("eins\nzwei é\r\n\r\ndrei".encode())
    (tmp / "sub dir" / "bom").write_bytes(b"\xef\xbb\xbfone\ntwo\n")
    (tmp / "sub dir" / "cr").write_bytes(b"x\ry\r\rz\n")
    (tmp / "empty").write_bytes(b"")
    (tmp / "_hidden").write_bytes(b"no\n")
    (tmp / "long").write_bytes(b"w " * 300_000 + b"\nend\n")
    want = sorted((r["path"].rsplit("/", 1)[1], r["offset"], r["line"]) for r in read_lines(spark, str(tmp)).collect())
    assert found(spark, str(tmp)) == want and found(spark, str(tmp), range_bytes=1000) == want and len(want) == 12
    assert found(spark, f"{tmp}/a*,{tmp}/sub dir/*", range_bytes=3) == [x for x in want if x[0] not in ("long",)]
    assert found(spark, str(tmp), glob_filter="c*") == [x for x in want if x[0] == "cr"]


def test_a_large_file_without_line_feeds(spark, tmp):
    lines = [b"line %d" % i for i in range(200_000)]
    (tmp / "mac").write_bytes(b"\r".join(lines))
    df = ranges.read_line_ranges(spark, str(tmp), range_bytes=100_000)
    assert df.rdd.getNumPartitions() > 10 and df.count() == 200_000
    at = {r["offset"]: r["line"] for r in df.collect()}
    place = 0
    for x in lines:
        assert at[place] == x.decode()
        place += len(x) + 1


def test_compressed_files(spark, tmp):
    text = b"one\r\ntwo\rthree\n\nfive"
    (tmp / "a.gz").write_bytes(gzip.compress(text))
    (tmp / "b.bz2").write_bytes(bz2.compress(text))
    want = [(o, x.decode()) for o, x in reference(text)]
    got = found(spark, str(tmp), range_bytes=4)
    assert [(o, x) for p, o, x in got if p == "a.gz"] == want == [(o, x) for p, o, x in got if p == "b.bz2"]


def test_no_files(spark, tmp):
    (tmp / "e").write_bytes(b"")
    assert found(spark, str(tmp)) == []
