"""SRC1-SRC7, SRC3 offsets, SET1: text files -> (path, offset, line)."""

import gzip
import random

import pytest

from linedocs.sources.files import read_lines, text_files


def _hadoop(spark, path):
    """Oracle: Hadoop's own TextInputFormat (offset, line) pairs."""
    rdd = spark.sparkContext.newAPIHadoopFile(
        str(path), "org.apache.hadoop.mapreduce.lib.input.TextInputFormat",
        "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.Text")
    return sorted((int(k), v) for k, v in rdd.collect())


def _rows(df):
    return sorted((r["offset"], r["line"]) for r in df.collect())


def test_golden_six_documents(spark, tmp):
    (tmp / "file1").write_bytes(b"one\ntwo\nthree\n")
    (tmp / "dir2").mkdir()
    (tmp / "dir2" / "file2").write_bytes(b"four\nfive\nsix\n")
    rows = read_lines(spark, str(tmp)).collect()
    assert len(rows) == 6
    got = {(r["path"].rsplit("/", 1)[1], r["line"]): r["offset"] for r in rows}
    assert got == {("file1", "one"): 0, ("file1", "two"): 4, ("file1", "three"): 8,
                   ("file2", "four"): 0, ("file2", "five"): 5, ("file2", "six"): 10}
    six = [r for r in rows if r["line"] == "six"][0]
    assert six["path"].endswith("/dir2/file2") and six["path"].startswith("file:")


def test_mixed_line_ends(spark, tmp):
    p = tmp / "e1"
    p.write_bytes(b"aa\r\nbb\rcc\r\n\r\ndd")
    assert _rows(read_lines(spark, str(p))) == [(0, "aa"), (4, "bb"), (7, "cc"), (11, ""), (13, "dd")]
    assert _rows(read_lines(spark, str(p))) == _hadoop(spark, p)


def test_bom(spark, tmp):
    p = tmp / "e2"
    p.write_bytes(b"\xef\xbb\xbf" + "héllo\nworld\n".encode())
    assert _rows(read_lines(spark, str(p))) == [(0, "héllo"), (10, "world")]
    q = tmp / "e2b"
    q.write_bytes(b"\xef\xbb\xbfab\ncd")
    assert _rows(read_lines(spark, str(q))) == [(0, "ab"), (6, "cd")]


def test_invalid_utf8_offsets(spark, tmp):
    p = tmp / "e3"
    p.write_bytes(b"\xff\xfe\x80x\nnext\n")
    rows = _rows(read_lines(spark, str(p)))
    assert rows[1] == (5, "next")


def test_many_splits(spark, tmp):
    p = tmp / "e4"
    raw = "".join(f"line number {i} {'x' * (i % 7)}\n" for i in range(40)).encode()
    p.write_bytes(raw)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    try:
        df = read_lines(spark, str(p))
        rows = _rows(df)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 40
    for off, line in rows:
        assert raw[off:off + len(line.encode())].decode() == line


def test_random_line_ends_match_hadoop(spark, tmp):
    rnd = random.Random(7)
    pieces = ["\n", "\r", "\r\n", "ab", "x", " ", "é", "日本", "\r\r\n", "zz\n"]
    for i in range(6):
        p = tmp / f"r{i}.txt"
        p.write_bytes("".join(rnd.choice(pieces) for _ in range(200)).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        for i in range(6):
            p = tmp / f"r{i}.txt"
            assert _rows(read_lines(spark, str(p))) == _hadoop(spark, p), p
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gzip_offsets_are_decompressed_positions(spark, tmp):
    p = tmp / "e5.gz"
    with gzip.open(p, "wb") as f:
        f.write(b"alpha\nbeta\ngamma\n")
    assert _rows(read_lines(spark, str(p))) == [(0, "alpha"), (6, "beta"), (11, "gamma")]


def test_hidden_and_empty_files(spark, tmp):
    (tmp / "_x").write_bytes(b"no\n")
    (tmp / ".y").write_bytes(b"no\n")
    (tmp / "empty").write_bytes(b"")
    (tmp / "real").write_bytes(b"yes\n")
    assert [r["line"] for r in read_lines(spark, str(tmp)).collect()] == ["yes"]


def test_odd_names_decoded(spark, tmp):
    d = tmp / "a dir+%"
    d.mkdir()
    (d / "f é+1%.txt").write_bytes(b"q\n")
    rows = read_lines(spark, str(tmp)).collect()
    assert rows[0]["path"] == "file:" + str(d / "f é+1%.txt")


def test_comma_list_glob_and_overlap(spark, tmp):
    (tmp / "a").mkdir()
    (tmp / "b").mkdir()
    (tmp / "a" / "1.txt").write_bytes(b"a1\n")
    (tmp / "b" / "2.txt").write_bytes(b"b2\nb3\n")
    both = read_lines(spark, f"{tmp}/a,{tmp}/b").collect()
    assert sorted(r["line"] for r in both) == ["a1", "b2", "b3"]
    glob = read_lines(spark, f"{tmp}/*/2.txt").collect()
    assert sorted(r["line"] for r in glob) == ["b2", "b3"]
    overlap = read_lines(spark, [f"{tmp}/a", f"{tmp}/a/1.txt"]).collect()
    assert [r["line"] for r in overlap] == ["a1"]


def test_precount_from_split_table(spark, tmp):
    (tmp / "f").write_bytes(b"a\r\nb\rc\nd")
    tf = text_files(spark, str(tmp))
    assert tf.line_count() == 4
    assert tf.lines().count() == 4


def test_missing_path_fails(spark, tmp):
    with pytest.raises(Exception):
        read_lines(spark, str(tmp / "nope")).collect()


def test_cr_only_file_matches_hadoop(spark, tmp):
    p = tmp / "mac.txt"
    p.write_bytes(b"".join(f"l{i}{'x' * (i % 5)}\r".encode() for i in range(500)))
    rows = _rows(read_lines(spark, str(p)))
    assert len(rows) == 500
    assert rows == _hadoop(spark, p)


def test_shuffle_join_beyond_broadcast_bound(spark, tmp):
    (tmp / "a").write_bytes(b"one\ntwo\n")
    (tmp / "b").write_bytes(b"x\r\ny\n")
    tf = text_files(spark, str(tmp), broadcast_bytes=0)
    df = tf.lines()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan or "AdaptiveSparkPlan" in plan
    got = sorted((r["path"].rsplit("/", 1)[1], r["offset"], r["line"]) for r in df.collect())
    assert got == [("a", 0, "one"), ("a", 4, "two"), ("b", 0, "x"), ("b", 3, "y")]


def test_bz2_offsets_are_decompressed_positions_across_splits(spark, tmp):
    import bz2
    # several bz2 blocks (100 kB of text each at level 1), so that several
    # splits really hold records
    rnd = random.Random(3)
    raw = "".join(f"row {i} {rnd.random():.12f} {'y' * (i % 9)}\n" for i in range(30000)).encode()
    p = tmp / "big.txt.bz2"
    p.write_bytes(bz2.compress(raw, compresslevel=1))
    expected = []
    pos = 0
    for line in raw.split(b"\n")[:-1]:
        expected.append((pos, line.decode()))
        pos += len(line) + 1
    assert _rows(read_lines(spark, str(p))) == expected
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(64, p.stat().st_size // 5)))
    try:
        tf = text_files(spark, str(p))
        assert tf.splits().count() > 1  # really read as several splits
        assert _rows(tf.lines()) == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gzip_bulk_output_round_trip(spark, tmp):
    from linedocs.sinks.writers import write_bulk
    (tmp / "in").mkdir()
    (tmp / "in" / "f").write_bytes(b"a\nb\n")
    docs = read_lines(spark, str(tmp / "in"))
    write_bulk(docs, str(tmp / "bulk"), "i", compression="gzip")
    assert list((tmp / "bulk").glob("*.gz"))
    assert spark.read.text(str(tmp / "bulk")).count() == 4


def test_plain_lines_without_offsets(spark, tmp):
    from linedocs.sources.files import read_plain_lines
    (tmp / "d").mkdir()
    (tmp / "d" / "f").write_bytes(b"a\r\nb\rc\n")
    rows = sorted((r["path"].rsplit("/", 1)[1], r["line"]) for r in read_plain_lines(spark, str(tmp)).collect())
    assert rows == [("f", "a"), ("f", "b"), ("f", "c")]


def test_glob_filter_option(spark, tmp):
    (tmp / "a.log").write_bytes(b"keep\n")
    (tmp / "b.txt").write_bytes(b"drop\n")
    rows = text_files(spark, str(tmp), glob_filter="*.log").lines().collect()
    assert [r["line"] for r in rows] == ["keep"]


def test_large_cr_only_file_is_linear(spark, tmp):
    import time
    n = 100_000
    p = tmp / "mac-big.txt"
    p.write_bytes(b"".join(f"r{i}\r".encode() for i in range(n)))
    t0 = time.time()
    df = read_lines(spark, str(p))
    last = df.filter(f"line = 'r{n - 1}'").first()
    assert last["offset"] == p.stat().st_size - len(f"r{n - 1}") - 1
    assert df.count() == n
    assert time.time() - t0 < 90


def _key(r):
    return r["path"], r["offset"], r["line"]


def test_replanned_splits_lose_nothing(spark, tmp):
    """Other split settings between the passes, and after the DataFrame was made: all lines
    with exact offsets, or an error; never fewer rows."""
    import pytest as _pytest
    from pyspark.errors import PySparkException
    data = b"".join(b"line %07d of one file\n" % i for i in range(120_000))
    (tmp / "big").write_bytes(data)
    for i in range(9):
        (tmp / f"small{i}").write_bytes(data[:30_000 * i])
    names = {"spark.sql.leafNodeDefaultParallelism": ("4", "7", "1", "13"),
             "spark.sql.files.maxPartitionBytes": ("400000", "130000", "1100000", "77777"),
             "spark.sql.files.minPartitionNum": ("3", "11", "1", "40")}
    expected = sorted(map(_key, read_lines(spark, str(tmp)).collect()))
    assert len(expected) == 120_000 + sum(d.count(b"\n") + (not d.endswith(b"\n") and len(d) > 0)
                                           for d in (data[:30_000 * i] for i in range(9)))
    outcomes = set()
    for name, (first, *later) in names.items():
        old = spark.conf.get(name, None)
        try:
            spark.conf.set(name, first)
            tf = text_files(spark, str(tmp))
            assert tf.line_count() == len(expected)
            df = tf.lines()
            for value in later:
                spark.conf.set(name, value)
                for frame in (tf.lines(), df.where("true")):
                    try:
                        assert sorted(map(_key, frame.collect())) == expected
                        outcomes.add("exact")
                    except PySparkException as e:
                        assert "planned anew" in str(e)
                        outcomes.add("error")
        finally:
            spark.conf.unset(name) if old is None else spark.conf.set(name, old)
    assert "error" in outcomes and "exact" in outcomes
    assert _pytest


def test_braces_in_a_comma_list(spark, tmp):
    for d in ("a", "b", "c"):
        (tmp / d).mkdir()
        (tmp / d / "x.log").write_text(f"{d}\n")
    lines = read_lines(spark, f"{tmp}/{{a,b}}/*.log, {tmp}/c")
    assert sorted(r["line"] for r in lines.collect()) == ["a", "b", "c"]


def test_jobs_at_a_time_keep_their_pinned_splits(spark):
    from linedocs.sources.files import SPLIT_COUNT, pinned_splits
    assert spark.conf.get(SPLIT_COUNT, None) is None
    first, second = pinned_splits(spark), pinned_splits(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(SPLIT_COUNT) == str(spark.sparkContext.defaultParallelism)  # the other job is still reading
    with pinned_splits(spark.newSession()):
        pass
    assert spark.conf.get(SPLIT_COUNT, None) is not None
    second.__exit__(None, None, None)
    assert spark.conf.get(SPLIT_COUNT, None) is None
    spark.conf.set(SPLIT_COUNT, "3")
    try:
        with pinned_splits(spark):
            assert spark.conf.get(SPLIT_COUNT) == "3"
        assert spark.conf.get(SPLIT_COUNT) == "3"
    finally:
        spark.conf.unset(SPLIT_COUNT)
