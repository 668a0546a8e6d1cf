"""STR1-STR5, FN5, tokens."""

import pytest
from pyspark.sql import functions as F

from linedocs.functions import text


def _one(spark, col_fn, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(col_fn(F.col("v"))).collect()]


def test_strip_scheme_host_five_cases(spark):
    cases = ["hdfs://nameservice1:8020/path/to/dir", "hdfs://namenode/path/to/dir",
             "hdfs:///path/to/dir", "file:///path/to/dir", "file:/path/to/dir"]
    assert _one(spark, text.strip_scheme_host, cases) == ["/path/to/dir"] * 5


def test_strip_scheme_prefix_variant(spark):
    cases = ["hdfs://nn:8020/a", "hdfs:///a", "hdfs://nn/a", "file:///a", "file:/a"]
    assert _one(spark, text.strip_scheme_prefix, cases) == [":8020/a", "hdfs:///a", "/a", "///a", "/a"]


def test_java_split_space(spark):
    cases = ["a b ", "", "   ", " a  b", " a\tb  ", "a \u2028", "a \u0085"]
    want = [["a", "b"], [""], [], ["", "a", "", "b"], ["", "a\tb"], ["a", "\u2028"], ["a", "\u0085"]]
    assert _one(spark, text.java_split_space, cases) == want


def test_safe_name(spark):
    assert _one(spark, text.safe_name, ["my-index.v1", "a b/c_d"]) == ["my-index_v1", "a_b_c_d"]


def test_split_list():
    assert text.split_list("a, b,,c") == ["a", "b", "c"]
    assert text.split_list(["x", "y"]) == ["x", "y"]


@pytest.mark.parametrize("line,want", [
    ("2024-01-02T03:04:05 started", "2024-01-02T03:04:05"),
    ("at 2024-01-02 03:04:05 x", "2024-01-02T03:04:05"),
    ("2024/01/02 03:04:05 view", "2024-01-02T03:04:05"),
    ('1.2.3.4 - - [02/Jan/2024:03:04:05 +0000] "GET /"', "2024-01-02T03:04:05"),
    ("day 2024-01-02 only", "2024-01-02T00:00:00"),
    ("no date here", None),
    ("bad 2024-13-45 date", None),
    ("2024-01-02T03:04:05.123Z done", "2024-01-02T03:04:05"),
    ("at 2024-01-02T03:04:05+02:00", "2024-01-02T03:04:05"),
    ("first 2024/05/06 07:08:09 then 2024-01-02", "2024-05-06T07:08:09"),
])
def test_detect_date(spark, line, want):
    assert _one(spark, text.detect_date, [line]) == [want]


def test_tokens(spark):
    assert _one(spark, text.tokens, ["Hé, llo  WORLD!", ""]) == [["hé", "llo", "world"], []]


def test_decode_file_uri(spark):
    assert _one(spark, text.decode_file_uri, ["file:/a%20b/c+d%25"]) == ["file:/a b/c+d%"]


def test_token_predicates_agree_with_tokens(spark):
    lines = ["The cat", "bathe the", "theme", "x-THE-y", "méthe the", "", "me", "a me b", "ame", "9me"]
    df = spark.createDataFrame([(s,) for s in lines], "v string")
    rows = df.select("v", text.tokens("v").alias("t"), text.has_token("v", "the").alias("h"),
                     text.has_token_prefix("v", "me*").alias("p")).collect()
    for r in rows:
        assert r["h"] == ("the" in r["t"]), r
        assert r["p"] == any(t.startswith("me") for t in r["t"]), r


def test_times_ignore_the_session_zone(spark):
    from linedocs.functions.text import detect_date
    lines = [("2024-03-10 02:30:00 gap", "2024-03-10T02:30:00"), ("[10/Mar/2024:02:30:00 +0100]", "2024-03-10T02:30:00"),
             ("2024/03/10 02:59:59", "2024-03-10T02:59:59"), ("12024-01-105", None), ("x2024-01-10y", "2024-01-10T00:00:00"),
             ("99/Xyz/2024:00:00:00", None), ("2024-13-01", None), ("2024-02-30 01:02:03", None), ("31/Dec/2023:23:59:59", "2023-12-31T23:59:59")]
    df = spark.createDataFrame(lines, "line string, date string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for r in df.select("line", "date", detect_date("line").alias("got")).collect():
                assert r["got"] == r["date"], (zone, r["line"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_search_terms_of_several_tokens(spark):
    import pytest
    from linedocs.functions.text import has_token, has_token_prefix
    df = spark.createDataFrame([("a foo-bar b",), ("foo bar",), ("foobar",), ("xfoo bar",)], "line string")
    assert [r["line"] for r in df.where(has_token("line", "foo-bar")).collect()] == ["a foo-bar b", "foo bar"]
    assert df.where(has_token_prefix("line", "foo b*")).count() == 2
    for term in ("", "*", " - "):
        with pytest.raises(ValueError):
            has_token("line", term)
