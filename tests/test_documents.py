"""DOC1-DOC10, UDF1-UDF2."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linedocs.operators import documents as D


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(
        [("hdfs://nn:8020/data/dir2/file2", 10, "six"),
         ("file:/data/file1", 0, "2024-01-02T03:04:05 one")],
        "path string, offset bigint, line string")


def test_offset_documents_and_json(spark, lines):
    docs = D.to_documents(lines, "offset")
    rows = {r["line"]: r for r in docs.collect()}
    assert rows["six"]["path"] == "/data/dir2/file2" and rows["six"]["offset"] == 10
    js = D.json_documents(docs).collect()
    assert js[0]["source"] == '{"path":"/data/dir2/file2","offset":10,"line":"six"}'
    assert ":" not in json.loads(js[0]["source"])["path"]


def test_no_offset_and_prefix_variant(spark, lines):
    assert D.to_documents(lines, "no_offset").columns == ["path", "line"]
    pre = {r["line"]: r["path"] for r in D.to_documents(lines, "prefix_offset").collect()}
    assert pre["six"] == ":8020/data/dir2/file2"


def test_map_documents_conditional_keys(spark):
    df = spark.createDataFrame([("/a", -1, "x", None), ("/b", 3, "y", "2024-01-01T00:00:00")],
                               "path string, offset bigint, line string, date string")
    rows = {r["doc"]["line"]: r["doc"] for r in D.map_documents(df).collect()}
    assert rows["x"] == {"path": "/a", "line": "x"}
    assert rows["y"] == {"path": "/b", "line": "y", "offset": "3", "date": "2024-01-01T00:00:00"}


def test_dated_documents_both_shapes(spark, lines):
    docs = D.to_documents(lines, "dated")
    js = sorted(r[0] for r in D.json_documents(docs, ("path", "offset", "date", "line")).collect())
    assert json.loads(js[0]) == {"path": "/data/dir2/file2", "offset": 10, "line": "six"}
    assert json.loads(js[1])["date"] == "2024-01-02T03:04:05"


def test_stream_shapes(spark):
    msgs = spark.createDataFrame([(None, "m"), ("k", "2024/05/06 07:08:09 hi")], "key string, value string")
    assert [r["line"] for r in D.stream_line_documents(msgs).collect()] == ["m", "2024/05/06 07:08:09 hi"]
    dated = D.stream_dated_line_documents(msgs).collect()
    assert [r["date"] for r in dated] == [None, "2024-05-06T07:08:09"]
    pairs = [r[0] for r in msgs.select(D.pair_text(F.col("key"), F.col("value"))).collect()]
    assert pairs == ["(null,m)", "(k,2024/05/06 07:08:09 hi)"]


def test_registry_and_schema_check(spark, lines):
    assert {"offset", "no_offset", "map", "dated"} <= set(D.builders())
    D.register_builder("bad", lambda df: df.select("line"), D.LINE_DOC)
    with pytest.raises(TypeError):
        D.to_documents(lines, "bad")
    with pytest.raises(KeyError):
        D.to_documents(lines, "nope")


def test_python_builder(spark, lines):
    def upper(pdf):
        return pdf.assign(line=pdf["line"].str.upper())[["path", "offset", "line"]]

    D.python_builder("upper", upper, D.OFFSET_DOC)
    got = sorted(r["line"] for r in D.to_documents(lines, "upper").collect())
    assert got == ["2024-01-02T03:04:05 ONE", "SIX"]


def test_python_builder_with_ddl_schema(spark, lines):
    def path_only(pdf):
        return pdf[["path"]]

    D.python_builder("path_only", path_only, "path string")
    assert D.to_documents(lines, "path_only").count() == 2
