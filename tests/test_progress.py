"""AGG5/SNK5: reports of batches as a table; UDF1: JVM builders."""

import pytest
from pyspark.errors import PySparkException

from linedocs.operators import documents
from linedocs.plans import jobs
from linedocs.sources import streams as ST
from linedocs.streaming.progress import ProgressTable


def _run(spark, inbox, tmp, table):
    q = jobs.network_counts(spark, ST.read_line_stream(spark, str(inbox), max_files_per_trigger=1), str(tmp / "out"), str(tmp / "ck"), available_now=True)
    q.awaitTermination(60)
    assert q.exception() is None and table.wait(q)
    return q


def test_every_batch_has_a_report(spark, tmp):
    inbox = tmp / "in"
    inbox.mkdir()
    (inbox / "f0").write_text("a\nb\n")
    (inbox / "f1").write_text("c\n")
    with ProgressTable(spark, str(tmp / "p")) as table:
        first = _run(spark, inbox, tmp, table)
        (inbox / "f2").write_text("d\ne\nf\n")
        _run(spark, inbox, tmp, table)
        _run(spark, inbox, tmp, table)  # nothing new: no report is lost to an empty one
    rows = {r["batch_id"]: r for r in table.read().collect()}
    assert sorted(rows) == [0, 1, 2] and sorted(rows[b]["input_rows"] for b in (0, 1)) == [1, 2] and rows[2]["input_rows"] == 3
    assert {r["query_id"] for r in rows.values()} == {str(first.id)} and len({r["run_id"] for r in rows.values()}) == 2
    assert all(r["batch_ms"] > 0 and r["durations_ms"]["triggerExecution"] > 0 and r["sources"][0]["input_rows"] == r["input_rows"] for r in rows.values())


def test_a_report_that_cannot_be_written_does_not_stop_the_stream(spark, tmp, monkeypatch):
    inbox = tmp / "in"
    inbox.mkdir()
    (inbox / "f0").write_text("a\n")
    with ProgressTable(spark, str(tmp / "p")) as table:
        def fail(row):
            raise OSError("full")
        monkeypatch.setattr(table, "_write", fail)
        _run(spark, inbox, tmp, table)
    assert spark.read.parquet(str(tmp / "out" / "totals")).count() == 1


def test_jvm_builder(spark):
    lines = spark.createDataFrame([("/p", 3, "Ab é"), ("/p", 8, None)], documents.OFFSET_DOC)
    documents.jvm_builder("upper", {"line": ("org.apache.commons.lang3.StringUtils", "upperCase", ("line",)), "offset": "offset",
                                    "at": ("java.lang.Long", "toHexString", ("offset",))})
    out = documents.to_documents(lines, "upper")
    assert [tuple(r) for r in out.collect()] == [("AB É", 3, "3"), (None, 8, "8")]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    for of, method in (("no.such.Class", "x"), ("java.lang.Long", "noSuchMethod")):
        documents.jvm_builder("bad", {"x": (of, method, ("line",))})
        with pytest.raises(PySparkException):
            documents.to_documents(lines, "bad")
