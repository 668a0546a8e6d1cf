"""SNK1-SNK7 and the batch indexer end to end (golden six documents)."""

import json

from pyspark.sql import types as T

from linedocs.operators import documents
from linedocs.operators import search as S
from linedocs.plans.jobs import index_text_files
from linedocs.sinks import writers as W


def _stored(spark, out, schema=documents.OFFSET_DOC, fmt="parquet", extra=None):
    return W.read_documents(spark, out, schema, fmt, extra)


ID = {"_id": T.StringType()}


def _golden(tmp):
    src = tmp / "search-data"
    (src / "dir2").mkdir(parents=True)
    (src / "file1").write_bytes(b"one\ntwo\nthree\n")
    (src / "dir2" / "file2").write_bytes(b"four\nfive\nsix\n")
    return src


def test_index_text_files_golden(spark, tmp):
    src = _golden(tmp)
    out, man = str(tmp / "table"), str(tmp / "manifests")
    res = index_text_files(spark, str(src), "my-index.v1", out, count=True, manifest_dir=man,
                           bulk_out=str(tmp / "bulk"))
    assert res.records == 6 and res.count == "6" and res.doc_type == "my-index.v1"
    docs = _stored(spark, out)
    assert S.total_hits(docs).first()["total"] == 6
    assert S.in_index(docs, "my-index.v1", "my-index.v1").count() == 6
    six = S.find_documents(docs, line="six").first()
    assert six["offset"] == 10 and six["path"].endswith("/search-data/dir2/file2")
    assert ":" not in six["path"]
    m = spark.read.json(res.manifest).first()
    assert res.manifest.endswith("my-index_v1.count") and m["count"] == "6"
    bulk = [r[0] for r in spark.read.text(str(tmp / "bulk")).collect()]
    assert len(bulk) == 12
    sources = [json.loads(b) for b in bulk if not b.startswith('{"index"')]
    assert {"path", "offset", "line"} == set(sources[0])
    # rerun: same ids, same index replaced, no duplicates
    index_text_files(spark, str(src), "my-index.v1", out)
    again = _stored(spark, out, extra=ID)
    assert again.count() == 6 and again.select("_id").distinct().count() == 6


def test_uncounted_manifest(spark, tmp):
    src = _golden(tmp)
    res = index_text_files(spark, str(src), "idx", str(tmp / "t"), manifest_dir=str(tmp / "m"))
    assert res.records is None and res.count == "uncounted"
    assert spark.read.json(res.manifest).first()["count"] == "uncounted"


def test_other_index_untouched(spark, tmp):
    src = _golden(tmp)
    out = str(tmp / "t")
    index_text_files(spark, str(src), "a", out)
    index_text_files(spark, str(src / "dir2"), "b", out)
    index_text_files(spark, str(src / "dir2"), "a", out)
    got = {r["index"]: r["total"] for r in S.total_hits(_stored(spark, out), ["index"]).collect()}
    assert got == {"a": 3, "b": 3}


def test_document_id_deterministic(spark):
    df = spark.createDataFrame([("/p", 1)], "path string, offset bigint")
    a = df.select(W.document_id("path", "offset")).first()[0]
    import hashlib
    assert a == hashlib.sha256(b"/p\x001").hexdigest()


def test_batch_text_replay_overwrites(spark, tmp):
    df = spark.createDataFrame([("x",), ("y",)], "value string")
    p1 = W.write_batch_text(df, str(tmp), 3)
    p2 = W.write_batch_text(df, str(tmp), 3)
    assert p1 == p2 and p1.endswith("data-3.txt")
    assert sorted(r[0] for r in spark.read.text(p1).collect()) == ["x", "y"]


def test_index_connector_missing_fails_loudly(spark):
    import pytest
    df = spark.createDataFrame([("/p", 0, "x", "id")], "path string, offset bigint, line string, _id string")
    with pytest.raises(Exception):
        W.save_to_index(df, "idx/t", "localhost:9200")


def test_command_line_index(spark, tmp, capsys):
    from linedocs.__main__ import main
    src = _golden(tmp)
    assert main(["index", "--path", str(src), "--index", "cli", "--out", str(tmp / "t"), "--count"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["records"] == 6 and out["count"] == "6" and out["doc_type"] == "cli"
    assert _stored(spark, str(tmp / "t")).count() == 6


def test_command_line_counts(spark, tmp):
    from linedocs.__main__ import main
    (tmp / "in").mkdir()
    (tmp / "in" / "a.txt").write_text("p q p\n")
    assert main(["counts", "--dir", str(tmp / "in"), "--out", str(tmp / "o"), "--checkpoint",
                 str(tmp / "ck"), "--available-now", "--show", "0"]) == 0
    tot = spark.read.parquet(str(tmp / "o" / "totals")).first()
    assert (tot["lines"], tot["words"]) == (1, 3)
    assert main(["counts", "--dir", str(tmp / "in"), "--out", str(tmp / "o2"), "--checkpoint", str(tmp / "ck2"), "--available-now",
                 "--show", "0", "--progress-out", str(tmp / "p")]) == 0
    assert spark.read.json(str(tmp / "p")).first()["input_rows"] == 1


def test_command_line_expire(spark, tmp, capsys):
    from linedocs.__main__ import main
    docs = spark.createDataFrame([("/p", 0, "x")], documents.OFFSET_DOC)
    for _ in range(3):
        W.write_documents(docs, str(tmp / "t"), "i")
    assert main(["expire", "--out", str(tmp / "t"), "--keep", "1"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"expired": []}
    assert main(["expire", "--out", str(tmp / "t"), "--keep", "1", "--older-than", "-1"]) == 0
    assert len(json.loads(capsys.readouterr().out.strip().splitlines()[-1])["expired"]) == 2
    assert _stored(spark, str(tmp / "t")).count() == 1


def test_json_document_table(spark, tmp):
    src = _golden(tmp)
    index_text_files(spark, str(src), "j", str(tmp / "t"), fmt="json", builder="no_offset",
                     bulk_out=str(tmp / "bulk"))
    assert spark.read.text(str(tmp / "bulk")).count() == 12
    rows = _stored(spark, str(tmp / "t"), documents.LINE_DOC, "json").collect()
    assert len(rows) == 6 and set(rows[0].asDict()) == {"path", "line", "index", "doc_type"}


def test_repeated_lines_without_offsets_keep_all_documents(spark, tmp):
    (tmp / "in").mkdir()
    (tmp / "in" / "f").write_bytes(b"same\nsame\n")
    res = index_text_files(spark, str(tmp / "in"), "r", str(tmp / "t"), builder="no_offset",
                           bulk_out=str(tmp / "bulk"))
    assert _stored(spark, str(tmp / "t"), documents.LINE_DOC).count() == 2
    bulk = [r[0] for r in spark.read.text(str(tmp / "bulk")).collect()]
    assert len(bulk) == 4 and all('"_id"' not in b for b in bulk)
    assert res.count == "uncounted"


def test_command_line_rejects_missing_arguments():
    import pytest
    from linedocs.__main__ import main
    for argv in (["totext"], ["toindex", "--brokers", "b"], ["index", "--path", "p"], [],
                 ["counts", "--dir", "d", "--out", "o", "--checkpoint", "c", "--available-now", "--intervals-out", "i"]):
        with pytest.raises(SystemExit):
            main(argv)


def test_reindexing_an_emptied_source_clears_its_index_only(spark, tmp):
    from linedocs.operators import documents
    from linedocs.sinks.writers import read_documents, write_documents
    docs = spark.createDataFrame([("/p", 0, "x"), ("/p", 2, "y")], "path string, offset bigint, line string")
    out = str(tmp / "t")
    for index in ("007", "a:b/c d%"):
        write_documents(docs, out, index)
    table = read_documents(spark, out, documents.OFFSET_DOC)
    assert {r["index"]: r["count"] for r in table.groupBy("index").count().collect()} == {"007": 2, "a:b/c d%": 2}
    write_documents(docs.where("false"), out, "007")
    assert {r["index"] for r in read_documents(spark, out, documents.OFFSET_DOC).select("index").distinct().collect()} == {"a:b/c d%"}


def test_index_job_to_the_connector(spark, tmp, monkeypatch):
    """The connector is not installed: what the job would hand to it."""
    from linedocs.plans import jobs
    from linedocs.sinks import writers
    (tmp / "f").write_text("a\nb\n")
    seen = {}

    def take(docs, resource, nodes, id_col="_id", fmt=None, max_writers=None, options=None):
        seen.update(resource=resource, nodes=nodes, id_col=id_col, columns=docs.columns, rows=docs.count(), writers=max_writers)
        docs.write.format("noop").mode("overwrite").save()

    monkeypatch.setattr(writers, "save_to_index", take)
    res = jobs.index_text_files(spark, str(tmp), "i", nodes="h:9200", count=True, max_writers=3)
    assert res.records == 2 and seen == {"resource": "i/i", "nodes": "h:9200", "id_col": "_id", "columns": ["path", "offset", "line", "_id"],
                                         "rows": 2, "writers": 3}


def test_stored_time_prunes_the_scan(spark):
    from linedocs.plans.end_to_end import q_date_range_stored
    plan = q_date_range_stored(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_time" in plan and "PartitionFilters: [isnotnull(index" in plan and "regexp" not in plan.lower()
