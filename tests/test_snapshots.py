"""SNK1/SNK6/SNK7: versioned indexes, jobs that die, bulk files by few writers."""

import json
import os
import signal
import subprocess
import sys
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from linedocs.operators import documents
from linedocs.sinks import writers as W
from linedocs.sinks.snapshots import CommitConflict, SnapshotTable, escaped, unescaped
from linedocs.sources.files import read_lines

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _docs(spark, path, lines):
    return spark.createDataFrame([(path, i, x) for i, x in enumerate(lines)], documents.OFFSET_DOC)


def _lines(spark, out, **kw):
    return sorted((r["index"], r["line"]) for r in W.read_documents(spark, out, documents.OFFSET_DOC, **kw).collect())


def test_replace_by_other_documents_and_by_none(spark, tmp):
    out = str(tmp / "t")
    assert not SnapshotTable(spark, out).exists()
    W.write_documents(_docs(spark, "/p", "ab"), out, "i")
    W.write_documents(_docs(spark, "/q", "z"), out, "j")
    before = W.read_documents(spark, out, documents.OFFSET_DOC)
    W.write_documents(_docs(spark, "/p", "c"), out, "i")
    W.write_documents(_docs(spark, "/p", ""), out, "j")
    assert _lines(spark, out) == [("i", "c")]
    assert sorted(r["line"] for r in before.collect()) == ["a", "b", "z"]  # a reader keeps its snapshot
    assert [_lines(spark, out, version=v) for v in range(5)] == [
        [], [("i", "a"), ("i", "b")], [("i", "a"), ("i", "b"), ("j", "z")], [("i", "c"), ("j", "z")], [("i", "c")]]
    SnapshotTable(spark, out).drop_index("i")
    assert _lines(spark, out) == []
    with pytest.raises(ValueError):
        _lines(spark, out, version=9)


def test_several_indexes_are_published_at_once(spark, tmp):
    out = str(tmp / "t")
    many = _docs(spark, "/p", "abc").withColumn("index", F.concat(F.lit("a:b/c d%="), F.col("line")))
    assert len(W.write_documents(many, out, None).entries) == 3
    assert W.write_documents(many.where("line > 'a'").withColumn("line", F.upper("line")), out, None).version == 2
    assert _lines(spark, out) == [("a:b/c d%=a", "a"), ("a:b/c d%=b", "B"), ("a:b/c d%=c", "C")]
    assert W.write_documents(many.where("false"), out, None).version == 3 and len(_lines(spark, out)) == 3


def test_a_failed_write_publishes_nothing(spark, tmp):
    out = str(tmp / "t")
    W.write_documents(_docs(spark, "/p", "ab"), out, "i")
    bad = _docs(spark, "/p", "xy").withColumn("line", F.when(F.col("offset") == 1, F.raise_error(F.lit("lost"))).otherwise(F.col("line")))
    with pytest.raises(PySparkException):
        W.write_documents(bad, out, "i")

    def refuse():
        raise RuntimeError("incomplete")
    with pytest.raises(RuntimeError, match="incomplete"):
        W.write_documents(_docs(spark, "/p", "xy"), out, "i", check=refuse)
    assert _lines(spark, out) == [("i", "a"), ("i", "b")] and SnapshotTable(spark, out).versions() == [1]


KILLED = """
import sys, time
sys.path.insert(0, {root!r})
from linedocs.session import local_session
from linedocs.operators import documents
from linedocs.plans.jobs import index_text_files
spark = local_session(2)
def slow(frame):
    time.sleep(1)
    return frame[["path", "offset", "line"]].assign(line="new")
documents.python_builder("slow", slow, documents.OFFSET_DOC)
spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
index_text_files(spark, {src!r}, "i", {out!r}, builder="slow")
"""


def test_a_killed_job_leaves_the_old_index(spark, tmp):
    from linedocs.plans.jobs import index_text_files

    src, out = tmp / "src", str(tmp / "t")
    src.mkdir()
    (src / "f").write_text("".join(f"old {i}\n" for i in range(200)))
    index_text_files(spark, str(src), "i", out)
    old = _lines(spark, out)
    job = subprocess.Popen([sys.executable, "-c", KILLED.format(root=ROOT, src=str(src), out=out)], start_new_session=True,
                           stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL, stdin=subprocess.PIPE)
    try:
        data = tmp / "t" / "data"
        deadline = time.time() + 120
        # until its task has begun to write below a second version
        while time.time() < deadline and not any(len(p.parts) for v in data.iterdir() for p in v.rglob("_temporary")):
            assert job.poll() is None
            time.sleep(0.2)
        time.sleep(1)
        assert job.poll() is None and len(list(data.iterdir())) == 2
    finally:
        os.killpg(job.pid, signal.SIGKILL)  # the driver and its JVM: a process group of its own
        job.wait()
    assert _lines(spark, out) == old and len(old) == 200
    table = SnapshotTable(spark, out)
    assert table.expire() == []  # too young
    time.sleep(1.1)
    assert len(table.expire(keep=1, older_than_s=1)) == 1 and _lines(spark, out) == old
    index_text_files(spark, str(src), "i", out)
    assert _lines(spark, out) == old


def test_two_writers_lose_neither_change(spark, tmp, monkeypatch):
    out = str(tmp / "t")
    W.write_documents(_docs(spark, "/p", "a"), out, "i")
    table = SnapshotTable(spark, out)
    stale = table.snapshot()
    W.write_documents(_docs(spark, "/p", "b"), out, "j")
    with pytest.raises(CommitConflict):
        table.commit({("k", "k"): "x"}, base=stale)
    publish, first = table._publish, []

    def late(new):
        if not first:
            first.append(W.write_documents(_docs(spark, "/p", "c"), out, "i"))  # another writer is first
        publish(new)
    monkeypatch.setattr(table, "_publish", late)
    data = table.stage()
    _docs(spark, "/p", "d").write.parquet(table.staged_folder(data) + "/index=k/doc_type=k")
    assert table.commit({("k", "k"): data}).version == 4
    assert _lines(spark, out) == [("i", "c"), ("j", "b"), ("k", "d")]
    assert not [f for f in os.listdir(tmp / "t" / "_commits") if "draft" in f]


def test_expiry_keeps_what_kept_versions_read(spark, tmp):
    out = str(tmp / "t")
    for x in "abcd":
        W.write_documents(_docs(spark, "/p", x), out, "i")
    table = SnapshotTable(spark, out)
    assert table.expire() == [] and table.versions() == [1, 2, 3, 4]
    assert len(table.expire(keep=2, older_than_s=-1)) == 2 and table.versions() == [3, 4]
    assert _lines(spark, out, version=3) == [("i", "c")] and _lines(spark, out) == [("i", "d")]


def test_folder_names():
    for name in ("a:b/c d%", "x=y", "007", "é\x01"):
        assert unescaped(escaped(name)) == name and "/" not in escaped(name)


def _pairs(spark, out):
    """(action, source) by the order of lines in the files."""
    by = {}
    for r in read_lines(spark, out).collect():
        by.setdefault(r["path"], []).append((r["offset"], r["line"]))
    lines = [x for path in sorted(by) for _, x in sorted(by[path])]
    return list(zip(lines[::2], lines[1::2]))


@pytest.mark.parametrize("writers", [None, 1, 2, 7])
def test_bulk_actions_are_followed_by_their_source(spark, tmp, writers):
    docs = spark.range(0, 5000, 1, 9).select(F.concat(F.lit("/p"), F.col("id") % 7).alias("path"), F.col("id").alias("offset"), F.lit("x").alias("line"))
    table, out = str(tmp / "t"), str(tmp / "bulk")
    W.write_documents(docs, table, "i", id_cols=None)
    n = W.write_bulk_from(spark, table, documents.OFFSET_DOC, out, "i", max_writers=writers, task_bytes=5_000)
    assert n == 1 if not writers or writers == 7 else n > 1
    W.write_bulk(docs, str(tmp / "direct"), "i", max_writers=writers)
    ids = {W_id(r["path"], r["offset"]): r["offset"] for r in docs.collect()}
    for place in (out, str(tmp / "direct")):
        pairs = _pairs(spark, place)
        assert len(pairs) == 5000
        assert {ids[json.loads(a)["index"]["_id"]] == json.loads(s)["offset"] for a, s in pairs} == {True}


def W_id(path, offset):
    import hashlib
    return hashlib.sha256(f"{path}\0{offset}".encode()).hexdigest()


@pytest.mark.parametrize("part_bytes", [1, 150, 1000, 100_000])
def test_bulk_pairs_are_read_in_parts(spark, tmp, part_bytes):
    """Pairs are whole wherever a part ends, also behind a line longer than some parts; a last line may be alone."""
    files = {f: [(f"{f} action {i}", f"{f} source {i} " + "x" * (i * i * 7 % (900 if i == 20 else 90))) for i in range(40)] for f in "ab"}
    for f, pairs in files.items():
        (tmp / f).write_text("".join(f"{a}\n{s}\n" for a, s in pairs))
    (tmp / "odd").write_text("alone\n")
    got = W.read_bulk(spark, str(tmp), part_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([*files["a"], *files["b"], ("alone", None)], key=str)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in plan.split("windowspecdefinition(", 1)[1].split(")")[0]  # no whole file in one window


def test_waves_have_about_their_size():
    files = [(f"f{i}", 10) for i in range(7)] + [("big", 1000), ("empty", 0)]
    assert W.waves(files, 30) == [["f0", "f1", "f2"], ["f3", "f4", "f5"], ["f6", "big"], ["empty"]]
    assert W.waves([], 30) == []


THROTTLED = """
import sys
sys.path.insert(0, {root!r})
from linedocs.session import local_session
from linedocs.operators import documents
from linedocs.sinks import writers as W
spark = local_session(6, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": {log!r}, "spark.eventLog.compress": "false",
                                 "spark.eventLog.rolling.enabled": "false"}})
docs = spark.range(0, 200000, 1, 12).selectExpr("concat('/p', id % 5) AS path", "id AS offset", "'x' AS line")
W.write_documents(docs, {table!r}, "i", id_cols=None)
spark.sparkContext.setLocalProperty("phase", "bulk")
W.write_bulk_from(spark, {table!r}, documents.OFFSET_DOC, {out!r}, "i", max_writers=2, task_bytes=50000)
spark.stop()
"""


def test_no_more_tasks_at_a_time_than_writers(tmp):
    (tmp / "log").mkdir()
    subprocess.run([sys.executable, "-c", THROTTLED.format(root=ROOT, log=str(tmp / "log"), table=str(tmp / "t"), out=str(tmp / "b"))],
                   check=True, timeout=300, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    log = next((tmp / "log").iterdir())
    events = [json.loads(x) for x in open(log)]
    stages = {e["Stage Info"]["Stage ID"] for e in events if e["Event"] == "SparkListenerStageSubmitted" and (e.get("Properties") or {}).get("phase") == "bulk"}
    tasks = [e["Task Info"] for e in events if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages]
    marks = sorted([(t["Launch Time"], 1) for t in tasks] + [(t["Finish Time"], -1) for t in tasks])
    running, most = 0, 0
    for _, step in marks:
        running += step
        most = max(most, running)
    assert len(stages) > 2 and len(tasks) > 4 and most <= 2
    plans = [e["physicalPlanDescription"] for e in events if e["Event"].endswith("SparkListenerSQLExecutionStart") and str(tmp / "b") in e["physicalPlanDescription"]]
    assert plans and all("Exchange" not in p for p in plans)
