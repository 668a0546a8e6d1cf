"""FN5 over files: votes on day and month, dates carried over lines and splits."""

import random

import pytest
from pyspark.sql import functions as F

from linedocs.functions.text import iso_text
from linedocs.operators.dates import date_votes, dated_file_lines, voted_time
from linedocs.sources.files import text_files


def _dates(spark, rows, default="dmy"):
    lines = spark.createDataFrame(rows, "path string, line string")
    out = voted_time(lines, ["path"], date_votes(lines, ["path"], default), default)
    return {(r["path"], r["line"]): r["d"] for r in out.select("path", "line", iso_text(F.col("event_time")).alias("d")).collect()}


def test_votes(spark):
    rows = [("a", "03/04/2024 x"), ("a", "25/04/2024 10:11:12 x"), ("b", "03/04/2024 x"), ("b", "x 04/25/2024"), ("b", "31/01/2024"), ("b", "02/28/2024"),
            ("c", "03/04/2024"), (None, "05/06/2024 23:59:59"), (None, "05/16/2024"), ("d", "13/13/2024"), ("d", "30/02/2024"), ("d", "2024-01-02 03:04:05 13/01/2024"),
            ("d", "[12/Mar/2024:01:02:03]"), ("d", "no date"), ("d", ""), ("d", None), ("d", "103/04/2024 03/04/20245"), ("d", "00/10/2024")]
    got = _dates(spark, rows)
    assert got == {
        ("a", "03/04/2024 x"): "2024-04-03T00:00:00", ("a", "25/04/2024 10:11:12 x"): "2024-04-25T10:11:12",
        ("b", "03/04/2024 x"): "2024-03-04T00:00:00", ("b", "x 04/25/2024"): "2024-04-25T00:00:00", ("b", "31/01/2024"): "2024-01-31T00:00:00",
        ("b", "02/28/2024"): "2024-02-28T00:00:00", ("c", "03/04/2024"): "2024-04-03T00:00:00",
        (None, "05/06/2024 23:59:59"): "2024-05-06T23:59:59", (None, "05/16/2024"): "2024-05-16T00:00:00",
        ("d", "13/13/2024"): None, ("d", "30/02/2024"): None, ("d", "2024-01-02 03:04:05 13/01/2024"): "2024-01-02T03:04:05",
        ("d", "[12/Mar/2024:01:02:03]"): "2024-03-12T01:02:03", ("d", "no date"): None, ("d", ""): None, ("d", None): None,
        ("d", "103/04/2024 03/04/20245"): None, ("d", "00/10/2024"): None}
    assert _dates(spark, rows, "mdy")["c", "03/04/2024"] == "2024-03-04T00:00:00"


def test_votes_by_shuffle_join(spark, monkeypatch):
    from linedocs.operators import dates
    monkeypatch.setattr(dates, "BROADCAST_BYTES", 0)
    assert _dates(spark, [("a", "03/04/2024"), ("a", "04/25/2024"), (None, "03/04/2024")]) == {
        ("a", "03/04/2024"): "2024-03-04T00:00:00", ("a", "04/25/2024"): "2024-04-25T00:00:00", (None, "03/04/2024"): "2024-04-03T00:00:00"}


@pytest.mark.parametrize("split", ["64", "1000000"])
def test_carried_over_lines_splits_and_batches(spark, tmp, split):
    r, want = random.Random(3), {}
    for f in range(6):
        last, rows = None, []
        for i in range(r.randrange(1, 60)):
            own = f"2024-01-{r.randrange(1, 29):02d}T00:00:{i:02d}" if r.random() < (.25 if f else 0) else None
            last = own or last
            rows.append((f"{own or ''} line {i} \tat x", last, own is not None))
        (tmp / f"f {f}").write_text("".join(x + "\n" for x, _, _ in rows))
        at = 0
        for x, d, o in rows:
            want[f"f {f}", at] = (d, o, x)
            at += len(x) + 1
    (tmp / "empty").write_text("")
    conf = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "0", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        files = text_files(spark, str(tmp))
        df = dated_file_lines(files)
        rows = df.collect()
        narrow = df.where("not dated and line like '%line 3%'").select("offset", "date").collect()  # a filter takes no date away
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = {(x["path"].rsplit("/", 1)[1], x["offset"]): (x["date"], x["dated"], x["line"]) for x in rows}
    assert got == want
    assert sorted(map(str, (x["date"] for x in narrow))) == sorted(str(d) for d, o, x in want.values() if not o and "line 3" in x)
    plain = {(x["path"].rsplit("/", 1)[1], x["offset"]): x["date"] for x in dated_file_lines(text_files(spark, str(tmp)), carry=False).collect()}
    assert plain == {k: d if o else None for k, (d, o, _) in want.items()}


def test_no_line_is_shuffled(spark, tmp):
    (tmp / "f").write_text("2024-01-02 03:04:05 a\nb\n")
    df = dated_file_lines(text_files(spark, str(tmp)))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    # only the partial votes, a row per file and task, are exchanged
    moved = [plan[i + 1] for i, x in enumerate(plan) if "Exchange hashpartitioning" in x]
    assert moved and all("HashAggregate" in x for x in moved) and not any("Sort" in x or "rangepartitioning" in x for x in plan)
