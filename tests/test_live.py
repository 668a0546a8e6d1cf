"""STM7 on live streams: rows of idle intervals, by the clock and by event time."""

import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from linedocs.streaming import live

SCHEMA = "ts timestamp, value string, who string"


def _put(spark, source, rows):
    spark.createDataFrame([(datetime(2024, 1, 1) + timedelta(seconds=s), v, w) for s, v, w in rows], SCHEMA).coalesce(1).write.mode("append").parquet(source)


def _run(spark, source, out, checkpoint, **kw):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(source)
    q = live.start(spark, live.interval_counts(stream, "10 seconds", ts_col="ts", **kw), out, checkpoint, available_now=True)
    q.awaitTermination(120)
    assert q.exception() is None


def _rows(spark, out):
    rows = live.read(spark, out).select("counter", (F.unix_seconds("window_start") - 1704067200).alias("s"), "lines", "words").collect()
    return sorted(map(tuple, rows))


def test_event_time_gaps_disorder_and_restart(spark, tmp):
    source, out, checkpoint = (str(tmp / x) for x in ("in", "out", "ck"))
    _put(spark, source, [(25, "a b", "x"), (31, "c", "x")])
    _put(spark, source, [(4, "early", "x"), (33, "", "x"), (29, None, "x")])  # an earlier interval than the first one seen
    _run(spark, source, out, checkpoint, watermark="30 seconds")
    _put(spark, source, [(95, "p q r", "x")])
    _run(spark, source, out, checkpoint, watermark="30 seconds")
    _put(spark, source, [(400, None, "x")])
    _run(spark, source, out, checkpoint, watermark="30 seconds")
    want = {0: (1, 1), 20: (1, 2), 30: (2, 2), 90: (1, 3)}
    assert _rows(spark, out) == [("", s, *want.get(s, (0, 0))) for s in range(0, 370, 10)]


def test_counters_have_intervals_of_their_own(spark, tmp):
    source, out, checkpoint = (str(tmp / x) for x in ("in", "out", "ck"))
    _put(spark, source, [(5, "a", "x"), (26, "b c", "y"), (27, "d", None)])
    _put(spark, source, [(100, None, "z")])
    _run(spark, source, out, checkpoint, watermark="10 seconds", counter="who")
    rows = _rows(spark, out)
    assert [r[1:] for r in rows if r[0] == "x"] == [(0, 1, 1)] + [(s, 0, 0) for s in range(10, 90, 10)]
    assert [r[1:] for r in rows if r[0] == "y"] == [(20, 1, 2)] + [(s, 0, 0) for s in range(30, 90, 10)]
    assert [r[1:] for r in rows if r[0] == ""] == [(20, 1, 1)] + [(s, 0, 0) for s in range(30, 90, 10)]


def test_a_long_idle_time_comes_in_frames(spark, tmp, monkeypatch):
    monkeypatch.setattr(live, "FRAME", 7)
    source, out, checkpoint = (str(tmp / x) for x in ("in", "out", "ck"))
    _put(spark, source, [(0, "a", "x")])
    _put(spark, source, [(1000, None, "x")])
    _run(spark, source, out, checkpoint, watermark="0 seconds")
    assert _rows(spark, out) == [("", 0, 1, 1)] + [("", s, 0, 0) for s in range(10, 1000, 10)]


def test_the_clock_counts_idle_intervals(spark, tmp):
    """Nothing, two lines, nothing: a row for every interval while the query runs, and after a restart."""
    source, out, checkpoint = (str(tmp / x) for x in ("in", "out", "ck"))
    (tmp / "in").mkdir()

    def run(seconds, act=None):
        stream = spark.readStream.schema("value string").text(source)
        q = live.start(spark, live.interval_counts(stream, "1 second"), out, checkpoint, interval=1)
        end = time.time() + seconds
        while time.time() < end and q.isActive:
            time.sleep(0.5)
            if act and q.lastProgress:
                act()
                act = None
        q.stop()
        assert q.exception() is None

    def two_lines():
        (tmp / "in" / "f.txt").write_text("a b\nc\n")

    run(16, two_lines)
    rows = _rows(spark, out)
    assert [r[2:] for r in rows if r[2]] == [(2, 3)] and len([r for r in rows if not r[2]]) >= 3
    assert [b[1] - a[1] for a, b in zip(rows, rows[1:])] == [1] * (len(rows) - 1)
    run(10)
    again = _rows(spark, out)
    assert len(again) > len(rows) and sum(r[2] for r in again) == 2
    assert [b[1] - a[1] for a, b in zip(again, again[1:])] == [1] * (len(again) - 1)
