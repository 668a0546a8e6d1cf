"""STM1-STM8, SRC8-SRC11 option mapping, per-batch sinks with restart."""

import pytest

from linedocs.plans import jobs
from linedocs.sources import streams as ST
from linedocs.streaming import runner as R


def test_interval_validation():
    assert R.trigger_kwargs(10) == {"processingTime": "10 seconds"}
    assert R.trigger_kwargs(available_now=True) == {"availableNow": True}
    for bad in (0, 3601):
        with pytest.raises(ValueError):
            R.validate_interval(bad)


def test_topic_and_socket_options():
    o = ST.topic_options("b1:9092, b2:9092", "t1,t2", min_partitions=4, max_offsets_per_trigger=1000)
    assert o["kafka.bootstrap.servers"] == "b1:9092,b2:9092" and o["subscribe"] == "t1,t2"
    assert o["minPartitions"] == "4" and o["maxOffsetsPerTrigger"] == "1000"
    assert ST.socket_options("localhost", 9999) == {"host": "localhost", "port": "9999"}
    with pytest.raises(ValueError):
        ST.socket_options("h", 0)


def test_kafka_source_not_installed_fails_loudly(spark):
    # the connector is not part of this install: the reader must not fake it
    with pytest.raises(Exception):
        ST.read_topic(spark, "localhost:9092", "t")


def _drain(q):
    q.processAllAvailable()
    q.awaitTermination(60)


def test_network_counts_two_batches_and_restart(spark, tmp):
    inbox, out, ck = tmp / "in", str(tmp / "out"), str(tmp / "ck")
    inbox.mkdir()
    (inbox / "f0.txt").write_text("a b a\n")
    lines = ST.read_line_stream(spark, str(inbox), max_files_per_trigger=1)
    _drain(jobs.network_counts(spark, lines, out, ck, available_now=True))
    (inbox / "f1.txt").write_text("b c\nc\n")
    _drain(jobs.network_counts(spark, ST.read_line_stream(spark, str(inbox), 1), out, ck, available_now=True))
    tot = {r["batch_id"]: (r["lines"], r["words"]) for r in spark.read.parquet(out + "/totals").collect()}
    assert tot == {0: (1, 3), 1: (2, 3)}
    words = {(r["batch_id"], r["word"]): r["n"] for r in spark.read.parquet(out + "/words").collect()}
    assert words == {(0, "a"): 2, (0, "b"): 1, (1, "b"): 1, (1, "c"): 2}
    # restart with nothing new: no extra batch
    _drain(jobs.network_counts(spark, ST.read_line_stream(spark, str(inbox), 1), out, ck, available_now=True))
    assert spark.read.parquet(out + "/totals").count() == 2


def test_topic_to_text_pairs(spark, tmp):
    src = tmp / "msgs"
    src.mkdir()
    spark.createDataFrame([(None, "m"), ("k", "v")], "key string, value string").write.parquet(str(src / "b0"))
    msgs = spark.readStream.schema("key string, value string").parquet(str(src / "b0"))
    _drain(jobs.topic_to_text(spark, msgs, str(tmp / "out"), str(tmp / "ck"), available_now=True,
                              counts_out=str(tmp / "counts")))
    got = sorted(r[0] for r in spark.read.text(str(tmp / "out" / "data-0.txt")).collect())
    assert got == ["(k,v)", "(null,m)"]
    assert [(r["batch_id"], r["messages"]) for r in spark.read.parquet(str(tmp / "counts")).collect()] == [(0, 2)]


def test_topic_to_index_dated(spark, tmp):
    src = tmp / "msgs"
    spark.createDataFrame([("2024-01-02T03:04:05 hi",), ("plain",)], "value string").write.parquet(str(src))
    msgs = spark.readStream.schema("value string").parquet(str(src))
    _drain(jobs.topic_to_index(spark, msgs, str(tmp / "idx"), "logs", str(tmp / "ck"), available_now=True))
    rows = {r["line"]: r["date"] for r in spark.read.parquet(str(tmp / "idx")).collect()}
    assert rows == {"2024-01-02T03:04:05 hi": "2024-01-02T03:04:05", "plain": None}


def test_file_stream_documents_exact_offsets(spark, tmp):
    inbox = tmp / "in"
    (inbox / "d").mkdir(parents=True)
    (inbox / "d" / "f2").write_bytes(b"four\nfive\nsix\n")
    recs = ST.read_text_stream(spark, str(inbox))
    _drain(jobs.file_stream_documents(spark, recs, str(tmp / "idx"), "files", str(tmp / "ck"),
                                      available_now=True))
    got = sorted((r["offset"], r["line"]) for r in spark.read.parquet(str(tmp / "idx")).collect())
    assert got == [(0, "four"), (5, "five"), (10, "six")]


def test_event_time_counts_watermark(spark, tmp):
    import datetime as dt
    src = tmp / "ev"
    t = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(t + dt.timedelta(seconds=s), "a b") for s in (1, 2, 15, 200)],
                          "ts timestamp_ntz, value string").write.parquet(str(src))
    st = spark.readStream.schema("ts timestamp_ntz, value string").parquet(str(src))
    q = (R.event_time_counts(st, "ts", watermark="0 seconds").writeStream.outputMode("append")
         .format("memory").queryName("etc").option("checkpointLocation", str(tmp / "ck"))
         .trigger(availableNow=True).start())
    _drain(q)
    got = sorted((r["lines"], r["words"]) for r in spark.sql("select * from etc").collect())
    assert (2, 4) in got and (1, 2) in got


EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.mark.skipif(not __import__("os").path.exists(EVENTS), reason="test data not present")
def test_event_time_stream_equals_stored_windows(spark, tmp):
    from linedocs.operators.counts import windowed_counts
    stored = {(r["window_start"].isoformat(), r["lines"], r["words"])
              for r in windowed_counts(spark.read.parquet(EVENTS), "ts", "props").collect()}
    st = (spark.readStream.schema(spark.read.parquet(EVENTS).schema)
          .option("pathGlobFilter", "events.parquet").parquet("/root/testdata/sf0.001"))
    q = (R.event_time_counts(st, "ts", "props").writeStream.outputMode("complete")
         .format("memory").queryName("ev_windows").option("checkpointLocation", str(tmp / "ck"))
         .trigger(availableNow=True).start())
    _drain(q)
    streamed = {(r["window_start"].replace(tzinfo=None).isoformat(), r["lines"], r["words"])
                for r in spark.sql("select * from ev_windows").collect()}
    assert streamed == stored and len(stored) > 100


@pytest.mark.skipif(not __import__("os").path.exists(EVENTS), reason="test data not present")
def test_topic_to_text_on_events_equals_pair_text(spark, tmp):
    from pyspark.sql import functions as F
    from linedocs.plans import catalog
    ev = spark.read.parquet(EVENTS)
    src = tmp / "msgs"
    (ev.select(F.when(F.col("event_type") != "signup", F.col("user_id").cast("string")).alias("key"),
               F.col("props").alias("value"))
       .write.parquet(str(src)))
    msgs = spark.readStream.schema("key string, value string").parquet(str(src))
    _drain(jobs.topic_to_text(spark, msgs, str(tmp / "out"), str(tmp / "ck"), available_now=True))
    written = sorted(r[0] for r in spark.read.text(str(tmp / "out" / "data-*.txt")).collect())
    expected = sorted(r["text"] for r in catalog.q_pair_text(spark, "/root/testdata/sf0.001").collect())
    assert written == expected


def test_stored_lines_on_a_stream(spark, tmp):
    from linedocs.sources.stored import explode_lines
    src = tmp / "t"
    spark.createDataFrame([(1, "ab\ncd")], "id long, text string").write.parquet(str(src))
    st = spark.readStream.schema("id long, text string").parquet(str(src))
    q = (explode_lines(st, keep=["id"]).writeStream.format("memory").queryName("st_lines")
         .option("checkpointLocation", str(tmp / "ck")).trigger(availableNow=True).start())
    _drain(q)
    assert sorted((r["offset"], r["line"]) for r in spark.sql("select * from st_lines").collect()) == [
        (0, "ab"), (3, "cd")]


def test_file_stream_documents_two_batches(spark, tmp):
    import os
    import time as _t
    inbox = tmp / "in"
    inbox.mkdir()
    (inbox / "f1").write_bytes(b"one\ntwo\n")
    os.utime(inbox / "f1", (_t.time() - 10, _t.time() - 10))
    (inbox / "f2").write_bytes(b"three\r\nfour\n")
    recs = ST.read_text_stream(spark, str(inbox), max_files_per_trigger=1)
    _drain(jobs.file_stream_documents(spark, recs, str(tmp / "idx"), "files", str(tmp / "ck"),
                                      available_now=True))
    got = sorted((r["batch_id"], r["path"].rsplit("/", 1)[1], r["offset"], r["line"])
                 for r in spark.read.parquet(str(tmp / "idx")).collect())
    assert got == [(0, "f1", 0, "one"), (0, "f1", 4, "two"), (1, "f2", 0, "three"), (1, "f2", 7, "four")]
