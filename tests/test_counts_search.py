"""AGG1-AGG8, STM6-STM7, RET1-RET7, ORD1 and stored-text lines."""

import datetime as dt

from pyspark.sql import functions as F

from linedocs.operators import counts as C
from linedocs.operators import search as S
from linedocs.sources.stored import explode_lines


def test_explode_lines_offsets(spark):
    df = spark.createDataFrame([(1, "ab\nçd\n"), (2, ""), (3, None), (4, "x")], "id long, text string")
    rows = sorted((r["id"], r["line_no"], r["offset"], r["line"])
                  for r in explode_lines(df, keep=["id"], line_no=True).collect())
    assert rows == [(1, 0, 0, "ab"), (1, 1, 3, "çd"), (1, 2, 7, ""), (2, 0, 0, ""), (4, 0, 0, "x")]


def test_batch_and_word_counts(spark):
    df = spark.createDataFrame([("a b a",), ("b c",), ("c",)], "line string")
    tot = C.batch_counts(df).first()
    assert (tot["lines"], tot["words"]) == (3, 6)
    assert {r["word"]: r["n"] for r in C.word_counts(df).collect()} == {"a": 2, "b": 2, "c": 2}


def test_windows_and_zero_fill(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(t + dt.timedelta(seconds=s), l) for s, l in [(1, "a b"), (5, "c"), (31, "d")]]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, line string")
    w = sorted((r["window_start"].second, r["lines"], r["words"]) for r in C.windowed_counts(df, "ts").collect())
    assert w == [(0, 2, 3), (30, 1, 1)]
    z = sorted((r["window_start"].second, r["lines"]) for r in C.zero_filled_counts(df, "ts").collect())
    assert z == [(0, 2), (10, 0), (20, 0), (30, 1)]
    ww = sorted((r["window_start"].second, r["word"], r["n"]) for r in C.windowed_word_counts(df, "ts").collect())
    assert ww[0] == (0, "a", 1) and len(ww) == 4


def test_observed_precount(spark):
    df, obs = C.observed(spark.range(17))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["records"] == 17


def test_manifest_and_reconcile(spark):
    m = C.count_manifest(spark, "/in", "my-index.v1", None, None, 3).first()
    assert (m["count"], m["name"], m["doc_type"]) == ("uncounted", "my-index_v1", "my-index.v1")
    m2 = C.count_manifest(spark, "/in", "i", "t", 6, 0).first()
    assert m2["count"] == "6"
    src = spark.createDataFrame([("a",), ("a",), ("b",)], "index string")
    idx = spark.createDataFrame([("a",), ("c",)], "index string")
    got = {r["index"]: (r["source_n"], r["indexed_n"], r["diff"]) for r in C.reconcile(src, idx).collect()}
    assert got == {"a": (2, 1, 1), "b": (1, 0, 1), "c": (0, 1, -1)}


def test_search_operators(spark):
    docs = spark.createDataFrame(
        [("/f", 0, "Hello me world", "i", "t"), ("/f", 15, "memory lane", "i", "t"),
         ("/g", 0, "other", "j", "t")],
        "path string, offset bigint, line string, index string, doc_type string")
    assert S.total_hits(docs).first()["total"] == 3
    assert [r["offset"] for r in S.first_page(docs, 2).collect()] == [0, 15]
    assert S.term_search(docs, "HELLO").count() == 1
    assert S.prefix_search(docs, "me*").count() == 2
    assert S.find_documents(docs, path="/f", offset=15).count() == 1
    assert S.in_index(docs, "i", "t").count() == 2
    assert [r["path"] for r in S.original_order(docs).collect()] == ["/f", "/f", "/g"]
    dated = docs.withColumn("event_time", F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
    assert S.time_range(dated, "2024-01-01", "2024-01-06").count() == 3
    assert S.time_range(dated, "2024-01-06", "2024-01-07").count() == 0
    assert S.time_range(dated, "2024-01-01", "2024-01-05").count() == 3


def test_text_line_totals_and_weighted_reconcile(spark):
    df = spark.createDataFrame([("a", "x\ny"), ("a", ""), ("b", None), ("b", "z\n")], "index string, text string")
    tot = {r["index"]: r["lines"] for r in C.text_line_totals(df, by=["index"]).collect()}
    assert tot == {"a": 3, "b": 2}
    idx = spark.createDataFrame([("a",)] * 3 + [("b",)], "index string")
    got = {r["index"]: r["diff"] for r in C.reconcile(C.text_line_totals(df, by=["index"]), idx,
                                                      source_weight="lines").collect()}
    assert got == {"a": 0, "b": 1}


def test_zero_filled_counts_of_both_time_types_in_any_zone(spark):
    from linedocs.operators.counts import zero_filled_counts
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for kind in ("timestamp", "timestamp_ntz"):
                df = spark.createDataFrame([("2024-03-09 23:59:58", "a b"), ("2024-03-10 00:00:31", "c")], "t string, line string")
                out = zero_filled_counts(df.withColumn("t", df["t"].cast(kind)), "t").selectExpr(
                    "cast(window_start as string) s", "lines", "words").orderBy("s").collect()
                assert [tuple(r) for r in out] == [("2024-03-09 23:59:50", 1, 2), ("2024-03-10 00:00:00", 0, 0), ("2024-03-10 00:00:10", 0, 0),
                                                   ("2024-03-10 00:00:20", 0, 0), ("2024-03-10 00:00:30", 1, 1)], (zone, kind)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
