"""Plan-shape checks for the properties the design relies on at scale."""

import re

from pyspark.sql import functions as F

from linedocs.operators.counts import word_counts
from linedocs.plans import catalog
from linedocs.sources.files import read_lines
from linedocs.sources.stored import explode_lines


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _ops(df):
    return [m.group(1) for m in (re.match(r"^[\s:+\-*()0-9]*([A-Z][A-Za-z]+)", ln)
                                 for ln in _plan(df).splitlines()) if m]


def test_file_lines_are_never_shuffled(spark, tmp):
    for i in range(3):
        (tmp / f"f{i}").write_bytes(b"a\nbb\nccc\n" * 50)
    plan = _plan(read_lines(spark, str(tmp)))
    # pass 2 has no shuffle at all: the small per-split table (materialised by
    # pass 1) is broadcast, the text scan feeds the UDF and the join directly
    assert "Exchange hashpartitioning" not in plan
    assert "BroadcastExchange" in plan and "BroadcastHashJoin" in plan
    text_branch = plan.split("BroadcastExchange")[0]
    assert "Scan text" in text_branch or "FileScan text" in text_branch
    assert "Exchange" not in text_branch.split("ArrowEvalPython")[1]


def test_word_counts_aggregate_before_the_shuffle(spark):
    df = spark.range(0, 1000, numPartitions=8).select(F.concat_ws(" ", F.lit("w"), (F.col("id") % 7).cast("string")).alias("line"))
    ops = _ops(word_counts(df))
    i = ops.index("Exchange")
    assert ops[i - 1] == "HashAggregate" and ops[i + 1] == "HashAggregate"


def test_stored_lines_add_no_shuffle_whatever_the_input(spark):
    for parts in (1, 2, 64):
        df = spark.range(0, 100, numPartitions=parts).select("id", F.lit("a\nb").alias("text"))
        assert "Exchange" not in _plan(explode_lines(df, keep=["id"]))


def test_words_per_role_aggregate_before_their_only_shuffle(spark):
    import __spark_entry__ as E
    ops = _ops(E.queries()["words_per_role"](spark, "/root/testdata/sf0.001"))
    assert ops.count("Exchange") == 1
    i = ops.index("Exchange")
    assert ops[i - 1] == "HashAggregate" and ops[i + 1] == "HashAggregate"


def test_throttle_moves_no_row_and_starts_no_job(spark, tmp):
    from linedocs.sinks.writers import bulk_lines, throttle
    for i in range(12):
        (tmp / f"f{i}").write_bytes(b"x\n" * 2_000_000)
    df = spark.read.text(str(tmp))
    scan = df.rdd.getNumPartitions()
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    out = bulk_lines(throttle(df, 2), "i", id_cols=None)
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert out.rdd.getNumPartitions() == 2 and scan > 2 and "Exchange" not in _plan(out) and "Coalesce 2" in _plan(out)
    assert throttle(df, None) is df


def test_no_row_caps_except_the_first_page(spark):
    import os
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    for name, fn in catalog.QUERIES.items():
        ops = set(_ops(fn(spark, sf)))
        capped = ops & {"GlobalLimit", "LocalLimit", "CollectLimit", "TakeOrderedAndProject", "Sample"}
        if name == "first_page":
            assert capped == {"TakeOrderedAndProject"}
        else:
            assert not capped, (name, capped)
