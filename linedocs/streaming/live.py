"""STM7 on live streams: a row of counts for every interval, also for those in which nothing arrives.

A counter is a stateful operator with timers.  Its state is the interval that is due next and the counts of the
intervals that are still open; a timer at the end of the due interval emits it, with zeros if it is empty, and sets the
next timer.  State and timers are in the checkpoint, so a restarted query goes on with the interval that was due.
Lines are counted in the tasks that read them: one row per Arrow batch, counter and interval reaches the state.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.counts import _seconds, _words
from . import runner

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "counter string, start long, lines long, words long"
#: Rows per frame of a long idle time.
FRAME = 100_000


class IntervalCounts(StatefulProcessor):
    """Counts per interval of ``every`` seconds and counter.

    By the clock, a line belongs to the interval in which its batch runs, and an interval is due when the
    clock has passed it.  By event time, it belongs to that of its own time, and an interval is due when the
    watermark has passed it."""

    def __init__(self, every: int, by_clock: bool):
        self.every, self.by_clock = every, by_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "start long")
        self.open = handle.getValueState("open", "start array<long>, lines array<long>, words array<long>")

    def _now(self, timers) -> int:
        return (timers.getCurrentProcessingTimeInMs() if self.by_clock else max(0, timers.getCurrentWatermarkInMs())) // 1000

    def _begin(self, start: int) -> None:
        self.due.update((start,))
        self.handle.registerTimer((start + self.every) * 1000)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if self.by_clock:
            now = self._now(timerValues)
            self._begin(now - now % self.every)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows))[["start", "lines", "words"]]  # counts of Arrow batches, not lines
        if self.by_clock:
            now = self._now(timerValues)
            frame["start"] = now - now % self.every
        if self.open.exists():
            frame = pd.concat([frame, pd.DataFrame(dict(zip(("start", "lines", "words"), self.open.get())))])
        total = frame.groupby("start", as_index=False).sum()
        first = int(total["start"].min())
        if not self.due.exists():
            self._begin(first)
        elif not self.by_clock and first < self.due.get()[0]:
            # an earlier interval than the first one seen; none has been emitted, or the watermark were past it
            self.handle.deleteTimer((self.due.get()[0] + self.every) * 1000)
            self._begin(first)
        self._keep(total)
        return iter(())

    def _keep(self, total: pd.DataFrame) -> None:
        self.open.update(tuple(total[c].astype("int64").tolist() for c in ("start", "lines", "words")))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, due = self._now(timerValues), self.due.get()[0]
        end = due + max(1, (now - due) // self.every) * self.every
        held = self.open.get() if self.open.exists() else ([], [], [])
        total = pd.DataFrame(dict(zip(("start", "lines", "words"), held))).astype("int64").set_index("start").sort_index()
        self._keep(total[total.index >= end].reset_index())
        self._begin(end)
        for a in range(due, end, FRAME * self.every):
            starts = np.arange(a, min(end, a + FRAME * self.every), self.every)
            out = total.reindex(starts, fill_value=0).reset_index(names="start")
            # plain objects: several frames of Arrow strings would be chunked, which a struct column cannot be
            yield out.assign(counter=pd.Series([key[0]] * len(out), dtype=object))[["counter", "start", "lines", "words"]]

    def close(self) -> None:
        pass


def interval_counts(stream: DataFrame, every: str = "10 seconds", line_col: str = "value", ts_col: str | None = None,
                    watermark: str = "1 minute", counter: str | None = None) -> DataFrame:
    """STM7: counter, window_start, window_end, lines and words of every interval of a stream, without gaps.

    Without ``ts_col`` intervals follow the clock, from the start of the query on (from a counter's first line, if
    ``counter`` names a column to count by); the trigger should be no longer than the interval.  With it they follow
    that time, from the first interval with a line to the last that the watermark has passed.  A null line is none
    (it only moves the watermark).  Needs the RocksDB state store; ``start`` sets it for its query."""
    spark, secs = stream.sparkSession, _seconds(every)
    line = F.col(line_col).cast("string")
    ts = F.col(ts_col).cast("timestamp") if ts_col else F.lit(None).cast("timestamp")
    key = F.coalesce(F.col(counter).cast("string"), F.lit("")) if counter else F.lit("")
    start = F.floor(F.unix_seconds(ts) / secs).cast("long") * secs
    rows = stream.select(key.alias("counter"), F.coalesce(start, F.lit(0).cast("long")).alias("start"), ts.alias("at"), line.isNotNull().cast("long").alias("lines"),
                         F.when(line.isNotNull(), F.size(_words(line))).otherwise(0).cast("long").alias("words"))

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.groupby(["counter", "start"], as_index=False, sort=False).agg({"at": "max", "lines": "sum", "words": "sum"})[list(b.columns)]

    part = rows.mapInPandas(added, rows.schema)
    if ts_col:
        part = part.withWatermark("at", watermark)
    initial = None
    if not ts_col and not counter:
        initial = spark.range(1).select(F.lit("").alias("counter")).groupBy("counter")
    counted = part.groupBy("counter").transformWithStateInPandas(
        IntervalCounts(secs, not ts_col), OUTPUT, "append", "eventTime" if ts_col else "processingTime", initialState=initial)
    return counted.select("counter", F.timestamp_seconds("start").alias("window_start"),
                          F.timestamp_seconds(F.col("start") + secs).alias("window_end"), "lines", "words")


@contextmanager
def state_store(spark: SparkSession, provider: str = ROCKSDB):
    """The state store for queries started inside: a query takes the setting along when it starts."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, provider)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def start(spark: SparkSession, counts: DataFrame, out: str, checkpoint: str, interval: int = runner.DEFAULT_INTERVAL,
          available_now: bool = False) -> StreamingQuery:
    """Write ``interval_counts`` as ``<out>/batch_id=<id>``, replaced when a batch is repeated."""
    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")

    with state_store(spark):
        return runner.start(counts, keep, checkpoint, interval, available_now)


def read(spark: SparkSession, out: str) -> DataFrame:
    """The intervals written by ``start``."""
    schema = "counter string, window_start timestamp, window_end timestamp, lines long, words long, batch_id int"
    return spark.read.schema(schema).parquet(out).drop("batch_id")
