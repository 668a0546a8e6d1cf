"""Micro-batch execution: triggers, checkpoints, per-batch work.

Every stream here runs through ``foreachBatch``: the batch is an ordinary
DataFrame, so the same functions serve stored data and streams, and each
batch's output is written under its batch id with overwrite (a replayed
batch after a restart replaces, never duplicates).  The checkpoint folder
holds source offsets and commits; one folder per query (STM3).
"""

from __future__ import annotations

import logging
from typing import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.counts import _words

log = logging.getLogger(__name__)

DEFAULT_INTERVAL = 10  # seconds (STM1)


def validate_interval(seconds: int) -> int:
    """STM2: an interval of 1 to 3600 whole seconds."""
    s = int(seconds)
    if not 1 <= s <= 3600:
        raise ValueError(f"interval must be between 1 and 3600 seconds, got {seconds}")
    return s


def trigger_kwargs(interval: int = DEFAULT_INTERVAL, available_now: bool = False) -> dict:
    """STM1/STM8: fixed processing-time trigger, or drain-and-stop for back-fills."""
    if available_now:
        return {"availableNow": True}
    return {"processingTime": f"{validate_interval(interval)} seconds"}


def start(stream: DataFrame, process_batch: Callable[[DataFrame, int], None], checkpoint: str,
          interval: int = DEFAULT_INTERVAL, available_now: bool = False,
          name: str | None = None) -> StreamingQuery:
    """Start ``stream`` with ``process_batch(batch_df, batch_id)`` per micro-batch."""
    w = (stream.writeStream.foreachBatch(process_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(**trigger_kwargs(interval, available_now)))
    if name:
        w = w.queryName(name)
    return w.start()


# --- network counts (AGG2-AGG4, STM5, STM6, LIM1, SNK5) -----------------------

def batch_word_counts(batch: DataFrame, line_col: str = "value") -> tuple[DataFrame, Observation]:
    """Per-word counts of one batch, with line and word totals observed on the
    way (no second pass over the batch, no cache)."""
    obs = Observation("batch_totals")
    lines = batch.select(F.col(line_col).cast("string").alias("line"))
    lines = lines.observe(obs, F.count(F.lit(1)).alias("lines"),
                          F.coalesce(F.sum(F.size(_words("line"))), F.lit(0)).alias("words"))
    per_word = lines.select(F.explode(_words("line")).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))
    return per_word, obs


class CountsSink:
    """Writes each batch's counts under ``<out>/words/batch_id=<id>`` and
    ``<out>/totals/batch_id=<id>`` (overwrite = replay-safe) and optionally
    prints the first ``show`` rows of each, like a console sink (LIM1/SNK5)."""

    def __init__(self, out: str, line_col: str = "value", show: int = 0):
        self.out = out.rstrip("/")
        self.line_col = line_col
        self.show = show

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        per_word, obs = batch_word_counts(batch, self.line_col)
        words = f"{self.out}/words/batch_id={batch_id}"
        per_word.write.mode("overwrite").parquet(words)
        tot = obs.get
        totals = spark.createDataFrame([(int(tot.get("lines") or 0), int(tot.get("words") or 0))],
                                       "lines bigint, words bigint")
        totals.coalesce(1).write.mode("overwrite").parquet(f"{self.out}/totals/batch_id={batch_id}")
        if self.show:
            # the rows just written, not the batch a second time
            totals.show(self.show)
            spark.read.schema(per_word.schema).parquet(words).show(self.show, truncate=False)


def event_time_counts(stream: DataFrame, ts_col: str, line_col: str = "value",
                      every: str = "10 seconds", watermark: str = "1 minute") -> DataFrame:
    """STM6 over event time: lines and words per tumbling window, emitted once
    the watermark passes the window end (append mode).  A ``timestamp_ntz``
    column is cast to ``timestamp`` first (watermarks need it)."""
    ts = F.col(ts_col)
    if stream.schema[ts_col].dataType.simpleString() == "timestamp_ntz":
        stream = stream.withColumn(ts_col, ts.cast("timestamp"))
    w = stream.withWatermark(ts_col, watermark)
    out = w.groupBy(F.window(ts_col, every).alias("w")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.coalesce(F.sum(F.size(_words(F.col(line_col).cast("string")))), F.lit(0)).alias("words"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "lines", "words")
