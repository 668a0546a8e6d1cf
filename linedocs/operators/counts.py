"""Line, word and per-word counts; windows; pre-count; manifest; reconcile.

All counts are ``bigint``.  Aggregations are plain ``groupBy().agg()``: Catalyst
plans a partial (map-side) hash aggregate before the shuffle and a final one
after it, so a word that makes up a third of all words still leaves each map
task as a single partial row.  Word totals use ``size(words)`` and never
explode; only per-word counts explode.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import java_split_space, safe_name


def _words(line_col: str | Column) -> Column:
    c = F.col(line_col) if isinstance(line_col, str) else line_col
    return java_split_space(c)


def batch_counts(df: DataFrame, line_col: str = "line", by: list[str] | None = None) -> DataFrame:
    """AGG2 + AGG3: number of lines and of words (optionally per group)."""
    aggs = [F.count(F.lit(1)).alias("lines"),
            F.coalesce(F.sum(F.size(_words(line_col))), F.lit(0)).cast("bigint").alias("words")]
    return df.groupBy(*(by or [])).agg(*aggs)


def word_counts(df: DataFrame, line_col: str = "line", by: list[str] | None = None) -> DataFrame:
    """AGG4: occurrences per word (``word string, n bigint``)."""
    by = list(by or [])
    words = df.select(*by, F.explode(_words(line_col)).alias("word"))
    return words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"))


def _window(ts: Column, every: str) -> Column:
    return F.window(ts, every)


def windowed_counts(df: DataFrame, ts_col: str, line_col: str = "line",
                    every: str = "10 seconds", by: list[str] | None = None) -> DataFrame:
    """STM6 on stored, event-timed data: lines and words per tumbling window."""
    by = list(by or [])
    w = df.select(*by, _window(F.col(ts_col), every).alias("w"), F.col(line_col).alias("_l"))
    out = batch_counts(w, "_l", by=by + ["w"])
    return out.select(*by, F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), "lines", "words")


def windowed_word_counts(df: DataFrame, ts_col: str, line_col: str = "line",
                         every: str = "10 seconds") -> DataFrame:
    """AGG4 per tumbling window: ``window_start, window_end, word, n``."""
    w = df.select(_window(F.col(ts_col), every).alias("w"), F.col(line_col).alias("_l"))
    out = word_counts(w, "_l", by=["w"])
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "word", "n")


def _seconds(every: str) -> int:
    n, unit = every.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600}
    return int(n) * mult[unit]


def zero_filled_counts(df: DataFrame, ts_col: str, line_col: str = "line",
                       every: str = "10 seconds") -> DataFrame:
    """STM7: one row per window from the first to the last, idle windows as 0.

    The grid is generated by ``spark.range`` (distributed, one row per
    window) from two scalars, the first and last window start; the data and
    the grid meet in one union + aggregate, so there is a single shuffle and
    no join.
    """
    spark = df.sparkSession
    secs = _seconds(every)
    w = df.select(_window(F.col(ts_col), every).start.alias("window_start"),
                  F.lit(1).cast("bigint").alias("l"),
                  F.size(_words(line_col)).cast("bigint").alias("wd"))
    # windows as whole seconds: no time passes through the driver's or the session's zone
    zoned = w.schema["window_start"].dataType.simpleString() == "timestamp"
    at = (F.unix_seconds("window_start") if zoned
          else F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', window_start)"))
    bounds = w.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    if bounds["lo"] is None:
        return w.select("window_start", F.col("window_start").alias("window_end"),
                        F.col("l").alias("lines"), F.col("wd").alias("words")).where("false")
    n = (bounds["hi"] - bounds["lo"]) // secs + 1
    seconds = F.col("id") * secs + bounds["lo"]
    start = (F.timestamp_seconds(seconds) if zoned
             else F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
                 F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")))
    grid = spark.range(0, n).select(start.alias("window_start"), F.lit(0).cast("bigint").alias("l"),
                                    F.lit(0).cast("bigint").alias("wd"))
    total = w.unionByName(grid).groupBy("window_start").agg(
        F.sum("l").alias("lines"), F.sum("wd").alias("words"))
    return total.select(
        "window_start",
        (F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(secs)))
        .alias("window_end"), "lines", "words")


# --- AGG1 pre-count without a second job -------------------------------------

def observed(df: DataFrame, name: str = "records") -> tuple[DataFrame, Observation]:
    """AGG1: attach a row counter to ``df``; the count is known once an action
    on the returned DataFrame finishes (``obs.get["records"]``), no extra pass.

    Place it after the last filter: it counts the rows that pass that point.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("records")), obs


# --- AGG6 / AGG7 / AGG8 -------------------------------------------------------

MANIFEST_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("index", T.StringType()),
    T.StructField("doc_type", T.StringType()),
    T.StructField("records", T.LongType()),
    T.StructField("count", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("secs", T.LongType()),
])


@dataclass
class Timer:
    """AGG8: whole seconds elapsed on the driver clock."""
    start: float = 0.0

    def __post_init__(self):
        self.start = time.time()

    def secs(self) -> int:
        return int(time.time() - self.start)


def count_manifest(spark: SparkSession, path: str, index: str, doc_type: str | None,
                   records: int | None, secs: int) -> DataFrame:
    """AGG7: one-row manifest; ``count`` is the number or ``uncounted``.

    ``name`` is the file-safe form of the index name (STR4).
    """
    df = spark.createDataFrame([(path, index, doc_type or index, records, secs)],
                               "path string, index string, doc_type string, records bigint, secs bigint")
    return df.select("path", "index", "doc_type", "records",
                     F.coalesce(F.col("records").cast("string"), F.lit("uncounted")).alias("count"),
                     safe_name(F.col("index")).alias("name"), "secs")


def reconcile(source: DataFrame, indexed: DataFrame, key: str | list[str] = "index",
              source_weight: str | None = None, indexed_weight: str | None = None) -> DataFrame:
    """AGG6: compare per-key counts read from the source and found in the
    written table; ``source_n``/``indexed_n`` are 0 when a side lacks the key.

    Each side is one row per record, or carries a count column (``*_weight``)
    when it has been pre-aggregated (e.g. lines per text).  Both sides are
    aggregated per key before the full outer join, so the join is between
    two small tables already hash-partitioned on the key.
    """
    keys = [key] if isinstance(key, str) else list(key)

    def per_key(df: DataFrame, weight: str | None, name: str) -> DataFrame:
        n = F.sum(F.col(weight)).cast("bigint") if weight else F.count(F.lit(1))
        return df.groupBy(*keys).agg(n.alias(name))

    j = per_key(source, source_weight, "source_n").join(
        per_key(indexed, indexed_weight, "indexed_n"), keys, "full_outer")
    return j.select(*keys,
                    F.coalesce("source_n", F.lit(0)).alias("source_n"),
                    F.coalesce("indexed_n", F.lit(0)).alias("indexed_n"),
                    (F.coalesce("source_n", F.lit(0)) - F.coalesce("indexed_n", F.lit(0))).alias("diff"))


def text_line_totals(df: DataFrame, text_col: str = "text", by: list[str] | None = None) -> DataFrame:
    """AGG2 for stored texts without exploding: lines of a text =
    ``size(split(text, LF))``; a null text has none."""
    t = F.col(text_col)
    n = F.when(t.isNotNull(), F.size(F.split(t, "\n", -1))).otherwise(F.lit(0))
    return df.groupBy(*(by or [])).agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("lines"))
