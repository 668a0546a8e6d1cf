"""FN5 over whole files: what one line cannot tell about its date, the others of its file do.

* ``03/04/2024`` is the third of April or the fourth of March.  Lines that can only be read one way vote for the order of
  their file; the votes are an aggregate with a row per file that has such dates, joined back to its lines.
* A line without a date (the rest of a stack trace) has that of the last dated line before it in its file.  Within
  an input split the last date is carried along as the task streams its lines; what a split starts with comes from
  the last dates of the splits before it, one row each.  No line is sorted or shuffled.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import DATE_FORMATS, iso_of_found, iso_text
from ..session import work_dir
from ..sources.files import TextFiles

#: Two numbers that are day and month, the year, and a time or none.
TWO_ORDERS = r"\d{2}/\d{2}/\d{4}(?: \d{2}:\d{2}:\d{2})?"
ANY_DATE = r"(?<!\d)(?:" + "|".join([p for _, p, _ in DATE_FORMATS] + [TWO_ORDERS]) + r")(?!\d)"
DAY_FIRST, MONTH_FIRST = "dmy", "mdy"
#: A row of votes in a broadcast: key, order, row header and hash table entry.
VOTE_ROW_BYTES = 256
BROADCAST_BYTES = 256 * 1024 * 1024


def _two_orders(found: Column) -> Column:
    return F.substring(found, 3, 1) == "/"


def is_two_orders(found: Column) -> Column:
    """A date whose day and month are both numbers (``12/Mar/2024`` has the same slash)."""
    return _two_orders(found) & F.substring(found, 6, 1).eqNullSafe("/")


def order_of(found: Column) -> Column:
    """The one order in which a date can be read; null if it can be read in both or is of another format."""
    first, second = F.substring(found, 1, 2), F.substring(found, 4, 2)
    return F.when(is_two_orders(found) & (first > "12") & (second <= "12"), DAY_FIRST).when(
        is_two_orders(found) & (second > "12") & (first <= "12"), MONTH_FIRST)


def date_votes(lines: DataFrame, keys: list[str], default: str = DAY_FIRST, line: str = "line") -> DataFrame:
    """(keys, order) of the files that have dates of two orders: that of the majority of the lines which can be read
    in one way only, ``default`` at a tie or without any."""
    found = F.regexp_extract(line, ANY_DATE, 0)
    dated = lines.select(*keys, found.alias("_found")).where(is_two_orders(F.col("_found")))
    margin = F.sum(F.when(order_of(F.col("_found")) == DAY_FIRST, 1).when(order_of(F.col("_found")) == MONTH_FIRST, -1).otherwise(0))
    return dated.groupBy(*keys).agg(F.when(margin > 0, DAY_FIRST).when(margin < 0, MONTH_FIRST).otherwise(default).alias("order"))


def voted_time(lines: DataFrame, keys: list[str], votes: DataFrame, default: str = DAY_FIRST, line: str = "line",
               column: str = "event_time") -> DataFrame:
    """``lines`` with the time of the first date in each, read in the order that its file voted for (null: none, or
    an impossible date).  A date that can be read in one way only is read that way whatever the vote.

    The votes come by broadcast if they fit one, counted before; else by a shuffle on the file."""
    small = votes.count() * VOTE_ROW_BYTES <= BROADCAST_BYTES
    v = votes.select(*[F.col(k).alias(f"_v_{k}") for k in keys], "order")
    on = [F.col(k).eqNullSafe(F.col(f"_v_{k}")) for k in keys]
    joined = lines.join(F.broadcast(v) if small else v, on, "left").withColumn("_found", F.regexp_extract(line, ANY_DATE, 0))
    found = F.col("_found")
    order = F.coalesce(order_of(found), "order", F.lit(default))
    first, second, year = F.substring(found, 1, 2), F.substring(found, 4, 2), F.substring(found, 7, 4)
    day, month = (F.when(order == DAY_FIRST, a).otherwise(b) for a, b in ((first, second), (second, first)))
    slashed = F.concat(year, F.lit("-"), month, F.lit("-"), day, F.substring(found, 11, 9))
    time = F.when(is_two_orders(found), slashed.try_cast("timestamp_ntz")).otherwise(iso_of_found(found))
    return joined.withColumn(column, time).drop("_found", "order", *[f"_v_{k}" for k in keys])


@F.arrow_udf(T.LongType())
def _carried_in_split(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The last value at or before each row of its split (null: none yet in it), all batches of a task in scan order."""
    key, last = None, None
    for file, block, value in batches:
        n = len(value)
        if not n:
            yield pa.array([], pa.int64())
            continue
        valid = np.asarray(value.is_valid())
        v = np.asarray(value.fill_null(0), dtype=np.int64)
        f, b = np.asarray(file.fill_null(0), dtype=np.int64), np.asarray(block.fill_null(-1), dtype=np.int64)
        new = np.ones(n, bool)
        new[1:] = (f[1:] != f[:-1]) | (b[1:] != b[:-1])
        new[0] = (int(f[0]), int(b[0])) != key
        run = np.maximum.accumulate(np.where(new, np.arange(n), -1))  # -1: the run goes on from the batch before
        at = np.maximum.accumulate(np.where(valid, np.arange(n), -1))
        seen = (at >= 0) & (at >= run)
        out = np.where(seen, v[at.clip(min=0)], 0 if last is None else last)
        known = seen | ((run < 0) & (last is not None))
        yield pa.array(out, pa.int64(), mask=~known)
        key, last = (int(f[-1]), int(b[-1])), int(out[-1]) if known[-1] else None


# a filter pushed below it would take the dates of the rows that it drops
_carried_in_split = _carried_in_split.asNondeterministic()

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def dated_file_lines(files: TextFiles, default: str = DAY_FIRST, carry: bool = True) -> DataFrame:
    """path, offset, date (ISO text), dated (the line has a date of its own) and line of every line of ``files``.

    Dates of two orders are read as the file's lines vote; with ``carry`` a line without a date has that of the last
    dated line before it in its file, null before the first.  The lines are scanned for the votes, for the last
    dates of the splits, and for the result; they stay in the task that reads them."""
    spark = files.spark
    lines = files.lines(split=True)
    timed = voted_time(lines, ["_f1", "_f2"], date_votes(lines, ["_f1", "_f2"], default), default)
    seconds = F.timestamp_diff("SECOND", F.expr(EPOCH), F.col("event_time"))
    timed = timed.withColumn("_at", seconds).drop("event_time")
    own = F.col("_at")
    if carry:
        last = timed.where("_at is not null").groupBy("_f1", "_f2", "_blk").agg(F.max_by("_at", "offset").alias("_last"))
        # every split has a row, also one without any date
        splits = files.splits().select("_f1", "_f2", "_blk").join(last, ["_f1", "_f2", "_blk"], "left")
        before = Window.partitionBy("_f1", "_f2").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
        starts = splits.select("_f1", "_f2", "_blk", F.last("_last", ignorenulls=True).over(before).alias("_before"))
        place = work_dir(spark, "split-dates")
        starts.write.parquet(place)
        starts = spark.read.schema(starts.schema).parquet(place)
        if files.splits_fit_broadcast():
            starts = F.broadcast(starts)
        timed = timed.withColumn("_in_split", _carried_in_split("_f1", "_blk", "_at")).join(starts, ["_f1", "_f2", "_blk"], "left")
        own = F.coalesce("_in_split", "_before")
    date = iso_text(F.expr(EPOCH) + F.make_dt_interval(secs=own.cast("decimal(18,6)")))
    return timed.select("path", "offset", date.alias("date"), F.col("_at").isNotNull().alias("dated"), "line")
