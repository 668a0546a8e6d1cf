"""Lines of texts that are already stored in a table column.

A row of a table such as ``documents`` holds a whole text.  Its lines and the
byte offset of each line are produced in the same task that read the row:
there is no shuffle and no window, so a single huge text costs time linear in
its size and never moves between executors.

The offsets need a prefix sum over each row's line lengths.  Spark has no
linear-time array prefix sum (``aggregate`` with an array accumulator copies
the array at each step), so the lengths are computed JVM-side and handed to
one Arrow-batched UDF that runs a single vectorised cumulative sum over the
whole batch; only integer arrays cross to Python, the text never does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.arrow_udf(T.ArrayType(T.LongType()))
def exclusive_prefix_sums(lengths: pa.Array) -> pa.Array:
    """Per list: ``[0, l0, l0+l1, ...]`` (same length as the input list)."""
    if isinstance(lengths, pa.ChunkedArray):
        lengths = lengths.combine_chunks()
    offsets = np.asarray(lengths.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    values = np.asarray(lengths.flatten().fill_null(0), dtype=np.int64)
    running = np.cumsum(values) - values  # exclusive over the whole batch
    starts = np.append(running, 0)[offsets[:-1]]
    counts = np.diff(offsets)
    local = running - np.repeat(starts, counts)
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)), pa.array(local, pa.int64()),
        mask=lengths.is_null())


def split_lines(text: Column) -> Column:
    """Lines of a stored text, split on LF only; a trailing LF gives a final ""."""
    return F.split(text, "\n", -1)


def explode_lines(df: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                  line_no: bool = False, offsets: bool = True) -> DataFrame:
    """One row per line: ``keep`` columns + [line_no] + offset + line.

    ``offset`` is the byte offset (UTF-8) of the line inside the text, the
    same number a line reader gives for a file holding that text.  With
    ``offsets=False`` (counts, totals) the prefix sum is skipped altogether:
    the optimizer cannot drop an unused field of a generated struct itself.
    """
    keep = list(keep or [])
    if not offsets:
        lines = split_lines(F.col(text_col))
        if line_no:
            return df.select(*keep, F.posexplode(lines).alias("line_no", "line")).withColumn(
                "line_no", F.col("line_no").cast("bigint"))
        return df.select(*keep, F.explode(lines).alias("line"))
    arr = df.select(*keep, split_lines(F.col(text_col)).alias("_lines"))
    arr = arr.select(
        *keep, "_lines",
        exclusive_prefix_sums(F.transform("_lines", lambda s: F.octet_length(s) + 1))
        .alias("_offs"))
    zipped = F.arrays_zip(F.col("_offs").alias("offset"), F.col("_lines").alias("line"))
    if line_no:
        out = arr.select(*keep, F.posexplode(zipped).alias("line_no", "_z"))
        return out.select(*keep, F.col("line_no").cast("bigint").alias("line_no"),
                          F.col("_z.offset").alias("offset"), F.col("_z.line").alias("line"))
    return arr.select(*keep, F.inline(zipped))
