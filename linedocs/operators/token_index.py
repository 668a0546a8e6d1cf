"""RET3/RET4 on a stored table: postings of tokens, sorted, so that a search reads few row groups.

A posting is (token, slot, mark, offset), once per token and line; slot and mark are 128 bits of the file and its part.  The table is
sorted by token over all its files: a term or a prefix is a range of it, which Parquet's statistics find, and a Bloom filter rules
out terms that fall between.  A token in a third of all lines spans several files, because the ranges are of token and place.  The
lines come from the line store, from the buckets that the postings name.

Lines are tokenized once.  Their postings are sorted as blocks, one per token and batch of lines, and unfolded when they are written.
"""

from __future__ import annotations

from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import _term_tokens, has_token, has_token_prefix, tokens
from ..session import drop_work_dir, work_dir
from ..sinks.line_store import LineStore

POSTINGS = T.StructType().add("token", "string").add("slot", "long").add("mark", "long").add("offset", "long")
BLOCKS = "token string, first long, slots array<long>, marks array<long>, offsets array<long>"
#: Row groups of this size: what a search reads at least.
ROW_GROUP_BYTES = 4 << 20
#: Up to so many parts with hits, only their buckets are read.
FEW_SLOTS = 1000


def mark() -> Column:
    """With the slot, what stands for a file and its part."""
    return F.xxhash64(F.lit("mark"), "path", "part")


def block_maker() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that gives, per token of a batch of lines (slot, mark, offset, tokens), the least slot and the places of the
    lines that hold it.  Made here, so that it goes to the executors by value."""
    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, marks, offsets, found = (batch.column(c) for c in range(4))
            words = found.flatten().dictionary_encode()
            n = pc.list_value_length(found).fill_null(0).to_numpy(zero_copy_only=False)
            line = np.repeat(np.arange(len(batch)), n)
            both = np.unique(words.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(batch) + line)  # once per token and line
            token, line = both // max(1, len(batch)), both % max(1, len(batch))
            start = np.flatnonzero(np.diff(token, prepend=-1))
            line = pa.array(line)
            slot = slots.take(line)
            least = np.minimum.reduceat(slot.to_numpy(zero_copy_only=False), start) if len(start) else np.zeros(0, np.int64)
            ends = pa.array(np.append(start, len(both)), pa.int32())
            places = [pa.ListArray.from_arrays(ends, c) for c in (slot, marks.take(line), offsets.take(line))]
            yield pa.RecordBatch.from_arrays([words.dictionary.take(pa.array(token[start])), pa.array(least, pa.int64()), *places],
                                             ["token", "first", "slots", "marks", "offsets"])

    return blocks_of


def write_postings(store: LineStore, out: str) -> None:
    """The postings of a line store."""
    spark, place = store.spark, work_dir(store.spark, "blocks")
    # written before they are sorted: the ranges are found by reading blocks, not by tokenizing lines again
    store.lines().select("slot", mark().alias("mark"), "offset", tokens("line").alias("tokens")).mapInArrow(block_maker(), BLOCKS).write.parquet(place)
    order = ["token", "first"]
    blocks = spark.read.schema(BLOCKS).parquet(place).repartitionByRange(*order).sortWithinPartitions(*order)
    places = blocks.select("token", "marks", "offsets", F.posexplode("slots").alias("at", "slot"))
    (places.select("token", "slot", F.get("marks", F.col("at")).alias("mark"), F.get("offsets", F.col("at")).alias("offset")).write.mode("overwrite")
           .option("parquet.block.size", ROW_GROUP_BYTES)
           .option("parquet.bloom.filter.enabled#token", "true").parquet(out))
    drop_work_dir(spark, place)


def read_postings(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(POSTINGS).parquet(out)


def _after(prefix: str) -> str | None:
    """The least string above all that start with ``prefix``, by code point."""
    for i in range(len(prefix) - 1, -1, -1):
        c = ord(prefix[i])
        if c < 0x10FFFF:
            return prefix[:i] + chr(0xE000 if c == 0xD7FF else c + 1)
    return None


def _lines(store: LineStore, hits: DataFrame, check: Column) -> DataFrame:
    """path, offset, line of the places in ``hits`` whose line passes ``check``."""
    places = hits.select("slot", "mark", "offset")
    slots = [r[0] for r in places.select("slot").distinct().limit(FEW_SLOTS + 1).collect()]
    lines = store.lines().withColumn("mark", mark())
    if len(slots) <= FEW_SLOTS:
        lines = lines.where(F.col("slot").isin(slots))
    on = (F.col("l.slot") == F.col("p.slot")) & (F.col("l.mark") == F.col("p.mark")) & F.col("l.offset").eqNullSafe(F.col("p.offset"))
    return lines.alias("l").join(places.alias("p"), on, "left_semi").where(check).select("path", "offset", "line")


def term_search(store: LineStore, postings: DataFrame, term: str) -> DataFrame:
    """RET4: the lines that hold ``term`` as a token; of a term of several tokens, the longest is looked up
    and the lines found are tested for all of them in a row."""
    found = _term_tokens(term)
    return _lines(store, postings.where(F.col("token") == max(found, key=len)), has_token("line", term) if len(found) > 1 else F.lit(True))


def prefix_search(store: LineStore, postings: DataFrame, prefix: str) -> DataFrame:
    """RET3: the lines with a token that starts with ``prefix`` (``me*``)."""
    found = _term_tokens(prefix.rstrip("*"))
    if len(found) > 1:  # the first ones are whole tokens
        return _lines(store, postings.where(F.col("token") == max(found[:-1], key=len)), has_token_prefix("line", prefix))
    end = _after(found[0])
    inside = F.col("token") >= found[0]
    return _lines(store, postings.where(inside & (F.col("token") < end) if end else inside), F.lit(True))
