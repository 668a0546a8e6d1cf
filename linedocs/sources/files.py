"""Text files -> attributed lines ``path string, offset bigint, line string``.

What is read (SRC1, SRC2, SRC5-SRC7, SET1): a directory (descended
recursively), a glob, or a comma list / sequence of those; compressed files by
extension; any Hadoop file system.  Each line carries the decoded path of its
own file (SRC4) and its byte offset in that file (SRC3), the same pair a
Hadoop ``TextInputFormat`` reader gives: lines end at LF, CR or CRLF, offsets
count bytes of the (decompressed) stream, a UTF-8 BOM is skipped but counted.

How the offset is computed without an RDD and without shuffling the lines:

1. The text source reads records ending at LF only (``lineSep="\\n"``) so a
   CR stays visible in the record and every record's byte length is exactly
   ``octet_length + 1``.
2. Pass 1 (small result): per input split ``(file, block start)`` the total
   record bytes and line count - a partial+final aggregate whose output has
   one row per split - and a window over that small table giving each
   split's starting byte (sum of all earlier splits of its file) and each
   file's BOM correction.  The result is written to the shared checkpoint
   folder.
3. Pass 2: the same scan again; an iterator Arrow UDF keeps one running
   integer per split while the task streams through its rows (rows of a split
   arrive in file order inside one task), so each line's offset inside its
   split needs neither shuffle nor sort.  Only a hash of the file, the block start and
   the line lengths cross to Python; text and path stay in the JVM.
4. The split table joins back on two hashes of the file and the block start,
   so a broadcast row is a few integers whatever the length of the paths: it is
   broadcast up to ``broadcast_bytes`` (rows x ``SPLIT_ROW_BYTES``), a shuffle
   join beyond that.  It is a left join that *raises* where a split has no
   entry: both passes use one listing of the files, and should the splits be
   planned anew in between (another core count or split size) no line can be lost
   silently.  The jobs pin the split settings over both passes.
5. Records holding a CR are cut into the lines a CR/CRLF-aware reader sees
   (before pass 2's UDF, which then places each of them; linear in lines).

Re-reading instead of caching follows the original job's own advice (its
pre-count re-reads rather than serialising to disk).
"""

from __future__ import annotations

import threading
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import decode_file_uri, split_list
from ..session import drop_work_dir, work_dir

# Hadoop picks a decompression codec by file extension; for those files the
# stored size says nothing about the text length, so no BOM correction.
COMPRESSED_EXT = r"(?i)\.(gz|bz2|deflate|zst|lz4|snappy|br|xz)\z"
UTF8_BOM_BYTES = 3
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024
SPLIT_ROW_BYTES = 96  # five integers, row header and hash table entry
SPLIT_COUNT = "spark.sql.files.minPartitionNum"


@F.arrow_udf(T.ArrayType(T.LongType()))
def _line_offsets_in_split(
        batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Offsets of the lines of each record, relative to the start of its split.

    Input per row: hash of the file, block start, the record's byte length (LF
    included) and the byte lengths (terminator included) of the lines inside
    the LF-ended record.  A record's offset is
    the running sum of all earlier records of the same (file, block) run; its
    lines follow at the running sum of their own lengths.  Called once per
    task with all batches in scan order, so the running total of the last run
    carries over to the next batch.  Everything is vectorised per batch.
    """
    last_key = None
    carried = 0
    for fp, blk, n, part_lens in batches:
        size = len(part_lens)
        if size == 0:
            yield pa.array([], pa.list_(pa.int64()))
            continue
        if isinstance(part_lens, pa.ChunkedArray):
            part_lens = part_lens.combine_chunks()
        list_off = np.asarray(part_lens.offsets, dtype=np.int64)
        list_off = list_off - list_off[0]
        counts = np.diff(list_off)
        flat = np.asarray(part_lens.flatten().fill_null(0), dtype=np.int64)
        flat_excl = np.cumsum(flat) - flat
        rec_len = np.asarray(n.fill_null(0), dtype=np.int64)
        bv = np.asarray(blk.fill_null(-1), dtype=np.int64)
        fv = np.asarray(fp.fill_null(0), dtype=np.int64)
        new_run = np.zeros(size, dtype=bool)
        new_run[1:] = (fv[1:] != fv[:-1]) | (bv[1:] != bv[:-1])
        new_run[0] = (int(fv[0]), int(bv[0])) != last_key
        excl = np.cumsum(rec_len) - rec_len
        # index of the row that opened each row's run, -1 = run carried over
        run_start = np.maximum.accumulate(np.where(new_run, np.arange(size), -1))
        local = np.where(run_start >= 0, excl - excl[run_start.clip(min=0)], excl + carried)
        # lines: record offset + exclusive sum of earlier lines in the record
        first_of_list = np.append(flat_excl, 0)[list_off[:-1]]
        line_off = flat_excl - np.repeat(first_of_list, counts) + np.repeat(local, counts)
        yield pa.ListArray.from_arrays(pa.array(list_off.astype(np.int32)), pa.array(line_off, pa.int64()))
        last_key = (int(fv[size - 1]), int(bv[size - 1]))
        carried = int(local[size - 1] + rec_len[size - 1])


def record_columns(df: DataFrame) -> DataFrame:
    """The columns the offset recipe needs, from a batch or streaming text read."""
    return df.select(
        F.col("value").alias("_rec"),
        F.col("_metadata.file_path").alias("_fp"),
        F.col("_metadata.file_block_start").alias("_blk"),
        F.col("_metadata.file_size").alias("_fsize"))


def _file_hashes() -> list[Column]:
    return [F.xxhash64("_fp").alias("_f1"), F.xxhash64(F.lit("file"), "_fp").alias("_f2")]


@dataclass
class TextFiles:
    """A set of text files, read as attributed lines."""

    spark: SparkSession
    paths: list[str]
    recursive: bool = True
    glob_filter: str | None = None
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES
    records: DataFrame | None = None  # pre-read records (a stream micro-batch)
    _splits: DataFrame | None = None
    _splits_dir: str | None = None
    _stats: object = None

    def _records(self) -> DataFrame:
        if self.records is not None:
            return self.records
        r = self.spark.read.option("lineSep", "\n")
        if self.recursive:
            r = r.option("recursiveFileLookup", "true")
        if self.glob_filter:
            r = r.option("pathGlobFilter", self.glob_filter)
        self.records = record_columns(r.text(self.paths))  # one listing for both passes
        return self.records

    @staticmethod
    def _has_cr(rec: Column) -> Column:
        return F.instr(rec, "\r") > 0

    @staticmethod
    def _parts(rec: Column) -> Column:
        """Lines inside one LF-ended record: a final CR belongs to the LF
        (CRLF), every other CR ends a line of its own."""
        return F.when(TextFiles._has_cr(rec),
                      F.split(F.regexp_replace(rec, r"\r\z", ""), "\r", -1)).otherwise(F.array(rec))

    def splits(self) -> DataFrame:
        """Pass 1: one row per input split with its start byte and BOM shift.

        The per-split aggregate and the window over it (both small) are
        materialised once in the shared checkpoint folder: it survives
        executor loss, and pass 2 broadcasts a plain scan of a few rows.
        """
        if self._splits is not None:
            return self._splits
        rec = F.col("_rec")
        per_split = self._records().groupBy("_fp", "_blk").agg(
            F.sum(F.octet_length(rec) + 1).alias("_bytes"),
            F.sum(F.when(self._has_cr(rec), F.size(self._parts(rec))).otherwise(1)).alias("_lines"),
            F.max("_fsize").alias("_fsize"))
        by_file = Window.partitionBy("_fp")
        before = by_file.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
        slack = F.col("_fsize") - F.sum("_bytes").over(by_file)
        bom = (~F.col("_fp").rlike(COMPRESSED_EXT)) & slack.isin(UTF8_BOM_BYTES, UTF8_BOM_BYTES - 1)
        table = per_split.select(
            *_file_hashes(), "_blk", "_lines",
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_base"),
            F.when(bom, F.lit(UTF8_BOM_BYTES)).otherwise(F.lit(0)).alias("_bom"))
        self._splits_dir = work_dir(self.spark, "splits")
        table.write.mode("overwrite").parquet(self._splits_dir)
        s = self.spark.read.schema(table.schema).parquet(self._splits_dir)
        # one small job over the split table: its size bound and the pre-count
        self._stats = s.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_lines"), F.lit(0)).alias("lines")).first()
        self._splits = s
        return self._splits

    def release(self) -> None:
        """Delete the split table, once everything read through it is written."""
        if self._splits_dir:
            drop_work_dir(self.spark, self._splits_dir)
            self._splits = self._splits_dir = None

    def line_count(self) -> int:
        """AGG1 pre-count from pass 1 (no extra job beyond the split table)."""
        self.splits()
        return int(self._stats["lines"])

    def splits_fit_broadcast(self) -> bool:
        """Whether a table with a row per split is small enough for a broadcast."""
        self.splits()
        return self._stats["n"] * SPLIT_ROW_BYTES <= self.broadcast_bytes

    def lines(self, split: bool = False) -> DataFrame:
        """``path, offset, line`` for every line of every file; with ``split`` also the columns that
        name its input split (``_f1, _f2, _blk``), whose lines a task streams in order."""
        splits = self.splits()
        if self.splits_fit_broadcast():
            splits = F.broadcast(splits)
        rec = F.col("_rec")
        n = (F.octet_length(rec) + 1).cast("bigint")
        recs = self._records().select(*_file_hashes(), "_fp", "_blk", "_rec", self._parts(rec).alias("_parts"))
        recs = recs.select(
            "_f1", "_f2", "_fp", "_blk", "_parts",
            _line_offsets_in_split(
                "_f1", "_blk", n,
                # one line (the record) unless a CR cuts it; the lambda only
                # runs for records that hold a CR
                F.when(self._has_cr(rec), F.transform(
                    "_parts", lambda x: (F.octet_length(x) + 1).cast("bigint"))).otherwise(F.array(n)))
            .alias("_offs"))
        j = recs.join(splits.drop("_lines"), ["_f1", "_f2", "_blk"], "left")
        # inline_outer: _parts is never empty, and the outer form keeps the
        # optimizer from inferring a row filter that it could push below the
        # running-sum UDF (which must see every record of its split)
        base = F.coalesce("_base", F.raise_error(F.lit(
            "the input splits were planned anew between the two passes; read the lines again")).cast("bigint"))
        # few paths need decoding, and only those pay for it
        path = F.when(F.col("_fp").contains("%"), decode_file_uri(F.col("_fp"))).otherwise(F.col("_fp"))
        named = ["_f1", "_f2", "_blk"] if split else []
        ex = j.select(*named, path.alias("_path"), base.alias("_base"), "_bom", F.inline_outer(
            F.arrays_zip(F.col("_offs").alias("_off"), F.col("_parts").alias("line"))))
        off = F.col("_base") + F.col("_off")
        # a skipped BOM shifts every line of its file except the very first
        off = off + F.when(off > 0, F.col("_bom")).otherwise(F.lit(0))
        return ex.select(*named, F.col("_path").alias("path"), off.cast("bigint").alias("offset"), "line")


_pins: dict[str, int] = {}
_pins_lock = threading.Lock()


@contextmanager
def pinned_splits(spark: SparkSession) -> Iterator[None]:
    """Plan file splits alike for all reads inside, whatever happens to the core count
    (with dynamic allocation it is what else decides their size).  Several jobs of a session may be
    inside at a time: the setting goes with the last of them."""
    session = spark._jsparkSession.sessionUUID()
    with _pins_lock:
        inside = _pins.get(session, 0)
        if inside or spark.conf.get(SPLIT_COUNT, None) is None:  # else it is the user's, and stays
            if not inside:
                spark.conf.set(SPLIT_COUNT, str(spark.sparkContext.defaultParallelism))
            _pins[session] = inside + 1
            ours = True
        else:
            ours = False
    try:
        yield
    finally:
        if ours:
            with _pins_lock:
                _pins[session] -= 1
                if not _pins[session]:
                    del _pins[session]
                    spark.conf.unset(SPLIT_COUNT)


def text_files(spark: SparkSession, paths: str | list[str], recursive: bool = True,
               glob_filter: str | None = None, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> TextFiles:
    """``paths``: directory, glob, or comma list / sequence of them (STR5)."""
    return TextFiles(spark, split_list(paths), recursive, glob_filter, broadcast_bytes)


def read_lines(spark: SparkSession, paths: str | list[str], recursive: bool = True,
               glob_filter: str | None = None) -> DataFrame:
    """SRC1-SRC7: attributed lines of all files under ``paths``."""
    return text_files(spark, paths, recursive, glob_filter).lines()


def read_plain_lines(spark: SparkSession, paths: str | list[str], recursive: bool = True) -> DataFrame:
    """Lines with their file but no offset (one pass, for DOC2-style jobs)."""
    r = spark.read
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.text(split_list(paths)).select(
        decode_file_uri(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("line"))


def lines_of_records(records: DataFrame, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Attributed lines of already-read records (see ``record_columns``).

    Used on a micro-batch of the streaming text source: a file arrives whole
    in one batch, so its offsets are exact.
    """
    return TextFiles(records.sparkSession, [], broadcast_bytes=broadcast_bytes, records=records).lines()
