"""SRC3 in one pass: lines and byte offsets from byte ranges of files, without a scan before.

A task has a range of a file and owns the lines that start in it; a line's offset is its distance from the range's
start, so no range needs to know of the others.  The reader cuts at LF, CR and CRLF itself and holds a block at
a time, so neither a file without LF nor a split inside CRLF needs care.  A compressed file is one range of its
decompressed bytes.  Files are opened by the Python workers, through Arrow's file systems; the JVM reader of
``sources.files`` is faster where lines end in LF, and reads whatever Hadoop can open.
"""

from __future__ import annotations

import re
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import decode_file_uri, split_list

RANGE_BYTES = 128 << 20
BLOCK = 4 << 20
BOM = b"\xef\xbb\xbf"
#: Lines per Arrow batch, at most.
ROWS = 50_000
CODECS = {".gz": "gzip", ".bz2": "bz2"}
END = re.compile(rb"\r\n|\n|\r")


def open_stream(path: str, start: int, codec: str | None):
    """A file at ``start``, as a stream of (decompressed) bytes."""
    from pyarrow import fs

    if re.match("file:/|/", path):
        system, inner = fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    else:
        system, inner = fs.FileSystem.from_uri(path)
    if codec:
        return system.open_input_stream(inner, compression=codec)
    source = system.open_input_file(inner)
    source.seek(start)
    return source


def lines_of(source, start: int, end: int | None) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that start in [start, end); ``source`` is at max(0, start - 1).

    The byte before the range tells whether a line starts with it: what is read from there to the first line end
    belongs to an earlier range, and is neither kept nor read beyond the range's end."""
    at = begins = max(0, start - 1)  # offset of buffer[0], and of the line that it is in
    buffer = source.read(BLOCK)
    done = not buffer
    mark = 0
    if start == 0 and buffer.startswith(BOM):
        buffer, at, begins, mark = buffer[len(BOM):], len(BOM), len(BOM), len(BOM)
        if end is not None:
            end = max(end, len(BOM) + 1)  # the first line is this range's, even if the mark fills it
    head: list[bytes] = []  # what earlier blocks hold of the line
    while True:
        pos = 0
        for m in END.finditer(buffer):
            if m[0] == b"\r" and m.end() == len(buffer) and not done:
                break  # an LF may follow
            if end is not None and begins >= end:
                return
            if begins >= start:
                line = buffer[pos:m.start()]
                yield 0 if begins == mark else begins, b"".join([*head, line]) if head else line
            head, pos = [], m.end()
            begins = at + pos
        if end is not None and (begins >= end or (begins < start and at + len(buffer) > end)):
            return
        rest = buffer[pos:]
        if done:
            if begins >= start and (rest or head):
                yield 0 if begins == mark else begins, b"".join([*head, rest])
            return
        hold = rest[-1:] if rest.endswith(b"\r") else b""
        if begins >= start:
            head.append(rest[:len(rest) - len(hold)])
        at += len(buffer) - len(hold)
        data = source.read(BLOCK)
        done = not data
        buffer = hold + data


def read_line_ranges(spark: SparkSession, paths: str | list[str], range_bytes: int = RANGE_BYTES, glob_filter: str | None = None) -> DataFrame:
    """path, offset, line of all files under ``paths`` (directories, globs, lists of them), as ``read_lines``
    gives them, in one pass and for lines that end in CR, LF or CRLF in files of any size.  A byte order mark counts for
    the offsets behind the first line."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob_filter:
        listing = listing.option("pathGlobFilter", glob_filter)
    # only names and lengths are read; a file that several paths lead to is listed once
    files = listing.load(split_list(paths)).select(F.col("_metadata.file_path").alias("file"), F.col("path").alias("open"), F.col("length").alias("bytes")).where("bytes > 0")
    codec = None
    for ext, name in CODECS.items():
        c = F.when(F.col("open").endswith(ext), name)
        codec = c if codec is None else F.coalesce(codec, c)
    files = files.withColumn("codec", codec)
    step = F.when(F.col("codec").isNull(), F.lit(range_bytes)).otherwise(F.col("bytes")).cast("long")
    ranges = files.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, step)))
    ranges = ranges.select("file", "open", "codec", "start", F.when(F.col("codec").isNull(), F.least(F.col("start") + range_bytes, F.col("bytes"))).alias("end"))
    ranges = ranges.repartition(max(1, min(ranges.count(), 200_000)), "open", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                offsets, lines, held = [], [], 0

                def out() -> pa.RecordBatch:
                    return pa.RecordBatch.from_arrays([pa.array([r["file"]] * len(lines), pa.string()), pa.array(offsets, pa.int64()),
                                                       pa.array(lines, pa.binary())], ["file", "offset", "line"])

                with open_stream(r["open"], max(0, r["start"] - 1), r["codec"]) as source:
                    for offset, line in lines_of(source, r["start"], r["end"]):
                        offsets.append(offset)
                        lines.append(line)
                        held += len(line)
                        if len(lines) >= ROWS or held >= 8 * BLOCK:
                            yield out()
                            offsets, lines, held = [], [], 0
                if lines:
                    yield out()

    found = ranges.mapInArrow(read, "file string, offset long, line binary")
    path = F.when(F.col("file").contains("%"), decode_file_uri(F.col("file"))).otherwise(F.col("file"))
    return found.select(path.alias("path"), "offset", F.col("line").cast("string").alias("line"))
