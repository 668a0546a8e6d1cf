"""WARC archives: a writer with revisit records, and a reader that splits gzipped archives.

Every record is a gzip member of its own.  A reading task has a byte range of a file: it looks for the
gzip magic, takes a candidate for a member if it decodes to a WARC header, owns the records whose
members start in its range, and reads the last of them beyond its end.  No index is needed.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from typing import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import work_dir
from .common import written

MAGIC = b"\x1f\x8b\x08"
HEADER_END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
#: A header block that is longer than this is not one of a record.
MAX_HEADER = 1 << 20
BLOCK = 1 << 20
#: A digest that has more than one row in so many is joined by broadcast; there are at most so many.
HOT = 1000

FILES = "path string, bytes long, records long"
RECORD = ("path string, offset long, length long, record_type string, record_id string, refers_to string, uri string, "
          "payload_bytes long, payload_digest string, intact boolean, payload binary")


# --- bytes of a record ----------------------------------------------------------

def header_value(text: str) -> str:
    """A value that stays on its header line: controls, space and percent are percent-encoded."""
    return quote(text, safe="!#$&'()*+,/:;=?@[]~\"<>\\^`{|}-._")


def record_bytes(kind: str, record_id: str, date: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as one gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
             *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode() + HEADER_END
    return packer.compress(head) + packer.compress(block) + packer.compress(HEADER_END) + packer.flush()


def parse_header(head: bytes) -> dict[str, str] | None:
    """Fields (names in lower case) of a header block, None if it is not one of a WARC record."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/\d+\.\d+", lines[0]):
        return None
    fields = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:]))
    return fields if fields.get("content-length", "").isdigit() and "warc-type" in fields else None


def located(path: str) -> tuple:
    """Arrow's file system of a path, and the path in it."""
    from pyarrow import fs

    if re.match("file:/|/", path):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


def open_input(path: str):
    system, inner = located(path)
    return system.open_input_file(inner)


class Member:
    """One gzip member that starts at ``offset``, decoded block by block."""

    def __init__(self, source, offset: int):
        self.source, self.offset, self.at = source, offset, offset
        self.unpacker = zlib.decompressobj(31)
        self.pending = b""

    def read(self) -> bytes:
        """The next decoded bytes, at most a block; empty at the member's end."""
        while not self.unpacker.eof:
            if not self.pending:
                self.source.seek(self.at)
                self.pending = self.source.read(BLOCK if self.at > self.offset else 1 << 14)
                if not self.pending:
                    raise zlib.error("the file ends inside a member")
                self.at += len(self.pending)
            data = self.unpacker.decompress(self.pending, BLOCK)
            self.pending = self.unpacker.unconsumed_tail
            if data:
                return data
        return b""

    @property
    def end(self) -> int:
        return self.at - len(self.unpacker.unused_data)


def read_record(source, offset: int, want_payload: bool) -> dict | None:
    """The record whose member starts at ``offset``; None if no record does.  The payload is digested as
    it is decoded, and only held if it is wanted."""
    member = Member(source, offset)
    try:
        head = member.read()
        if not head.startswith(b"WARC/"):
            return None
        while HEADER_END not in head and len(head) < MAX_HEADER:
            more = member.read()
            if not more:
                return None
            head += more
        cut = head.find(HEADER_END)
        fields = parse_header(head[:cut]) if cut >= 0 else None
        if fields is None:
            return None
        left = int(fields["content-length"])
        body = head[cut + len(HEADER_END):]
        http = fields.get("content-type", "").startswith("application/http")
        digest, size, kept, prefix, total = hashlib.sha1(), 0, [], b"", 0
        while True:
            part, body = body[:left], body[left:]
            left -= len(part)
            if http:  # the payload is what follows the header of the response
                prefix += part
                part = b""
                if (i := prefix.find(HEADER_END)) >= 0:
                    part, prefix, http = prefix[i + len(HEADER_END):], b"", False
            digest.update(part)
            size += len(part)
            if want_payload:
                kept.append(part)
            total += len(body)
            body = member.read()
            if not body:
                break
        if left or total != len(HEADER_END):
            return None
    except zlib.error:
        return None
    name = "sha1:" + base64.b32encode(digest.digest()).decode()
    stated, kind, intact, payload = fields.get("warc-payload-digest", ""), fields["warc-type"], True, None
    if kind == "revisit":
        size, name = int(fields.get("x-payload-length", -1)), stated
    else:
        payload = b"".join(kept) if want_payload else None
        intact = not stated.startswith("sha1:") or stated == name
    uri = fields.get("warc-target-uri")
    return {"offset": offset, "length": member.end - offset, "record_type": kind, "record_id": fields.get("warc-record-id", "").strip("<>"),
            "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "uri": None if uri is None else unquote(uri), "payload_bytes": size, "payload_digest": name.partition(":")[2],
            "intact": intact, "payload": payload}


def records_in(source, start: int, end: int, want_payload: bool = False) -> Iterator[dict]:
    """The records of ``source`` whose members start at ``start`` or later and before ``end``."""
    at = start
    while at < end:
        source.seek(at)
        step = min(BLOCK, end - at)
        found = source.read(step + len(MAGIC) - 1).find(MAGIC)
        if found < 0:
            at += step
            continue
        at += found
        record = read_record(source, at, want_payload)
        if record:
            yield record
        at += record["length"] if record else 1


# --- Spark ------------------------------------------------------------------------

def with_revisits(pages: DataFrame, page_id: str = "page_id", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """``pages`` with __bytes, __sha1 (hex) and __first: the smallest id among the rows with an equal payload
    of ``min_bytes`` or more, where there are several.

    The digests meet without the payloads.  Digests with more than a thousandth of all rows (fewer than a
    thousand of them) come back by broadcast, and their rows are dealt evenly; the others by a join on
    the digest, in which no key holds more than that."""
    data = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = pages.withColumns({"__bytes": F.octet_length(data).cast("long"), "__sha1": F.sha1(data)})
    narrow = rows.select("__sha1", "__bytes", F.col(f"`{page_id}`").alias("__page"))
    groups = narrow.where(F.col("__bytes") >= min_bytes).groupBy("__sha1").agg(F.min("__page").alias("__first"), F.count("*").alias("__n"))
    groups = written(pages.sparkSession, groups.where("__n > 1"), "payloads")
    total = groups.agg(F.sum("__n")).first()[0] or 0
    hot = groups.where(F.col("__n") * HOT > total).select(F.col("__sha1").alias("__hot"), F.col("__first").alias("__hot_first"))
    rest = groups.where(F.col("__n") * HOT <= total).select(F.col("__sha1").alias("__key"), F.col("__first").alias("__rest_first"))
    spread = F.concat(F.lit("-"), F.hex(F.xxhash64("__sha1", F.col(f"`{page_id}`"), F.monotonically_increasing_id())))
    rows = rows.join(F.broadcast(hot), rows["__sha1"] == hot["__hot"], "left")
    rows = rows.withColumn("__key", F.when(F.col("__hot").isNotNull(), spread).otherwise(F.col("__sha1")))
    out = rows.join(rest, "__key", "left")
    return out.withColumn("__first", F.coalesce("__hot_first", "__rest_first")).drop("__key", "__hot", "__hot_first", "__rest_first")


def write_warc(spark: SparkSession, pages: DataFrame, out: str | None = None, page_id: str = "page_id", uri: str = "url",
               payload: str = "html", min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", file_bytes: int = 1 << 30) -> DataFrame:
    """Archives of ``pages`` under ``out`` (a new shared work folder by default), returned as their list
    (path, bytes, records), which is written: files of lost or repeated tasks are not in it.

    Of the rows with an equal payload of ``min_bytes`` or more, the one with the smallest id is a response
    and the others are revisits of it, without the payload; rows that are equal in id too are all
    responses.  A null id comes after all others; if all ids of a payload are null, all are responses.  A null
    payload is empty, a null uri is left out.  Other columns are not looked at; an empty table gives no file."""
    out = (out or work_dir(spark, "warc")).rstrip("/")
    first, own = F.col("__first"), F.col(f"`{page_id}`")
    refers = F.when(first.isNotNull() & ~first.eqNullSafe(own), first)
    rows = with_revisits(pages.select(*dict.fromkeys(f"`{c}`" for c in (page_id, uri, payload))), page_id, payload, min_bytes).select(
        F.coalesce(own.cast("string"), F.lit("")).alias("id"), F.col(f"`{uri}`").alias("uri"), refers.cast("string").alias("refers"),
        "__bytes", "__sha1", F.when(refers.isNull(), F.col(f"`{payload}`").cast("binary")).alias("payload"))

    def archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = located(out)
        system.create_dir(folder, recursive=True)
        name, sink, size, n, done = "", None, 0, 0, []
        info = b"software: linedocs\r\nformat: WARC File Format 1.1\r\n"
        for batch in batches:
            for id_, uri_, refers_, length, sha1, data in zip(*[batch.column(i) for i in range(6)]):
                if sink is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    sink, n = system.open_output_stream(f"{folder}/{name}", compression=None), 0
                    member = record_bytes("warcinfo", uuid.uuid4().urn, date, [("Content-Type", "application/warc-fields")], info)
                    sink.write(member)
                    size = len(member)
                digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                headers = [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(length.as_py())),
                           ("Content-Type", "application/http;msgtype=response")]
                if uri_.is_valid:
                    headers.append(("WARC-Target-URI", header_value(uri_.as_py())))
                http = HTTP_HEAD + f"Content-Length: {length.as_py()}\r\n\r\n".encode()
                if refers_.is_valid:
                    headers += [("WARC-Refers-To", f"<urn:page:{refers_.as_py()}>"), ("WARC-Profile", REVISIT_PROFILE)]
                    member = record_bytes("revisit", f"urn:page:{id_.as_py()}", date, headers, http)
                else:
                    member = record_bytes("response", f"urn:page:{id_.as_py()}", date, headers, http + (data.as_py() or b""))
                sink.write(member)
                size, n = size + len(member), n + 1
                if size >= file_bytes:
                    sink.close()
                    done.append((f"{out}/{name}", size, n))
                    sink = None
        if sink is not None:
            sink.close()
            done.append((f"{out}/{name}", size, n))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["path", "bytes", "records"])

    return written(spark, rows.mapInArrow(archived, FILES), "warc-files")


def archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, bytes) of the archives of a folder, glob or list of them; their content is not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", F.col("length").alias("bytes")))


def read_warc(spark: SparkSession, files: DataFrame, payload: bool = False, split_bytes: int = 64 << 20) -> DataFrame:
    """The records of ``files`` (path, bytes), of every type: path, offset and length of the member, record_type,
    record_id, refers_to, uri, payload_bytes, payload_digest (base32 SHA-1; length and digest of a
    revisit are those of the full payload), intact (false if the header states another SHA-1), and with ``payload`` the payload.

    A payload that itself holds gzipped records may be stored as it is, and a range may start inside it.  The
    records found there lie inside a member that an earlier range owns, and are dropped for that."""
    ranges = files.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, F.col("bytes")).alias("end"))
    ranges = ranges.repartition(max(1, min(ranges.count(), 100_000)), "path", "start")

    def scan(want: bool):
        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = [f.split()[0] for f in RECORD.split(", ")]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]

            def batch_of(rows: list[dict]) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in zip(names, kinds)], names)

            rows, held = [], 0
            for batch in batches:
                for r in batch.to_pylist():
                    with open_input(r["path"]) as source:
                        for record in records_in(source, r["start"], r["end"], want):
                            rows.append(record | {"path": r["path"]})
                            held += len(record["payload"] or b"")
                            if len(rows) >= 5000 or held > 16 << 20:
                                yield batch_of(rows)
                                rows, held = [], 0
            if rows:
                yield batch_of(rows)
        return ranges.mapInArrow(read, RECORD)

    before = F.max(F.col("offset") + F.col("length")).over(
        Window.partitionBy("path").orderBy("offset", "length").rowsBetween(Window.unboundedPreceding, -1))
    if not payload:
        return scan(False).drop("payload").withColumn("__before", before).where("__before is null or __before <= offset").drop("__before")
    inner = scan(False).select("path", "offset", "length").withColumn("__before", before).where("__before > offset")
    return scan(True).join(inner.select("path", "offset"), ["path", "offset"], "left_anti")


def page_records(records: DataFrame, kind: str = "bigint") -> DataFrame:
    """The responses and revisits of ``records`` by page: page_id, payload_bytes, payload_digest, record_type, refers_to.
    A payload that is not intact is an error."""
    def page(c: str) -> Column:
        return F.regexp_extract(c, "^urn:page:(.*)$", 1).try_cast(kind)

    return records.where(F.col("record_type").isin("response", "revisit")).select(
        page("record_id").alias("page_id"), "payload_bytes",
        F.when(F.col("intact"), F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("damaged payload: "), "record_id"))).alias("payload_digest"),
        "record_type", page("refers_to").alias("refers_to"))
