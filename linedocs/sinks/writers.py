"""Document sinks: partitioned document table, bulk NDJSON, per-batch text
directories and the count manifest.

Replay safety: a task or a whole batch may run twice (executor loss, stream
restart).  Documents carry a deterministic id (SNK6), an index of the document
table is replaced at one instant by a published snapshot (``snapshots``), and
per-batch output is named by batch id and overwritten, so a replay replaces
instead of duplicating.
"""

from __future__ import annotations

import re
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import UNSAFE_NAME_CHARS, safe_name
from ..session import work_dir
from ..sources.files import read_lines
from .snapshots import Snapshot, SnapshotTable, partition_folder

#: Bulk files are read back in parts of this many bytes.
BULK_PART_BYTES = 32 << 20


def document_id(*cols: str | Column) -> Column:
    """SNK6: SHA-256 over the NUL-joined string forms of the identity columns."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.sha2(F.concat_ws(chr(0), *parts), 256)


def with_address(docs: DataFrame, index: str | None, doc_type: str | None = None,
                 id_cols: tuple[str, ...] | None = ("path", "offset")) -> DataFrame:
    """Add ``index``/``doc_type`` (type defaults to the index name) and ``_id``.

    ``index=None`` keeps the ``index`` column the documents already carry
    (one job writing several indexes).
    """
    if index is None:
        if "index" not in docs.columns:
            raise ValueError("index=None needs an 'index' column")
        out = docs.withColumn("doc_type", F.lit(doc_type) if doc_type else F.col("index"))
    else:
        out = docs.withColumn("index", F.lit(index)).withColumn("doc_type", F.lit(doc_type or index))
    if id_cols:
        out = out.withColumn("_id", document_id(*id_cols))
    return out


def throttle(df: DataFrame, max_writers: int | None) -> DataFrame:
    """SNK7: at most ``max_writers`` tasks read, shape and write at a time.

    The scan's partitions are dealt to that many tasks, which take them one after the other: no
    document moves, and lines that follow each other stay so.  A task is then as long as its share of
    the input; ``write_bulk_from`` bounds it by writing in waves.
    """
    return df.coalesce(max_writers) if max_writers else df


def write_documents(docs: DataFrame, out: str, index: str | None, doc_type: str | None = None,
                    fmt: str = "parquet", max_writers: int | None = None,
                    id_cols: tuple[str, ...] | None = ("path", "offset"),
                    check: Callable[[], None] | None = None) -> Snapshot:
    """SNK1a: replace indexes of the versioned document table under ``out``, partitioned by ``index``/``doc_type``.

    The documents go to a new folder and are published by one commit when all are written: until then, and if
    the job dies, readers see the old index.  With a fixed index it is replaced, also by nothing when no
    document is left.  Without one, the indexes that receive documents are, all at once.  Other indexes stay
    as they are either way.  ``check`` is called between writing and publishing; what it raises leaves the old state.
    """
    df = throttle(with_address(docs, index, doc_type, id_cols), max_writers)
    table = SnapshotTable(docs.sparkSession, out)
    data = table.stage()
    if index is not None:
        address = (index, doc_type or index)
        folder = partition_folder(table.staged_folder(data), index=address[0], doc_type=address[1])
        df.drop("index", "doc_type").write.format(fmt).save(folder)
    else:
        df.write.partitionBy("index", "doc_type").format(fmt).save(table.staged_folder(data))
    if check:
        check()
    if index is not None:
        return table.commit({address: data})
    return table.commit({address: data for address in table.staged_indexes(data)})


def read_documents(spark: SparkSession, out: str, schema: T.StructType, fmt: str = "parquet",
                   extra: dict[str, T.DataType] | None = None, version: int | None = None) -> DataFrame:
    """The document table under ``out``: ``schema`` (a builder's), then ``extra`` columns, ``index`` and
    ``doc_type``.  Declared, so nothing is inferred: index ``007`` stays a string.

    A versioned table is read as of its last commit, or as of ``version``; a table that a
    stream appends to has no commits and is read as it is."""
    full = T.StructType(list(schema.fields))
    for name, kind in (extra or {}).items():
        full = full.add(name, kind)
    table = SnapshotTable(spark, out)
    if version is not None or table.exists():
        return table.read(full, fmt, version)
    return spark.read.schema(full.add("index", T.StringType()).add("doc_type", T.StringType())).format(fmt).load(out)


def id_columns(docs: DataFrame) -> tuple[str, ...] | None:
    """Identity of a line document: (path, offset); none without an offset."""
    return ("path", "offset") if {"path", "offset"} <= set(docs.columns) else None


def bulk_lines(docs: DataFrame, index: str, doc_type: str | None = None,
               id_cols: tuple[str, ...] | None = ("path", "offset"),
               fields: tuple[str, ...] | None = None) -> DataFrame:
    """SNK1b: newline-delimited bulk request, two lines per document.

    ``{"index":{"_index":..,"_type":..,"_id":..}}`` then the JSON source
    (no ``_id`` when ``id_cols`` is None: the index assigns one).  Output
    column ``value`` (one line per row), ordered action-then-source inside
    each document.  Write it without another shuffle, which would part the pairs.
    """
    fields = fields or tuple(docs.columns)
    addr = [F.lit(index).alias("_index"), F.lit(doc_type or index).alias("_type")]
    if id_cols:
        addr.append(document_id(*id_cols).alias("_id"))
    action = F.to_json(F.struct(F.struct(*addr).alias("index")))
    source = F.to_json(F.struct(*fields))
    return docs.select(F.explode(F.array(action, source)).alias("value"))


def write_bulk(docs: DataFrame, out: str, index: str, doc_type: str | None = None,
               compression: str | None = None, max_writers: int | None = None) -> None:
    """SNK1b to text files, ready for a bulk loader: every action is followed by its source."""
    w = bulk_lines(throttle(docs, max_writers), index, doc_type, id_columns(docs)).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(out)


def waves(files: list[tuple[str, int]], size: int) -> list[list[str]]:
    """Paths in groups of about ``size`` bytes, at least one each, in order."""
    out, held = [], 0
    for path, n in files:
        if not out or held >= size:
            out.append([])
            held = 0
        out[-1].append(path)
        held += n
    return out


def write_bulk_from(spark: SparkSession, table: str, schema: T.StructType, out: str, index: str, doc_type: str | None = None,
                    fmt: str = "parquet", compression: str | None = None, max_writers: int | None = None,
                    task_bytes: int = 1 << 30) -> int:
    """SNK7 + SNK1b: the bulk file of one index of a document table, by at most ``max_writers`` tasks at a time.

    The index's files are written wave by wave, ``wave=<n>`` below ``out``: a wave has as many bytes as its writers
    may take each, so a task that is lost repeats about ``task_bytes`` and no more, however few the writers are.
    Documents stay in the task that reads them.  Returns the number of waves."""
    doc_type = doc_type or index
    files = SnapshotTable(spark, table).files(index, doc_type)
    groups = waves(files, task_bytes * max_writers) if max_writers else [[p for p, _ in files]] * bool(files)
    target = spark._jvm.org.apache.hadoop.fs.Path(out)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    for k, group in enumerate(groups):
        docs = spark.read.schema(schema).format(fmt).load(group)
        write_bulk(docs, f"{out.rstrip('/')}/wave={k:06d}", index, doc_type, compression, max_writers)
    return len(groups)


def read_bulk(spark: SparkSession, out: str, part_bytes: int = BULK_PART_BYTES) -> DataFrame:
    """The pairs (action, source) of the bulk files below ``out``, by the order of their lines; of an odd number of
    lines the last has no source.

    A file is as long as its writer's share of the input, so it is paired in parts of ``part_bytes``.  The counts of the
    parts before tell whether a part starts with a source; that line belongs to the part of its action."""
    lines = read_lines(spark, out).withColumn("part", F.floor(F.col("offset") / part_bytes).cast("long"))
    parts = lines.groupBy("path", "part").agg(F.count("*").alias("n"), F.min("offset").alias("first"))
    by_file = Window.partitionBy("path").orderBy("part")  # a row per part
    before = F.coalesce(F.sum("n").over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    torn = parts.select("path", "first", before.alias("before"), F.lag("part").over(by_file).alias("home"))
    place = work_dir(spark, "bulk-parts")
    torn.write.parquet(place)
    torn = spark.read.schema(torn.schema).parquet(place)
    whole = lines.join(torn.where("before % 2 = 1").select("path", F.col("first").alias("offset"), "home"), ["path", "offset"], "left")
    whole = whole.withColumn("part", F.coalesce("home", "part")).repartition(max(1, torn.count()), "path", "part")
    after = Window.partitionBy("path", "part").orderBy("offset")
    pairs = whole.select(F.col("line").alias("action"), F.lead("line").over(after).alias("source"), F.row_number().over(after).alias("k"))
    return pairs.where("k % 2 = 1").select("action", "source")


def write_batch_text(batch: DataFrame, base: str, batch_id: int, prefix: str = "data",
                     suffix: str = "txt", value_col: str = "value") -> str:
    """SNK3: one text directory per micro-batch, ``<base>/<prefix>-<batch_id>.<suffix>``.

    Named by batch id (not wall-clock time) and overwritten, so a replayed
    batch lands in the same place.
    """
    target = f"{base.rstrip('/')}/{prefix}-{batch_id}.{suffix}"
    batch.select(F.col(value_col).cast("string")).write.mode("overwrite").text(target)
    return target


def write_manifest(manifest: DataFrame, out_dir: str, index: str | None = None) -> str:
    """SNK4: write the one-row count manifest to ``<out_dir>/<safe index>.count``.

    Last run wins (overwrite), like the original count file; the location is
    a caller-chosen shared folder, not a driver-local /tmp.  With ``index``
    given, the file name is derived on the driver from that option value
    (same rule as ``safe_name``) instead of by a job.
    """
    if index is not None:
        name = re.sub(UNSAFE_NAME_CHARS, "_", index)
    else:
        name = manifest.select(safe_name(F.col("index"))).first()[0]
    target = f"{out_dir.rstrip('/')}/{name}.count"
    manifest.coalesce(1).write.mode("overwrite").json(target)
    return target


# Public data source name of the search-index connector for Spark SQL.
INDEX_CONNECTOR_FORMAT = "org.elasticsearch.spark.sql"


def save_to_index(docs: DataFrame, resource: str, nodes: str, id_col: str | None = "_id",
                  fmt: str = INDEX_CONNECTOR_FORMAT, max_writers: int | None = None,
                  options: dict[str, str] | None = None) -> None:
    """SNK1c: pass documents to a search-index connector, when its jar is on
    the classpath (it is not part of this install).

    ``resource`` is ``index`` or ``index/type``; with ``id_col`` the
    deterministic id becomes the document id, so a replayed task overwrites
    instead of adding a copy.  ``max_writers`` throttles concurrent writers.
    """
    w = throttle(docs, max_writers).write.format(fmt).option("es.nodes", nodes)
    if id_col:
        w = w.option("es.mapping.id", id_col).option("es.mapping.exclude", id_col)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.mode("append").save(resource)
