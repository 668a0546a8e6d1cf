"""The end-to-end jobs, as functions with keyword arguments.

``index_text_files``  text files -> documents -> document table (+ bulk file,
                      count manifest)                         batch indexer
``network_counts``    line stream -> per-batch line/word/per-word counts
``topic_to_text``     message stream -> one text directory per batch
``topic_to_index``    message stream -> dated line documents per batch

No option parsing, environment lookup or usage text: callers pass arguments.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import counts, documents
from ..sinks import writers
from ..sources.files import TextFiles, pinned_splits, read_plain_lines, text_files
from ..streaming import runner

log = logging.getLogger(__name__)


@dataclass
class IndexResult:
    path: str
    index: str
    doc_type: str
    records: int | None
    count: str
    secs: int
    manifest: str | None


def index_text_files(spark: SparkSession, path: str | list[str], index: str, out: str | None = None,
                     doc_type: str | None = None, builder: str = "offset", count: bool = False,
                     fmt: str = "parquet", max_writers: int | None = None,
                     manifest_dir: str | None = None, bulk_out: str | None = None,
                     nodes: str | None = None, connector: str = writers.INDEX_CONNECTOR_FORMAT,
                     options: dict[str, str] | None = None) -> IndexResult:
    """Batch indexer (section 3.1 of the survey): to the document table ``out``, or with
    ``nodes`` to a search index through its connector.

    The lines read are observed on the write and compared with the split table
    that the offset computation builds anyway: a difference fails the job before the index is published.
    ``count=True`` reports that count, at no extra job.
    """
    if (out is None) == (nodes is None):
        raise ValueError("either a table folder (out) or index nodes")
    if bulk_out and out is None:
        raise ValueError("a bulk file is written from the document table (out)")
    timer = counts.Timer()
    doc_type = doc_type or index
    with pinned_splits(spark):
        tf = text_files(spark, path)
        with_offsets = builder not in documents.WITHOUT_OFFSET
        counted = tf.line_count() if with_offsets else None
        lines, obs = counts.observed(tf.lines() if with_offsets else read_plain_lines(spark, path))
        docs = documents.to_documents(lines, builder)
        # a document id needs the offset: (path, line) would collide for a line
        # repeated in one file.  Without it the table is still replay-safe
        # (the index is replaced), only connector upserts lose their key.
        ids = writers.id_columns(docs)

        def complete() -> None:
            if counted is not None and int(obs.get.get("records") or 0) != counted:
                raise RuntimeError(f"read {obs.get['records']} lines but counted {counted}: the files changed while they were indexed")

        if nodes is not None:
            addressed = writers.with_address(docs, index, doc_type, ids).drop("index", "doc_type")
            writers.save_to_index(addressed, f"{index}/{doc_type}", nodes, id_col="_id" if ids else None,
                                  fmt=connector, max_writers=max_writers, options=options)
            complete()
        else:
            writers.write_documents(docs, out, index, doc_type, fmt=fmt, max_writers=max_writers, id_cols=ids, check=complete)
        tf.release()
    records = int(obs.get.get("records") or 0) if count else None
    if bulk_out:
        # from the files of the index just written, not by running the text scan and the offset pass again
        writers.write_bulk_from(spark, out, docs.schema, bulk_out, index, doc_type, fmt, max_writers=max_writers)
    secs = timer.secs()
    manifest_path = None
    if manifest_dir:
        m = counts.count_manifest(spark, ",".join(tf.paths), index, doc_type, records, secs)
        manifest_path = writers.write_manifest(m, manifest_dir, index)
    return IndexResult(",".join(tf.paths), index, doc_type, records,
                       str(records) if records is not None else "uncounted", secs, manifest_path)


def network_counts(spark: SparkSession, lines: DataFrame, out: str, checkpoint: str,
                   interval: int = runner.DEFAULT_INTERVAL, show: int = 0,
                   available_now: bool = False, line_col: str = "value") -> StreamingQuery:
    """Live counts (section 3.2): per batch, lines, words and per-word counts."""
    sink = runner.CountsSink(out, line_col=line_col, show=show)
    return runner.start(lines, sink, checkpoint, interval, available_now, name=None)


def topic_to_text(spark: SparkSession, messages: DataFrame, out: str, checkpoint: str,
                  interval: int = runner.DEFAULT_INTERVAL, mode: str = "pair",
                  available_now: bool = False, counts_out: str | None = None) -> StreamingQuery:
    """Topic -> text (section 3.3): ``<out>/data-<batch_id>.txt`` per batch.

    ``mode="pair"`` writes ``(key,value)`` lines (DOC10), ``mode="value"`` the
    value only.  The message count of each batch is observed on the write
    (AGG5, no second pass), logged, and kept as one row under
    ``<counts_out>/batch_id=<id>`` when ``counts_out`` is given.
    """
    if mode not in ("pair", "value"):
        raise ValueError("mode is 'pair' or 'value'")

    def process(batch: DataFrame, batch_id: int) -> None:
        text = (documents.pair_text(F.col("key"), F.col("value")) if mode == "pair"
                else F.col("value").cast("string"))
        obs_df, obs = counts.observed(batch.select(text.alias("value")), "messages")
        target = writers.write_batch_text(obs_df, out, batch_id)
        n = int(obs.get.get("records") or 0)
        log.info("batch %s: %s messages -> %s", batch_id, n, target)
        if counts_out:
            (batch.sparkSession.createDataFrame([(n,)], "messages bigint")
                 .write.mode("overwrite").parquet(f"{counts_out.rstrip('/')}/batch_id={batch_id}"))

    return runner.start(messages, process, checkpoint, interval, available_now)


def topic_to_index(spark: SparkSession, messages: DataFrame, out: str, index: str, checkpoint: str,
                   doc_type: str | None = None, interval: int = runner.DEFAULT_INTERVAL,
                   dated: bool = True, available_now: bool = False) -> StreamingQuery:
    """Stream -> documents (SNK2): ``{date, line}`` (or ``{line}``) per message,
    written under ``batch_id=<id>`` inside the index partition (replay-safe).
    Messages that carry topic, partition and offset get an ``_id`` of them (SNK6)."""
    build = documents.stream_dated_line_documents if dated else documents.stream_line_documents

    def process(batch: DataFrame, batch_id: int) -> None:
        identity = ("topic", "partition", "offset")
        keyed = batch
        if set(identity) <= set(batch.columns):
            keyed = batch.withColumn("_id", writers.document_id(*identity))
        docs = build(keyed, keep=("_id",) if "_id" in keyed.columns else ()).withColumn("batch_id", F.lit(batch_id))
        docs = writers.with_address(docs, index, doc_type, id_cols=None)
        (docs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("index", "doc_type", "batch_id").parquet(out))

    return runner.start(messages, process, checkpoint, interval, available_now)


def file_stream_documents(spark: SparkSession, records: DataFrame, out: str, index: str,
                          checkpoint: str, doc_type: str | None = None, builder: str = "offset",
                          interval: int = runner.DEFAULT_INTERVAL,
                          available_now: bool = False) -> StreamingQuery:
    """New files of a directory -> documents with exact offsets, per batch.

    ``records`` comes from ``sources.streams.read_text_stream``.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with pinned_splits(spark):
            tf = TextFiles(spark, [], records=batch)
            counted = tf.line_count()
            lines, obs = counts.observed(tf.lines())
            docs = documents.to_documents(lines, builder)
            docs = writers.with_address(docs.withColumn("batch_id", F.lit(batch_id)), index, doc_type,
                                        id_cols=writers.id_columns(docs))
            (docs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("index", "doc_type", "batch_id").parquet(out))
            tf.release()
        read = int(obs.get.get("records") or 0)
        if read != counted:
            raise RuntimeError(f"batch {batch_id}: read {read} lines but counted {counted}")

    return runner.start(records, process, checkpoint, interval, available_now)
