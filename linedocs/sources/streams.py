"""Streaming sources: topics, sockets and directories of text files.

Topic and socket ends need a broker / a listening peer; they are declared
here as Structured Streaming readers with the option mapping of the original
jobs.  The Kafka connector jar is not part of a plain PySpark install; the
reader raises Spark's own error when it is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_list
from .files import record_columns


def topic_options(brokers: str | list[str], topics: str | list[str],
                  starting_offsets: str = "latest", min_partitions: int | None = None,
                  max_offsets_per_trigger: int | None = None,
                  fail_on_data_loss: bool = True) -> dict[str, str]:
    """SRC8-SRC10 options: several topics (comma list), parallel consumption.

    ``min_partitions`` replaces "threads per topic": Spark splits topic
    partitions into at least that many tasks.  Consumer offsets live in the
    query checkpoint (no group id, no ZooKeeper); the source is the direct
    kind, so a restarted task re-reads exactly its own offset range.
    """
    opts = {
        "kafka.bootstrap.servers": ",".join(split_list(brokers)),
        "subscribe": ",".join(split_list(topics)),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    return opts


def read_topic(spark: SparkSession, brokers, topics, **kw) -> DataFrame:
    """Topic messages as strings (DOC9): key, value, topic, partition, offset, timestamp."""
    raw = spark.readStream.format("kafka").options(**topic_options(brokers, topics, **kw)).load()
    return raw.select(F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"),
                      "topic", "partition", "offset", "timestamp")


def socket_options(host: str, port: int) -> dict[str, str]:
    """SRC11 options."""
    port = int(port)
    if not 0 < port < 65536:
        raise ValueError(f"port out of range: {port}")
    return {"host": host, "port": str(port)}


def read_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """TCP line stream (``value string``).  For tests and demos only: the
    socket source keeps no replayable offsets."""
    return spark.readStream.format("socket").options(**socket_options(host, port)).load()


def read_text_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None,
                     recursive: bool = True) -> DataFrame:
    """New files of a directory as LF-ended records with file attributes.

    Feed micro-batches to ``files.lines_of_records`` for (path, offset, line),
    or use ``value`` directly for plain lines.
    """
    r = spark.readStream.option("lineSep", "\n")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return record_columns(r.text(directory))


def read_line_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of a directory as plain lines (``value string``), like a socket stream."""
    r = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return r.text(directory)
