"""AGG5/SNK5 reporting: the progress of every batch of every query, kept as a table.

Spark reports each batch to listeners; ``ProgressTable`` writes its rows, times and sources as one small file named by
query and batch, so a batch that runs again after a restart replaces its report.  Reports come after the fact
on a thread of their own and never delay or fail the stream; ``wait`` blocks until a query's last one is written.
"""

from __future__ import annotations

import json
import logging
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

log = logging.getLogger(__name__)

PROGRESS = ("query_id string, run_id string, name string, batch_id long, at string, input_rows long, input_rows_per_second double, batch_ms long, "
            "durations_ms map<string,long>, sources array<struct<description:string,input_rows:long>>, sink string, watermark string")


class ProgressTable(StreamingQueryListener):
    """Writes reports below ``out`` on any Hadoop file system; use as ``with ProgressTable(spark, out) as table``."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def __enter__(self) -> "ProgressTable":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def _event(self, run_id) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"query_id": str(p.id), "run_id": str(p.runId), "name": p.name, "batch_id": p.batchId, "at": p.timestamp, "input_rows": p.numInputRows,
               "input_rows_per_second": _finite(p.inputRowsPerSecond), "batch_ms": p.batchDuration, "durations_ms": dict(p.durationMs),
               "sources": [{"description": s.description, "input_rows": s.numInputRows} for s in p.sources], "sink": p.sink.description,
               "watermark": dict(p.eventTime).get("watermark")}
        try:
            self._write(row)
        except Exception:  # a report that cannot be written is no reason to stop a stream
            log.exception("progress of batch %s not written", p.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._event(event.runId).set()

    def _write(self, row: dict) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.out}/query_id={row['query_id']}/batch-{row['batch_id']:012d}.json")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not row["input_rows"] and fs.exists(path):
            return  # a trigger without data reports its last batch again
        stream = fs.create(path, True)
        try:
            stream.write(bytearray((json.dumps({k: v for k, v in row.items() if k != "query_id"}) + "\n").encode()))
        finally:
            stream.close()

    def wait(self, query: StreamingQuery, timeout: float = 60) -> bool:
        """Until the reports of a terminated query are written; False after ``timeout`` seconds."""
        return self._event(query.runId).wait(timeout)

    def read(self) -> DataFrame:
        """All reports, a row per query and batch."""
        return self.spark.read.schema(PROGRESS).json(self.out)


def _finite(x: float | None) -> float | None:
    return x if x is not None and abs(x) != float("inf") and x == x else None
