"""Command line for the four jobs (run with spark-submit or python -m linedocs).

    index    text files -> document table (+ bulk file, count manifest)
    counts   new files of a directory -> per-batch line / word / per-word counts
    totext   a topic -> one text directory per batch
    toindex  a topic -> dated line documents per batch
    expire   old versions of a document table, and what dead jobs left there

Arguments map one to one onto ``linedocs.plans.jobs``; there is no
environment lookup.  The session comes from spark-submit's configuration.
"""

from __future__ import annotations

import argparse
import json
import sys
from contextlib import nullcontext

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from .plans import jobs
from .session import BASE_CONF
from .sinks.snapshots import SnapshotTable
from .sources import streams
from .streaming import live
from .streaming.progress import ProgressTable


def _session(app: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    return b.getOrCreate()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="linedocs")
    sub = p.add_subparsers(dest="cmd", required=True)

    ix = sub.add_parser("index", help="index text files")
    ix.add_argument("--path", required=True, help="directory, glob or comma list")
    ix.add_argument("--index", required=True)
    ix.add_argument("--type", dest="doc_type")
    to = ix.add_mutually_exclusive_group(required=True)
    to.add_argument("--out", help="document table folder")
    to.add_argument("--es-nodes", help="index nodes (host:port,...): write through the index connector")
    ix.add_argument("--builder", default="offset")
    ix.add_argument("--count", action="store_true", help="pre-count lines (no extra job)")
    ix.add_argument("--format", default="parquet")
    ix.add_argument("--max-writers", type=int)
    ix.add_argument("--manifest-dir")
    ix.add_argument("--bulk-out")

    for name, hlp in (("counts", "live counts over a directory stream"),
                      ("totext", "topic -> text directories"),
                      ("toindex", "topic -> documents")):
        sp = sub.add_parser(name, help=hlp)
        sp.add_argument("--checkpoint", required=True)
        sp.add_argument("--out", required=True)
        sp.add_argument("--interval", type=int, default=10)
        sp.add_argument("--available-now", action="store_true")
        sp.add_argument("--progress-out", help="folder for the reports of all batches")
        if name == "counts":
            src = sp.add_mutually_exclusive_group(required=True)
            src.add_argument("--dir", help="directory receiving text files")
            src.add_argument("--host", help="socket peer sending lines (with --port)")
            sp.add_argument("--port", type=int)
            sp.add_argument("--show", type=int, default=10)
            sp.add_argument("--intervals-out", help="also write lines and words of every interval, idle ones as zero (a running query only)")
        else:
            sp.add_argument("--brokers", required=True)
            sp.add_argument("--topics", required=True)
            sp.add_argument("--min-partitions", type=int)
            sp.add_argument("--starting-offsets", help="default: earliest with --available-now, else latest")
            sp.add_argument("--max-offsets-per-trigger", type=int)
        if name == "totext":
            sp.add_argument("--mode", choices=["pair", "value"], default="pair")
            sp.add_argument("--counts-out", help="folder for per-batch message counts")
        if name == "toindex":
            sp.add_argument("--index", required=True)
            sp.add_argument("--type", dest="doc_type")

    ex = sub.add_parser("expire", help="delete old versions of a document table")
    ex.add_argument("--out", required=True, help="document table folder")
    ex.add_argument("--keep", type=int, default=2, help="versions to keep")
    ex.add_argument("--older-than", type=float, default=24.0, help="hours; nothing younger goes")

    a = p.parse_args(argv)
    if a.cmd == "counts" and (a.host is None) != (a.port is None):
        p.error("--host and --port go together")
    if a.cmd == "counts" and a.intervals_out and a.available_now:
        p.error("--intervals-out counts by the clock of a running query, not with --available-now")
    spark = _session(f"linedocs-{a.cmd}")
    if a.cmd == "index":
        res = jobs.index_text_files(spark, a.path, a.index, a.out, doc_type=a.doc_type,
                                    builder=a.builder, count=a.count, fmt=a.format,
                                    max_writers=a.max_writers, manifest_dir=a.manifest_dir,
                                    bulk_out=a.bulk_out, nodes=a.es_nodes)
        print(json.dumps(res.__dict__))
        return 0
    if a.cmd == "expire":
        print(json.dumps({"expired": SnapshotTable(spark, a.out).expire(a.keep, a.older_than * 3600)}))
        return 0
    with ProgressTable(spark, a.progress_out) if a.progress_out else nullcontext() as reports:
        queries = _streams(spark, a)
        for q in queries:
            q.awaitTermination()
            if reports:
                reports.wait(q)
    return 0


def _streams(spark: SparkSession, a: argparse.Namespace) -> list[StreamingQuery]:
    """The started queries of a stream command."""
    if a.cmd == "counts":
        def lines_in():
            return streams.read_socket(spark, a.host, a.port) if a.host else streams.read_line_stream(spark, a.dir)

        out = [jobs.network_counts(spark, lines_in(), a.out, a.checkpoint, interval=a.interval, show=a.show, available_now=a.available_now)]
        if a.intervals_out:
            counts = live.interval_counts(lines_in(), f"{a.interval} seconds")
            out.append(live.start(spark, counts, a.intervals_out, f"{a.checkpoint.rstrip('/')}-intervals", a.interval))
        return out
    msgs = streams.read_topic(spark, a.brokers, a.topics, min_partitions=a.min_partitions,
                              starting_offsets=a.starting_offsets or ("earliest" if a.available_now else "latest"),
                              max_offsets_per_trigger=a.max_offsets_per_trigger)
    if a.cmd == "totext":
        return [jobs.topic_to_text(spark, msgs, a.out, a.checkpoint, interval=a.interval, mode=a.mode,
                                   available_now=a.available_now, counts_out=a.counts_out)]
    return [jobs.topic_to_index(spark, msgs, a.out, a.index, a.checkpoint, doc_type=a.doc_type,
                                interval=a.interval, available_now=a.available_now)]


if __name__ == "__main__":
    sys.exit(main())
