"""Read-back over a document table: totals, first page, term/prefix, ranges.

These replace the index cluster's queries that the batch job and its test
scripts rely on.  They are filters and aggregates over the written document
table; when that table is Parquet partitioned by ``index``/``doc_type`` the
index filter prunes directories and the other filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_token, has_token_prefix


def total_hits(docs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """RET1: match-all hit total (per ``by`` columns, e.g. index)."""
    return docs.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("total"))


def original_order(docs: DataFrame) -> DataFrame:
    """ORD1: lines back in file order."""
    return docs.orderBy("path", "offset")


def first_page(docs: DataFrame, size: int = 10) -> DataFrame:
    """RET2: the first page of hits in (path, offset) order.

    A top-k: each task keeps its own ``size`` best rows, only those meet.
    """
    return docs.orderBy("path", "offset").limit(size)


def term_search(docs: DataFrame, term: str, line_col: str = "line") -> DataFrame:
    """RET4: lines containing ``term`` as a whole token (case-insensitive)."""
    return docs.filter(has_token(line_col, term))


def prefix_search(docs: DataFrame, prefix: str, line_col: str = "line") -> DataFrame:
    """RET3: lines with a token starting with ``prefix`` (query ``me*``)."""
    return docs.filter(has_token_prefix(line_col, prefix))


def find_documents(docs: DataFrame, **fields) -> DataFrame:
    """RET5: documents whose columns equal the given values."""
    cond = F.lit(True)
    for k, v in fields.items():
        cond = cond & (F.col(k) == F.lit(v))
    return docs.filter(cond)


def in_index(docs: DataFrame, index: str, doc_type: str | None = None) -> DataFrame:
    """RET6: documents of one index (and type) - a partition filter."""
    cond = F.col("index") == index
    if doc_type is not None:
        cond = cond & (F.col("doc_type") == doc_type)
    return docs.filter(cond)


def time_range(docs: DataFrame, start, end, ts_col: str | Column = "event_time") -> DataFrame:
    """RET7: documents whose detected time lies in [start, end] (inclusive,
    like SQL BETWEEN, which also evaluates the time expression only once).

    ``ts_col`` is a ``timestamp_ntz`` column of ``docs`` (a stored document
    table) or an expression over its columns, e.g.
    ``event_time(col("line"), bind=True)`` for documents built on the fly.
    """
    ts = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return docs.filter(ts.between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
