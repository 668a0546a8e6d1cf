"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager
from typing import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import drop_work_dir, work_dir

#: ASCII white space of every contract here: space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_open_scopes: list[list[str]] = []


@contextmanager
def dropping_intermediates(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that ``written`` makes inside, on leaving.  What is returned lazily from inside reads
    them, so write it before (outside of ``written``, or with ``keep``)."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            drop_work_dir(spark, path)


def written(spark: SparkSession, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` as a table in the shared work folder: its lineage ends there, so
    a lost executor costs a re-read and never a recomputation of all before.  It stays until an enclosing
    ``dropping_intermediates`` ends; with ``keep``, until the one around that does."""
    path = work_dir(spark, name)
    scopes = _open_scopes[:-1] if keep else _open_scopes
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def placed(spark: SparkSession, df: DataFrame, column: str, name: str, first: int = 0) -> tuple[DataFrame, int]:
    """``df`` written, with each row's place in the order it was written in (dense, from ``first``), and the
    number of rows.  A place is that within its partition, after the partitions before it: no sort."""
    raw = written(spark, df.withColumn("__at", F.monotonically_increasing_id()), f"{name}-raw").withColumn(
        "__part", F.shiftright("__at", 33))
    sizes = raw.groupBy("__part").agg(F.count("*").alias("__size"))
    # one row per partition of the job that wrote them
    starts = sizes.select("__part", (F.sum("__size").over(Window.orderBy("__part")) - F.col("__size")).alias("__start"))
    total = sizes.agg(F.coalesce(F.sum("__size"), F.lit(0))).first()[0]
    place = F.col("__at") - F.shiftleft(F.col("__part"), 33) + F.col("__start") + first
    out = raw.join(F.broadcast(starts), "__part").withColumn(column, place).select(*[F.col(f"`{c}`") for c in df.columns], column)
    return out, total


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and leaves every other character alone."""
    return F.translate(c, UPPER, UPPER.lower())


def document_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """A row's identity where ids may be null or repeat: the id and 128 bits of
    its text.  Rows equal in both are the same document."""
    return [F.col(doc_id).alias("__id"), F.xxhash64(text).alias("__h1"),
            F.xxhash64(F.lit("linedocs"), text).alias("__h2")]


KEY = ["__id", "__h1", "__h2"]


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` in which null equals null; the keys come out once
    (those of ``left``) and no other column may clash."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[F.col(f"`{c}`") for c in right.columns if c not in keys])
    on = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        on = c if on is None else on & c
    return left.join(r, on, how).drop(*[f"_r_{k}" for k in keys])


def few(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """``df`` to be broadcast if it has at most ``rows`` rows, else as it is: joined by a
    shuffle whose hot keys adaptive execution splits."""
    return F.broadcast(df) if df.count() <= rows else df


def components(spark: SparkSession, edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) by alternating large-star
    and small-star steps: (node, root), root the smallest node of the
    component.  Every step is a join and an aggregate; each round is written to
    the shared folder.  A node with very many neighbours is a hot join key that
    adaptive execution splits, and its minimum is pre-aggregated."""
    def stars(e: DataFrame, small: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.union(both.select("v", "u"))
        near = both.where("v < u") if small else both
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        keep = near if small else both.where("v > u")
        out = keep.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        if small:
            out = out.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def signature(e: DataFrame):
        r = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        return tuple(r)

    now = written(spark, edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where("a <> b").distinct(), "edges")
    sign = signature(now)
    for _ in range(max_rounds):
        if not sign[0]:
            break
        now = written(spark, stars(stars(now, small=False), small=True), "stars")
        before, sign = sign, signature(now)
        if before == sign:
            break
    else:
        raise RuntimeError("components: no fixed point")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
