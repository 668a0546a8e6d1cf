"""AGG6 by content: does the written table hold exactly the lines that were read?

First each side is reduced to one digest per key (index, path): the number of rows and sums of two 64-bit row
hashes.  Sums do not depend on order, so they are partial aggregates before the shuffle, and a file with
a third of all lines leaves each task as one row.  Only the keys whose digests differ are compared line by line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The hashes are summed modulo these primes, so a sum stays far below 64 bits for 2^32 rows a key.
MODULI = (2147483647, 2147483629)
LOST, DOUBLED, ALTERED, EXTRA = "lost", "doubled", "altered", "extra"


def row_hashes(cols: list[str]) -> list[Column]:
    """Two 64-bit hashes of the columns.  ``xxhash64`` skips nulls, so each is led by whether it is one."""
    parts = [p for c in cols for p in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(seed), *parts) for seed in ("source", "indexed")]


def content_digest(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """(keys, n, digest): the multiset of rows per key.  Equal multisets have equal digests; unequal ones
    have equal ones with a chance of about 2^-124."""
    sums = [F.sum(F.pmod(h, F.lit(m))) for h in row_hashes(cols) for m in MODULI]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.struct(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).alias("digest"))


def _null_safe(keys: list[str], a: str, b: str) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return on


def differing_keys(source: DataFrame, indexed: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """The keys whose rows differ, with source_n and indexed_n (0: the side lacks the key)."""
    a, b = content_digest(source, keys, cols).alias("a"), content_digest(indexed, keys, cols).alias("b")
    j = a.join(b, _null_safe(keys, "a", "b"), "full_outer").where(~F.col("a.digest").eqNullSafe(F.col("b.digest")))
    present = F.col("a.n").isNotNull()
    return j.select(*[F.when(present, F.col(f"a.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in keys],
                    F.coalesce("a.n", F.lit(0)).alias("source_n"), F.coalesce("b.n", F.lit(0)).alias("indexed_n"))


def reconcile_content(source: DataFrame, indexed: DataFrame, keys: list[str], place: str = "offset", line: str = "line") -> DataFrame:
    """One row per line that differs: keys, place, status, source_line, indexed_line, source_n, indexed_n.

    ``lost``: fewer copies of it in the table than read; ``doubled``: more copies; ``altered``: at this place the
    table has another line than was read (each alteration is one row with both lines); ``extra``: a line at
    a place where none was read.  Nulls equal each other.  Sides that agree are only aggregated."""
    cols = [place, line]
    wrong = differing_keys(source, indexed, keys, cols).select(*keys)

    def of(df: DataFrame, n: str) -> DataFrame:
        # the wrong keys are few where the table is right; where they are not, this is a join by key with a semi side of distinct keys
        near = df.select(*keys, *cols).alias("d").join(wrong.alias("w"), _null_safe(keys, "d", "w"), "left_semi")
        return near.groupBy(*keys, *cols).agg(F.count(F.lit(1)).alias(n))

    none = F.lit(0).cast("bigint")
    both = of(source, "source_n").withColumn("indexed_n", none).unionByName(of(indexed, "indexed_n").withColumn("source_n", none))
    lines = both.groupBy(*keys, *cols).agg(F.sum("source_n").alias("source_n"), F.sum("indexed_n").alias("indexed_n"))
    # lines that are missing at a place are paired with those that are new there, in order of the lines
    off = lines.where("source_n <> indexed_n").withColumn("less", F.col("source_n") > F.col("indexed_n"))
    off = off.withColumn("i", F.row_number().over(Window.partitionBy(*keys, place, "less").orderBy(line)))
    entry = F.struct(F.col(line).alias("line"), "source_n", "indexed_n")
    at = off.groupBy(*keys, place, "i").agg(F.max(F.when(F.col("less"), entry)).alias("less"), F.max(F.when(~F.col("less"), entry)).alias("more"))
    less, more = F.col("less"), F.col("more")
    status = (F.when(less.isNotNull() & more.isNotNull(), ALTERED).when(less.isNotNull(), LOST)
              .when(more["source_n"] > 0, DOUBLED).otherwise(EXTRA))
    return at.select(
        *keys, place, status.alias("status"),
        F.when(less.isNotNull(), less["line"]).when(more["source_n"] > 0, more["line"]).alias("source_line"),
        F.when(more.isNotNull(), more["line"]).when(less["indexed_n"] > 0, less["line"]).alias("indexed_line"),
        F.when(less.isNotNull(), less["source_n"]).otherwise(more["source_n"]).alias("source_n"),
        F.when(more.isNotNull(), more["indexed_n"]).otherwise(less["indexed_n"]).alias("indexed_n"))
