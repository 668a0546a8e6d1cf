"""SimHash near-duplicates with a pigeonring candidate filter.

The 64 bits are a ring of m = 2d + 1 consecutive segments for the largest
distance d.  If two fingerprints differ in at most d bits, there is a segment
from which every chain of l consecutive segments holds at most l * d / m
differing bits (a stronger form of the pigeonhole rule: one start serves all
lengths).  Its budgets are 0, 0, 1, 1 for l = 1..4, so from that start two
segments agree and one of the next two does.  That is an equality on three
segments (about 38 bits for d = 2): the bucket keys.  Inside a bucket a pair
must keep all chain budgets before its full distance is computed.

A bucket yields a spanning forest of its links, never its pairs.  A bucket
over ``max_bucket`` fingerprints is refined exactly: among its bits that are
still free, cut in d + 2 parts, two parts must agree, for each choice of two.
Refinement goes on until a bucket has so few free bits that its size is
bounded by them.
"""

from __future__ import annotations

from itertools import combinations
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, null_safe, written

SEED = 42
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned fingerprint: bit set where over half of the shingles' XXH64
    have it.  Null or without a word: 0; fewer words than a shingle: all of them."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    h, join = xxhash.xxh64_intdigest, b" ".join
    n, ones = len(words) - shingle + 1, np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = words[at:at + BLOCK + shingle - 1]
        hashes = np.fromiter((h(join(s), SEED) for s in zip(*(part[i:] for i in range(shingle)))), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long."""
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return of(F.coalesce(text, F.lit("")))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def ring(distance: int) -> list[int]:
    """Bit masks of the 2d + 1 segments."""
    m = 2 * distance + 1
    edges = [round(64 * i / m) for i in range(m + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def first_masks(distance: int) -> list[int]:
    """Bits that are equal in a bucket, one mask for each bucket key."""
    s, m = ring(distance), 2 * distance + 1
    if distance == 0:
        return []
    if distance == 1:
        return [s[i] | s[(i + 1) % m] for i in range(m)]
    return sorted({s[i] | s[(i + 1) % m] | s[(i + k) % m] for i in range(m) for k in (2, 3)})


def finer_masks(mask: int, distance: int) -> list[int]:
    """The same, for links inside one bucket of ``mask``."""
    free = [b for b in range(64) if not mask >> b & 1]
    parts = [sum(1 << int(b) for b in p) for p in np.array_split(free, distance + 2)]
    return [mask | p | q for p, q in combinations(parts, 2)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def chains_kept(differing: np.ndarray, distance: int) -> np.ndarray:
    """Whether some start keeps all chain budgets, for words of differing bits."""
    m = 2 * distance + 1
    each = [np.bitwise_count(differing & np.uint64(s)).astype(np.int16) for s in ring(distance)]
    found = np.zeros(differing.shape, bool)
    for i in range(m):
        ok, total = np.ones(differing.shape, bool), np.zeros(differing.shape, np.int16)
        for length in range(1, m + 1):
            total = total + each[(i + length - 1) % m]
            ok &= total * m <= length * distance
        found |= ok
    return found


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within one bucket, as pairs of indexes."""
    n, out = len(fps), []
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    step = max(1, (1 << 20) // n)
    for at in range(0, n, step):
        x = fps[at:at + step, None] ^ fps[None, :]
        i, j = np.nonzero(np.triu(np.ones(x.shape, bool), at + 1))
        x = x[i, j]
        keep = chains_kept(x, distance)
        i, j, x = i[keep], j[keep], x[keep]
        near = np.bitwise_count(x) <= distance
        for a, b in zip((i[near] + at).tolist(), j[near].tolist()):
            ra, rb = find(a), find(b)
            if ra != rb:
                root[rb] = ra
                out.append((a, b))
    return out


def links(spark: SparkSession, fps: DataFrame, distance: int, max_bucket: int = 4096) -> DataFrame:
    """(a, b) for distinct fingerprints ``fp``: edges with the same connected
    components as all pairs at most ``distance`` bits apart."""
    def forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            a, b = [], []
            for members in frame["fps"]:
                v = np.asarray(members, np.int64)
                for i, j in forest(v.view(np.uint64), distance):
                    a.append(v[i])
                    b.append(v[j])
            yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    found = None
    masks = F.array(*[F.lit(signed(m)) for m in first_masks(distance)])
    rows = fps.select("fp", F.explode(masks).alias("mask")) if distance else None
    while rows is not None:
        keyed = rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp").distinct()
        sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n"))
        # with at most 8 free bits a bucket holds at most 256 fingerprints
        large = written(spark, sizes.where((F.col("n") > max_bucket) & (F.bit_count("mask") < 56))
                        .select("mask", "key"), "large-buckets")
        some = large.select("mask").distinct().collect()  # masks, at most 10 times 6 to the number of refinements
        small = keyed.join(large, ["mask", "key"], "left_anti") if some else keyed
        lists = (small.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
                 .where(F.size("fps") > 1).select("fps"))
        edges = lists.mapInPandas(forests, "a long, b long")
        if some:
            edges = written(spark, edges, "links")
        found = edges if found is None else found.union(edges)
        rows = None
        if some:
            finer = F.create_map(*[x for r in some for x in (F.lit(r["mask"]), F.array(*[
                F.lit(signed(m)) for m in finer_masks(r["mask"] & (1 << 64) - 1, distance)]))])
            rows = (keyed.join(large, ["mask", "key"], "left_semi")
                    .select("fp", F.explode(finer[F.col("mask")]).alias("mask")).distinct())
    return found if found is not None else fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")


def classes(spark: SparkSession, ids: DataFrame, distance: int, max_bucket: int = 4096) -> DataFrame:
    """(fp, root, component_id) for (doc_id, fp): exact copies meet in one fingerprint
    first, then fingerprints link; the class is its smallest non-null doc_id."""
    fps = written(spark, ids.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(spark, links(spark, fps.select("fp"), distance, max_bucket))
    placed = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(spark: SparkSession, df: DataFrame, shingle: int = 3, distance: int = 2,
                    doc_id: str = "doc_id", text: str = "text", max_bucket: int = 4096) -> DataFrame:
    """One row (doc_id, fingerprint, component_id) per row of ``df``.

    Null and empty texts have fingerprint zero and link like any other; rows
    with a null id belong to a class but never name it (a class of null ids
    alone has a null component_id); repeated rows come out once each; an empty
    table gives an empty one; further columns are not looked at."""
    ids = written(spark, df.select(F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text), shingle).alias("fp")),
                  "fingerprint-rows")
    return ids.join(classes(spark, ids, distance, max_bucket), "fp").select(
        "doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(spark: SparkSession, df: DataFrame, shingle: int = 3, distance: int = 2,
             doc_id: str = "doc_id", text: str = "text", max_bucket: int = 4096) -> DataFrame:
    """``df`` with one document of each class: the one of smallest doc_id (null
    last, then by fingerprint).  Rows equal in both count as one document, of
    which one row stays.  Columns are those of ``df``."""
    columns = df.columns
    key = fingerprint_column(F.col(text), shingle)
    ids = written(spark, df.select(F.col(doc_id).alias("__id"), key.alias("__fp")).distinct(), "fingerprint-rows")
    reached = classes(spark, ids.select(F.col("__id").alias("doc_id"), F.col("__fp").alias("fp")), distance, max_bucket)
    ranked = ids.join(reached.withColumnRenamed("fp", "__fp"), "__fp")
    first = ranked.groupBy("root").agg(F.min(F.struct(F.col("__id").isNull().alias("n"), "__id", "__fp")).alias("m"))
    named = first.select("m.__id", "m.__fp")
    keyed = df.withColumn("__id", F.col(doc_id)).withColumn("__fp", key).dropDuplicates(["__id", "__fp"])
    return null_safe(keyed, named, ["__id", "__fp"], "left_semi").select(*[F.col(f"`{c}`") for c in columns])
