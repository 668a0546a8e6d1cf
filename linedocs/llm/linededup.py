"""Line deduplication with a distributed suffix array over line ids.

A text is the sequence of its lines that hold a word; blank lines are
transparent.  A run of lines with at least ``min_words`` words that occurs
earlier in the corpus (smaller document id, then place) is a later copy and is deleted.

* Lines that occur once cannot lie in a repeated run, so the sequences are cut
  there into islands; islands under ``min_words`` words are done.
* The suffixes of the islands are ranked by prefix doubling: the rank at depth
  2h is the rank at depth h plus the number of suffixes of the same class whose
  rank h lines further on is smaller.  It is counted over distinct (rank, next rank)
  pairs, pre-aggregated and dealt in slices of next ranks, so that a line that is a
  third of the corpus is neither one task nor one group.
* Suffixes that share their first l lines are one longest-common-prefix
  interval of the suffix array.  Every maximal repeated run of enough words is the
  union of the *shortest* sufficient runs that start or end at its lines, and
  those hold at most ``min_words`` lines.  So ranks to that depth settle every
  interval that matters, and the number of rounds does not depend on the
  longest repeat.  The interval of a run of l lines at i is named by l and the
  ranks at depth h = 2^floor(log2 l) of i and of i + l - h, which cover it.
* In each interval the first occurrence stays; runs that do not overlap it are deleted.

Only built-in functions run; each round is written to the shared folder.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import KEY, WORD, document_key, null_safe, written

#: Next ranks per slice of a class while it is ranked.
SLICE_BITS = 20


def line_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Key, seq (number among the lines with a word), pos, 128 bits of the line, words."""
    lines = F.filter(F.transform(F.split(F.col(text), "\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("line"))),
                     lambda s: s["line"].rlike(WORD))
    rows = docs.select(*document_key(doc_id, text), F.posexplode(lines).alias("seq", "s"))
    return rows.select(*KEY, "seq", F.col("s.pos").alias("pos"), F.xxhash64("s.line").alias("a"),
                       F.xxhash64(F.lit("line"), "s.line").alias("b"),
                       F.regexp_count("s.line", F.lit(WORD)).cast("long").alias("w"))


def first_ranks(lines: DataFrame) -> DataFrame:
    """(a, b, r): the number of occurrences of repeated lines with a smaller id."""
    repeated = lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").withColumn(
        "slice", F.shiftright("a", 52))
    inside = Window.partitionBy("slice").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # 4096 rows at most
    starts = repeated.groupBy("slice").agg(F.sum("n").alias("t")).select(
        "slice", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("start"))
    return (repeated.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(starts, "slice").select("a", "b", (F.col("start") + F.col("within")).alias("r")))


def doubled(pairs: DataFrame) -> DataFrame:
    """(r, ahead, next): ranks at twice the depth, from rows (r, ahead), ahead = -1 at an end."""
    slices = pairs.groupBy("r", "ahead").agg(F.count("*").alias("n")).withColumn("slice", F.shiftright("ahead", SLICE_BITS))
    inside = Window.partitionBy("r", "slice").orderBy("ahead").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("r").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.groupBy("r", "slice").agg(F.sum("n").alias("t")).select(
        "r", "slice", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("start"))
    return (slices.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(starts, ["r", "slice"]).select("r", "ahead", (F.col("r") + F.col("start") + F.col("within")).alias("next")))


def suffixes(spark: SparkSession, docs: DataFrame, min_words: int, doc_id: str, text: str) -> DataFrame:
    """Suffixes of the islands: key, seq, pos, island, w, c (words before in the
    island), total (words of the island), r0 (rank at depth one line)."""
    lines = written(spark, line_table(docs, doc_id, text).groupBy(*KEY, "seq", "pos").agg(
        *[F.first(c).alias(c) for c in ("a", "b", "w")]), "lines")
    rows = lines.join(first_ranks(lines), ["a", "b"]).select(*KEY, "seq", "pos", "w", F.col("r").alias("r0"))
    of_doc = Window.partitionBy(*KEY).orderBy("seq")
    rows = rows.withColumn("island", F.col("seq") - F.row_number().over(of_doc))
    island = Window.partitionBy(*KEY, "island")
    so_far = island.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"c": F.sum("w").over(so_far) - F.col("w"), "total": F.sum("w").over(island)})
    return written(spark, rows.where(F.col("total") >= min_words), "suffixes")


def sufficient_runs(rows: DataFrame, min_words: int) -> DataFrame:
    """(key, start, l): the shortest runs of ``min_words`` words from and to each line."""
    island = Window.partitionBy(*KEY, "island")
    ahead = F.count("*").over(island.orderBy("c").rangeBetween(0, min_words - 1))
    behind = F.count("*").over(island.orderBy("d").rangeBetween(1 - min_words, 0))
    rows = rows.withColumn("d", F.col("c") + F.col("w")).withColumns({"ahead": ahead, "behind": behind})
    both = F.array(
        F.when(F.col("total") - F.col("c") >= min_words, F.struct(F.col("seq").cast("long").alias("start"), F.col("ahead").alias("l"))),
        F.when(F.col("d") >= min_words, F.struct((F.col("seq") - F.col("behind") + 1).alias("start"), F.col("behind").alias("l"))))
    return rows.select(*KEY, F.explode(F.array_distinct(F.array_compact(both))).alias("run")).select(*KEY, "run.*").distinct()


def later_copies(spark: SparkSession, docs: DataFrame, min_words: int, doc_id: str, text: str) -> DataFrame:
    """(key, gone: array of (from, to)): inclusive ranges of line numbers to delete."""
    rows = suffixes(spark, docs, min_words, doc_id, text)
    runs = written(spark, sufficient_runs(rows, min_words), "runs")
    longest = runs.agg(F.max("l")).first()[0] or 1
    levels = int(math.log2(longest)) + 1
    for k in range(1, levels):
        rank = F.lead(f"r{k - 1}", 1 << (k - 1)).over(Window.partitionBy(*KEY, "island").orderBy("seq"))
        pairs = rows.withColumn("ahead", F.coalesce(rank, F.lit(-1)))
        ranks = doubled(pairs.select(F.col(f"r{k - 1}").alias("r"), "ahead"))
        rows = written(spark, pairs.join(ranks.withColumnRenamed("r", f"r{k - 1}"), [f"r{k - 1}", "ahead"])
                       .withColumnRenamed("next", f"r{k}").drop("ahead"), "ranks")
    ranked = rows.select(*KEY, F.col("seq").cast("long").alias("at"), F.array(*[f"r{k}" for k in range(levels)]).alias("r"))
    runs = runs.withColumn("k", F.floor(F.log2("l")).cast("int"))
    runs = runs.withColumn("k", F.when(F.expr("shiftleft(1, k)") > F.col("l"), F.col("k") - 1).otherwise(F.col("k")))
    head = null_safe(runs.withColumn("at", F.col("start")), ranked, [*KEY, "at"], "inner")
    head = head.withColumn("ra", F.col("r")[F.col("k")]).drop("r", "at")
    tail = F.col("start") + F.col("l") - F.expr("shiftleft(1, k)")
    named = null_safe(head.withColumn("at", tail), ranked, [*KEY, "at"], "inner")
    named = named.withColumn("rb", F.col("r")[F.col("k")]).select(*KEY, "start", "l", "ra", "rb")
    name = ["l", "ra", "rb"]
    place = F.struct(F.col("__id").isNull().alias("n"), *KEY, "start")
    # written, so that the join below deals it anew and a passage with very many copies can be split
    first = written(spark, named.groupBy(*name).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "first")
    same = F.col("first.__id").eqNullSafe(F.col("__id")) & (F.col("first.__h1") == F.col("__h1")) & (F.col("first.__h2") == F.col("__h2"))
    copies = named.join(first, name).where(~same | (F.col("start") >= F.col("first.start") + F.col("l")))
    # +1 where a copy starts, -1 behind it: the running sum tells the lines inside one
    steps = copies.select(*KEY, F.explode(F.array(
        F.struct(F.col("start").alias("seq"), F.lit(1).alias("step")),
        F.struct((F.col("start") + F.col("l")).alias("seq"), F.lit(-1).alias("step")))).alias("s")).select(*KEY, "s.*")
    steps = steps.groupBy(*KEY, "seq").agg(F.sum("step").alias("step"))
    places = rows.select(*KEY, F.col("seq").cast("long").alias("seq"), "pos", F.lit(0).cast("long").alias("step"))
    marked = steps.select(*KEY, "seq", F.lit(None).cast("int").alias("pos"), "step").unionByName(places)
    marked = marked.groupBy(*KEY, "seq").agg(F.max("pos").alias("pos"), F.sum("step").alias("step"))
    of_doc = Window.partitionBy(*KEY).orderBy("seq")
    marked = marked.withColumn("open", F.sum("step").over(of_doc.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    marked = marked.where("open > 0").withColumn("group", F.col("seq") - F.row_number().over(of_doc))
    ranges = marked.groupBy(*KEY, "group").agg(F.struct(F.min("pos").alias("from"), F.max("pos").alias("to")).alias("range"))
    return ranges.groupBy(*KEY).agg(F.array_sort(F.collect_list("range")).alias("_gone"))


def dedup_lines(spark: SparkSession, docs: DataFrame, min_words: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without later copies of repeated line runs, with the column
    ``_gone``: the deleted ranges of line numbers, from 0 and inclusive (null: none).

    Blank lines between deleted lines go with them.  The order of copies is that
    of document ids (null last, then by text hash) and places.  Rows equal in id
    and text are the same document and get the same result.  Null and empty texts
    stay as they are; a text may become empty but its row stays; an empty table
    gives an empty one.  Names that start with an underscore are reserved."""
    columns = docs.columns
    gone = written(spark, later_copies(spark, docs, min_words, doc_id, text), "gone")
    keyed = docs.withColumns(dict(zip(KEY, document_key(doc_id, text))))
    # texts are dealt by key at every size: how much is deleted has no bound that would prove a broadcast
    joined = null_safe(keyed, gone.hint("merge"), KEY, "left")
    lines = F.split(F.col(text), "\n")
    starts = F.concat(F.array(F.lit(0)), F.transform("_gone", lambda g: g["to"] + 1))
    ends = F.concat(F.transform("_gone", lambda g: g["from"]), F.array(F.size("__lines")))
    kept = F.flatten(F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")),
                                 lambda x: F.slice("__lines", x["s"] + 1, F.greatest(x["e"] - x["s"], F.lit(0)))))
    # texts without copies are not split
    joined = joined.withColumn("__lines", F.when(F.col("_gone").isNotNull(), lines))
    shorter = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn(text, shorter).select(*[F.col(f"`{c}`") for c in columns], "_gone")
