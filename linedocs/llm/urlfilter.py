r"""URL filters as a sort-merge range join.

A host's labels are reversed, so a host and its subdomains share a prefix, and
so do the paths below a rule's path: the canonical key of a rule is its
reversed host, a zero byte and its path.  All keys that begin with it form one interval,
from the key itself to the key followed by byte FF (which UTF-8 never uses).
Intervals of prefixes nest or are disjoint.  A page enters with one key for
each of its host's suffixes that is a rule's host.

The sweep: interval starts, page keys and interval ends are dealt by range and
sorted; at every place the stack of active rules is known by its top, which a
start sets to its rule and an end to the rule around it.  A range partition
takes over the top from the ones before it, through a table with one row per
partition.  Only distinct (host, path) pairs are swept, so a page address that
fills a third of the table is one row; nothing but built-in functions runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, written

TOP = "struct<n:int,labels:int,rule:string,verdict:string>"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    parts = r"^([^/?#]*)([^?#]*)"
    empty = F.lit("")
    return (F.coalesce(ascii_lower(F.regexp_extract(rest, parts, 1)), empty),
            F.coalesce(F.regexp_extract(rest, parts, 2), empty))


def key(host: Column, path: Column) -> Column:
    reverse = F.array_join(F.reverse(F.split(host, r"\.")), ".")
    return F.encode(F.concat(reverse, F.lit("\0"), path), "UTF-8")


def top(rule: str = "rule", verdict: str = "verdict") -> Column:
    return F.struct(F.length(rule).alias("n"), F.size(F.split("host", r"\.")).alias("labels"),
                    F.col(rule).alias("rule"), F.col(verdict).alias("verdict")).cast(TOP)


def no_rule() -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(0).alias("n"), F.lit(0).alias("labels"), none.alias("rule"), none.alias("verdict")).cast(TOP)


def boundaries(rules: DataFrame) -> DataFrame:
    """(k, kind, top): the stack's top from each interval start and end on."""
    r = rules.select("host", "path", key(F.col("host"), F.col("path")).alias("k"), top().alias("top"))
    # the rule around another: the longest proper prefix of its path under the same host
    prefixes = r.select("host", "path", F.explode(F.expr(
        "transform(sequence(0, length(path)), i -> substring(path, 1, i))")).alias("prefix")).where("prefix <> path")
    outer = r.select(F.col("host").alias("oh"), F.col("path").alias("op"), F.col("top").alias("ot"))
    around = (prefixes.join(outer, (F.col("host") == F.col("oh")) & (F.col("prefix") == F.col("op")))
              .groupBy("host", "path").agg(F.max("ot").alias("around")))
    starts = r.select("k", F.lit(0).alias("kind"), "top")
    ends = r.join(around, ["host", "path"], "left").select(
        F.concat("k", F.lit(bytearray(b"\xff"))).alias("k"), F.lit(0).alias("kind"),
        F.coalesce("around", no_rule()).alias("top"))
    return starts.unionByName(ends)


def sweep(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Rows of kind 1 with the ``top`` that is active at their place."""
    dealt = written(spark, events.repartitionByRange("k").withColumn("part", F.spark_partition_id()), "sweep")
    order = Window.partitionBy("part").orderBy("k", "kind")
    inside = dealt.withColumn("top", F.last("top", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("kind = 1")
    # one row per range partition
    last = dealt.groupBy("part").agg(F.max_by("top", F.when(F.col("top").isNotNull(), F.col("k"))).alias("last"))
    carried = last.select("part", F.last("last", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    return inside.join(carried, "part").withColumn("top", F.coalesce("top", "carried", no_rule())).drop("part", "carried", "kind")


def judge(spark: SparkSession, pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (host followed by path, else null) and verdict.

    ``rules`` has host, path and verdict.  A rule fits its host and all
    subdomains where the path starts with the rule's; the longest rule wins (of
    two equally long ones that with more host labels), without one the verdict is
    ``default``.  Two verdicts for one rule: block wins; rules with a null are
    left out.  A null url, or one without ``://``, has an empty host and path.
    Rows pass one to one, repeated ones too; columns of the result's names are
    replaced; empty tables give an empty result or the default verdict."""
    rules = (rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").dropna()
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
             .withColumn("rule", F.concat("host", "path")))
    host, path = host_and_path(F.col(url))
    pages = pages.withColumns({"host": host, "path": path}).drop("rule", "verdict")
    places = pages.select("host", "path").distinct()
    # no rule's host has more labels than this
    most = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    suffix = F.expr("transform(sequence(greatest(1, size(labels) - %d), size(labels)), "
                    "i -> array_join(slice(labels, i, size(labels)), '.'))" % max(most - 1, 0))
    suffixes = (places.withColumn("labels", F.split("host", r"\."))
                .select("host", "path", F.explode(suffix).alias("suffix")))
    ruled = suffixes.join(rules.select(F.col("host").alias("suffix")).distinct(), "suffix", "left_semi")
    keyed = written(spark, ruled.withColumn("k", key(F.col("suffix"), F.col("path"))), "page-keys")
    events = boundaries(rules).unionByName(
        keyed.select("k").distinct().select("k", F.lit(1).alias("kind"), no_rule().alias("top"))
        .withColumn("top", F.when(F.lit(False), F.col("top"))))
    best = keyed.join(sweep(spark, events), "k").groupBy("host", "path").agg(F.max("top").alias("__top"))
    joined = pages.join(best, ["host", "path"], "left")
    return joined.withColumns({"rule": F.col("__top.rule"), "verdict": F.coalesce("__top.verdict", F.lit(default))}).drop("__top")
