"""Mixing sources to target weights by temperature.

Source s with token share p_s gets the weight w_s = p_s^a / sum p^a.  The
exponent a in [0, 1] is found by repeated sectioning of that interval, sixteen
parts at a time (a bisection with fewer, wider steps), each step one aggregate over the
table of sources.  It is the largest that reaches the target entropy, raised
where a source would otherwise repeat more than the limit.

The weights become a stream of blocks.  Source s contributes w_s of every
block's tokens and runs through its documents in a new pseudo-random
permutation in each epoch.  A document's place is the number of its source's
tokens before it; that place over the source's tokens per block is its block.
Places are running sums, counted in 1024 slices of the permutation per source and
epoch, so that a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import KEY, WORD, document_key, null_safe, written

PARTS, STEPS, SLICES = 16, 9, 1024


@dataclass(frozen=True)
class Mixture:
    """Targets: entropy as a share of the largest possible, the most epochs of
    any source, tokens in all (None: the fewest that use every document) and per block.  A budget that
    even equal epochs cannot fill within the limit is not filled: ``weights`` reports what each source lacks."""

    entropy: float = 0.98
    max_epochs: float = 4.0
    budget: float | None = None
    block_tokens: int = 1 << 20


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def section(low: float, high: float, holds) -> float:
    """The smallest x in [low, high] at which ``holds`` (false, then true; true at high)."""
    for _ in range(STEPS):
        grid = [low + (high - low) * i / PARTS for i in range(PARTS + 1)]
        true = holds(grid)
        i = next((i for i in range(PARTS + 1) if true[i]), PARTS)
        if i == 0:
            return grid[0]
        low, high = grid[i - 1], grid[i]
    return high


def exponent(sources: DataFrame, mix: Mixture) -> float:
    """The exponent for rows (p): shares that are positive and sum to one."""
    count, least, most = sources.agg(F.count("*"), F.min("p"), F.max("p")).first()
    if not count or count == 1:
        return 1.0

    def sums(grid: list[float]) -> list[tuple[float, float]]:
        p, log = F.col("p"), F.log("p")
        row = sources.agg(*[f for a in grid for f in (F.sum(F.pow(p, F.lit(a))), F.sum(F.pow(p, F.lit(a)) * log))]).first()
        return list(zip(row[::2], row[1::2]))

    goal = mix.entropy * math.log(count)

    def too_low(grid: list[float]) -> list[bool]:  # entropy falls as the exponent grows
        return [math.log(z) - a * s / z < goal for a, (z, s) in zip(grid, sums(grid))]

    def few_epochs(grid: list[float]) -> list[bool]:  # so does the repetition of the smallest source
        if mix.budget is None:
            return [(least / most) ** (a - 1) <= mix.max_epochs for a in grid]
        total = sources.agg(F.sum("tokens")).first()[0]
        return [least ** (a - 1) / z * mix.budget / total <= mix.max_epochs for a, (z, _) in zip(grid, sums(grid))]

    wanted = 1.0 if not too_low([1.0])[0] else section(0.0, 1.0, too_low)
    allowed = section(0.0, 1.0, few_epochs) if not few_epochs([wanted])[0] else 0.0
    return max(wanted, allowed)


def weights(spark: SparkSession, documents: DataFrame, mix: Mixture) -> DataFrame:
    """(s, tokens, weight, epochs, lacking) for rows (s, tokens) of documents; lacking: tokens of the source's share
    of the budget that more epochs than the limit would have to give."""
    sources = written(spark, documents.groupBy("s").agg(F.sum("tokens").alias("tokens")), "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    some = sources.where("tokens > 0").withColumn("p", F.col("tokens") / F.lit(float(total or 1)))
    a = exponent(some, mix)
    z, largest = some.agg(F.sum(F.pow("p", F.lit(a))), F.max(F.pow("p", F.lit(1 - a)))).first()
    z, largest = z or 1.0, largest or 1.0
    budget = mix.budget if mix.budget is not None else total * z * largest
    share = F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(a)) / F.lit(z)
    epochs = F.col("weight") * F.lit(float(budget)) / F.col("tokens")
    wanted = F.round(epochs, 9)
    epochs = F.least(wanted, F.lit(float(mix.max_epochs))) if mix.budget is not None else F.greatest(F.lit(1.0), wanted)
    lacking = F.greatest(F.lit(0.0), wanted - mix.max_epochs) * F.col("tokens") if mix.budget is not None else F.lit(0.0)
    out = sources.withColumn("weight", F.when(F.col("tokens") > 0, share).otherwise(F.lit(0.0)))
    return out.withColumns({"epochs": F.when(F.col("tokens") > 0, epochs).otherwise(F.lit(1.0)),
                            "lacking": F.when(F.col("tokens") > 0, lacking).otherwise(F.lit(0.0))})


def placements(spark: SparkSession, docs: DataFrame, mix: Mixture = Mixture(), source: str = "source", doc_id: str = "doc_id",
               text: str = "text", tokens: Column | None = None, seed: int = 42) -> DataFrame:
    """One row per document and epoch in which it is used: key (__id, __h1, __h2),
    source, n_tokens, weight, epoch, place (tokens of the source before it) and block.

    Rows equal in id and text are one document.  A null source is a source of its own;
    null and empty texts have no tokens, and a source without any has weight 0 and
    is placed once, in block 0.  An empty table gives an empty result."""
    count = word_count(text) if tokens is None else tokens
    rows = docs.select(*document_key(doc_id, text), F.col(source).alias("source"), count.alias("tokens"))
    rows = written(spark, rows.dropDuplicates(KEY).withColumn("s", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))), "tokens")
    plan = weights(spark, rows.select("s", "tokens"), mix).withColumnRenamed("tokens", "total").drop("lacking")
    used = rows.join(plan, "s").where("epochs > 0")
    used = used.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.ceil("epochs").cast("int") - 1)))
    used = used.withColumn("h", F.xxhash64(F.lit(seed), "epoch", *KEY))
    used = written(spark, used.withColumn("slice", F.pmod(F.shiftright("h", 40), F.lit(SLICES))), "epochs")
    before = Window.partitionBy("s", "epoch").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = used.groupBy("s", "epoch", "slice").agg(F.sum("tokens").alias("t")).select(
        "s", "epoch", "slice", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("s", "epoch", "slice").orderBy("h", *KEY).rowsBetween(Window.unboundedPreceding, -1)
    placed = (used.withColumn("within", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
              .join(starts, ["s", "epoch", "slice"])
              .withColumn("place", F.col("epoch").cast("long") * F.col("total") + F.col("start") + F.col("within")))
    placed = placed.where((F.col("place") < F.col("epochs") * F.col("total")) | (F.col("total") == 0))
    block = F.when(F.col("weight") > 0, F.floor(F.col("place") / (F.col("weight") * mix.block_tokens))).otherwise(F.lit(0))
    return placed.select(*KEY, "source", F.col("tokens").alias("n_tokens"), "weight", "epoch", "place", block.cast("long").alias("block"))


def mixed(spark: SparkSession, docs: DataFrame, mix: Mixture = Mixture(), source: str = "source", doc_id: str = "doc_id",
          text: str = "text", tokens: Column | None = None, seed: int = 42) -> DataFrame:
    """``docs`` that the mixture uses, with weight, copies (times used) and
    blocks (where, ascending).  Columns of these names are replaced."""
    p = placements(spark, docs, mix, source, doc_id, text, tokens, seed)
    per_doc = p.groupBy(*KEY).agg(F.first("weight").alias("__weight"), F.count("*").alias("__copies"),
                                  F.array_sort(F.collect_list("block")).alias("__blocks"))
    per_doc = written(spark, per_doc, "mixture")
    keyed = docs.drop("weight", "copies", "blocks").withColumns(dict(zip(KEY, document_key(doc_id, text))))
    joined = null_safe(keyed, per_doc, KEY, "inner").drop(*KEY)
    return joined.withColumnsRenamed({"__weight": "weight", "__copies": "copies", "__blocks": "blocks"})
