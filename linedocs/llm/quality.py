"""Quality rules with risk-controlled thresholds.

Each document has rates that grow with junk: symbols, duplicate lines, repeated
words, capitals, word length, and the evidence of its words.  Base rules have fixed limits;
the other cutoffs are chosen from labels, per stratum (language), among the documents that the base rules let pass:

* One half of the labelled documents (by a hash of the id) fits: the median and
  the 99th percentile of each rate among good documents, and the words of each language that are in bad documents more often
  than chance allows (exact binomial test against the language's share of bad documents; a step-up rule over its words).
  A document's evidence is the sum of its distinct words' smoothed log-odds of being in a bad one.
* A document's excess is its largest rate in units of (99th percentile - median)
  above the median.  So one number moves the cutoffs of all rules together.
* The other half is the holdout.  Going from the most lenient cutoff to
  stricter ones, a cutoff is valid while the exact (Clopper-Pearson) upper bound on
  the share of good documents that it rejects is at most ``risk``.  The order is fixed
  before the holdout is seen, so stopping at the first failure needs no further
  correction within a stratum; across strata the error level is divided by their number.
* Of the valid cutoffs the most lenient is taken that catches nearly as many
  bad fitting documents as the strictest one: a stricter one would only cost good documents.

Strata with too few good holdout documents for any cutoff to be valid are one joint stratum, with
its own median, percentile, cutoff and bound; which these are is told from their numbers of documents alone.
With too few in the joint stratum too, only the base rules reject there.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, few, written
from .decontam import words_of

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_capitals", "evidence"]  # evidence in thousandths
FEATURES = ", ".join(f"{c} long" for c in COUNTS + MORE)
SPACE = " \t\n\x0b\x0c\r"
CAPITALS = bytes(range(65, 91))

#: Rates, and the least that counts as one unit of each.
RATES = {"symbols": 0.01, "dup_lines": 0.05, "repeats": 0.05, "capitals": 0.05, "length": 1.0, "evidence": 0.2}
#: The lenient end is for evidence, which single words have by accident and bad documents many times over.
GRID = [100.0, 80.0, 60.0, 50.0, 40.0, 30.0, 25.0, 20.0, 17.0, 14.0, 12.0, 10.0, 8.0, 7.0, 6.0, 5.0, 4.5, 4.0, 3.5, 3.0, 2.75, 2.5, 2.25, 2.0, 1.75, 1.5, 1.25, 1.0]


@dataclass(frozen=True)
class Limits:
    """Fixed limits of the base rules, risk and error level of the others, and
    the number of labelled documents that words are fitted on, shared by the languages."""

    least_words: int = 50
    repeat_percent: int = 50
    risk: float = 0.01
    level: float = 0.05
    catch: float = 0.99
    fit_rows: int = 50_000


def counts_of(text: str | None, weights: dict[bytes, float] | None = None) -> tuple:
    """The counts of one text: COUNTS, then lines with a word, capitals, evidence."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            seen = Counter(windows)
            end = 0
            for i, w in enumerate(windows):
                if seen[w] > 1:
                    repeated += i + 3 - max(end, i)
                    end = i + 3
    return (n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines),
            len(raw) - len(raw.translate(None, CAPITALS)), round(1000 * math.fsum(weights[w] for w in set(words_of(text)) & weights.keys())) if weights else 0)


def counted(spark: SparkSession, text: Column, stratum: Column, weights: dict[str, dict[bytes, float]]) -> Column:
    known = spark.sparkContext.broadcast(weights)

    @F.pandas_udf(FEATURES)
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, strata in batches:
            yield pd.DataFrame(np.array([counts_of(t, known.value.get(s)) for t, s in zip(texts, strata)], np.int64).reshape(-1, len(COUNTS + MORE)),
                               columns=COUNTS + MORE)

    return of(F.coalesce(text, F.lit("")), stratum)


def rates(f: str) -> dict[str, Column]:
    """The rates of a struct column of counts."""
    def per(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(f"{f}.{a}"), F.col(f"{f}.{b}")), F.lit(0.0))

    return {"symbols": per("n_symbols", "word_chars"), "dup_lines": per("n_dup_lines", "n_lines"),
            "repeats": per("n_repeat_words", "n_words"), "capitals": per("n_capitals", "word_chars"),
            "length": per("word_chars", "n_words"), "evidence": F.col(f"{f}.evidence") / 1000}


def labelled(labels: DataFrame) -> DataFrame:
    """One row (_label_id, good, fit) per labelled id: good without any bad label."""
    good = (F.min("quality") == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)
    return (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("__label_id"))
            .agg(good.alias("good")).withColumn("fit", F.pmod(F.xxhash64("__label_id", F.lit(7)), F.lit(2)) == 0))


def binomial_bound(k: int, n: int, level: float, upper: bool) -> float:
    """Exact one-sided bound on a probability after k of n."""
    if n == 0 or (upper and k >= n):
        return 1.0 if upper else 0.0
    if not upper:
        return 1.0 - binomial_bound(n - k, n, level, True)
    steps = np.arange(k + 1)
    choose = np.array([math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in steps])
    low, high = k / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        logs = choose + steps * math.log(p) + (n - steps) * math.log1p(-p) if 0 < p < 1 else np.array([-math.inf])
        if logs.max() > -700 and float(np.exp(logs - logs.max()).sum()) * math.exp(logs.max()) > level:
            low = p
        else:
            high = p
    return high


def binomial_tail(k: int, n: int, p: float) -> float:
    """Probability of k or more of n, each with probability p."""
    if k <= 0:
        return 1.0
    if p <= 0 or k > n:
        return 0.0
    if p >= 1:
        return 1.0
    i = np.arange(k, n + 1)
    logs = np.array([math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) for j in i]) + i * math.log(p) + (n - i) * math.log1p(-p)
    return min(1.0, float(np.exp(logs).sum()))


def word_weights(spark: SparkSession, docs: DataFrame, marks: DataFrame, limits: Limits, doc_id: str, text: str,
                 stratum: Column) -> dict[str, dict[bytes, float]]:
    """Log-odds of the words that tell bad documents, by stratum, from a bounded sample (by hash of the id) of the
    fitting half.  Strata have equal shares of the sample, so a small language is not lost in it; a word
    is told by the exact test alone, whatever its count: the share of words told by chance is held below ``level`` by the
    step-up rule, and what they cost good documents is seen in the holdout."""
    fit = docs.select(F.col(doc_id).alias("__label_id"), stratum.alias("stratum")).join(marks.where("fit"), "__label_id")
    sizes = written(spark, fit.groupBy("stratum").agg(F.count("*").alias("size")), "fit-sizes")
    share = F.least(F.lit(1.0), F.lit(limits.fit_rows / max(1, sizes.count())) / F.col("size"))
    kept = F.pmod(F.xxhash64("__label_id", F.lit(11)), F.lit(1 << 20)) < share * (1 << 20)
    sample = fit.join(few(sizes), "stratum").where(kept).select("__label_id", "good").distinct()  # about fit_rows narrow rows
    rows = docs.select(F.col(doc_id).alias("__label_id"), stratum.alias("stratum"), F.col(text).alias("t")).join(F.broadcast(sample), "__label_id")
    words = F.array_distinct(F.split(ascii_lower(F.coalesce("t", F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    rows = written(spark, rows.select("stratum", "good", words.alias("words")), "fit-words")
    bad = F.sum((~F.col("good")).cast("int"))
    shares = rows.groupBy("stratum").agg(((bad + 1) / (F.count("*") + 2)).alias("base"))
    by_word = rows.select("stratum", "good", F.explode("words").alias("word")).where("word <> ''").groupBy("stratum", "word").agg(
        F.count("*").alias("n"), bad.alias("bad"))
    by_word = written(spark, by_word, "words")
    many = by_word.groupBy("stratum").agg(F.count("*").alias("many"))

    @F.pandas_udf("double")
    def tail(bad: pd.Series, n: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([binomial_tail(int(b), int(m), p) for b, m, p in zip(bad, n, base)])

    known = few(written(spark, shares.join(many, "stratum"), "shares"))
    tested = by_word.join(known, "stratum").where(F.col("bad") > F.col("base") * F.col("n")).withColumn("p", tail("bad", "n", "base"))
    # words of a bounded sample: a window over those of one language
    by_p = Window.partitionBy("stratum").orderBy("p")
    step = tested.where(F.col("p") <= limits.level).withColumn("passes", F.col("p") * F.col("many") <= limits.level * F.count("*").over(by_p))
    told = step.withColumn("last", F.max(F.when(F.col("passes"), F.col("p"))).over(Window.partitionBy("stratum"))).where("p <= last")
    odds = F.log((F.col("bad") + 1) / (F.col("n") - F.col("bad") + 1)) - F.log(F.col("base") / (1 - F.col("base")))
    out: dict[str, dict[bytes, float]] = {}
    for r in told.select("stratum", "word", F.round(odds, 6).alias("weight")).where("weight > 0").collect():
        out.setdefault(r["stratum"], {})[r["word"].encode()] = r["weight"]
    return out


def excess(center: Column, unit: Column, f: str) -> Column:
    """The largest rate of ``f`` in units above the centre."""
    return F.greatest(*[(c - center[i]) / unit[i] for i, c in enumerate(rates(f).values())])


POOL = "*"  # the joint stratum: no other has this name


def carrying(sizes: dict[int, int], level: float, risk: float) -> int:
    """The fewest good holdout documents with which a stratum stands alone, from how many strata have how many:
    as many of the largest as can each carry the bound, the level divided by their number and one for the rest."""
    alone, least = 0, 1 << 62
    for n in sorted(sizes, reverse=True):
        alone += sizes[n]
        if binomial_bound(0, n, level / (alone + (n > min(sizes))), True) > risk:
            break
        least = n
    return least


def thresholds(spark: SparkSession, features: DataFrame, marks: DataFrame, limits: Limits) -> DataFrame:
    """(stratum, center, unit, cutoff) from rows (_label_id, stratum, f)."""
    # what the base rules reject is rejected whatever the cutoff, and spends no risk
    rows = written(spark, features.join(marks, "__label_id").where(~base_failed("f", limits)), "labelled")
    size = rows.groupBy(F.col("stratum").alias("own")).agg(F.sum((F.col("good") & ~F.col("fit")).cast("long")).alias("size"))
    size = written(spark, size, "sizes")
    sizes = size.groupBy(F.least("size", F.lit(10_000)).alias("size")).agg(F.count("*").alias("n")).collect()  # 10,001 rows at most
    alone = F.col("size") >= carrying({r["size"]: r["n"] for r in sizes}, limits.level, limits.risk)
    groups = size.select("own", F.when(alone, F.col("own")).otherwise(F.lit(POOL)).alias("stratum"))
    rows = rows.withColumnRenamed("stratum", "own").join(few(groups), "own")
    least = list(RATES.values())
    named = rates("f")
    centers = rows.where("fit and good").groupBy("stratum").agg(
        F.array(*[F.percentile_approx(c, F.lit(0.5), F.lit(10000)) for c in named.values()]).alias("center"),
        F.array(*[F.percentile_approx(c, F.lit(0.99), F.lit(10000)) for c in named.values()]).alias("high"))
    centers = centers.select("stratum", "center", F.transform(
        F.arrays_zip(F.col("high").alias("h"), F.col("center").alias("c"), F.array(*map(F.lit, least)).alias("u")),
        lambda x: F.greatest(x["h"] - x["c"], x["u"])).alias("unit"))
    scored = rows.join(few(written(spark, centers, "centers")), "stratum").withColumn("x", excess(F.col("center"), F.col("unit"), "f"))
    held = F.col("good") & ~F.col("fit")
    bad = ~F.col("good") & F.col("fit")
    table = scored.groupBy("stratum", "center", "unit").agg(
        F.sum(held.cast("long")).alias("n"),
        F.array(*[F.sum((held & (F.col("x") > g)).cast("long")) for g in GRID]).alias("wrong"),
        F.array(*[F.sum((bad & (F.col("x") > g)).cast("long")) for g in GRID]).alias("caught"))
    table = written(spark, table, "strata")
    strata = table.count()

    @F.pandas_udf("double")
    def cutoff(n: pd.Series, wrong: pd.Series, caught: pd.Series) -> pd.Series:
        out = []
        for total, w, c in zip(n, wrong, caught):
            valid = 0
            while valid < len(GRID) and binomial_bound(int(w[valid]), int(total), limits.level / strata, True) <= limits.risk:
                valid += 1
            useful = [i for i in range(valid) if c[valid - 1] and c[i] >= limits.catch * c[valid - 1]]
            out.append(GRID[useful[0]] if useful else math.inf)
        return pd.Series(out)

    found = table.select("stratum", "center", "unit", cutoff("n", "wrong", "caught").alias("cutoff"))
    return written(spark, groups.join(found, "stratum").select(F.col("own").alias("stratum"), "center", "unit", "cutoff"), "thresholds")


def stratum_of(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))


def base_failed(f: str, limits: Limits) -> Column:
    return (F.col(f"{f}.n_words") < limits.least_words) | (100 * F.col(f"{f}.n_repeat_words") > limits.repeat_percent * F.col(f"{f}.n_words"))


def verdict(rows: DataFrame, limits: Limits, names: tuple[str, str]) -> DataFrame:
    """``rows`` with the columns ``names``, base_failed and kept, from the columns _f and those of thresholds."""
    failed = base_failed("__f", limits)
    beyond = F.coalesce(excess(F.col("__center"), F.col("__unit"), "__f") > F.col("__cutoff"), F.lit(False))
    return rows.withColumns({names[0]: failed, names[1]: ~failed & ~beyond})


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, limits: Limits = Limits(), keep: list[str] | None = None,
          doc_id: str = "doc_id", text: str = "text", stratum: str = "lang", again: bool = False,
          verdict_names: tuple[str, str] = ("base_failed", "kept")) -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with the struct ``_f`` of counts, base_failed and kept.  These replace
    columns of the same names, unless ``verdict_names`` has others.

    Null and empty texts have no words and fail the base rules; a null stratum is one of its own; ids
    without a label, null ids included, are judged like all others; several
    labels of one id count as one, good if none is bad.  Rows pass one to one; empty tables give an
    empty result, or the base rules' verdict if only labels are missing.  With ``again`` the counts are made anew for the
    result instead of being carried with it, so that whole rows are never written or shuffled."""
    keep = docs.columns if keep is None else keep
    marks = written(spark, labelled(labels), "marks")
    weights = word_weights(spark, docs, marks, limits, doc_id, text, stratum_of(stratum))
    count = counted(spark, F.col(text), stratum_of(stratum), weights)
    if again:
        base = docs.select(*[F.col(f"`{c}`") for c in keep], stratum_of(stratum).alias("__stratum"), count.alias("__f"))
        narrow = docs.select(F.col(doc_id).alias("__label_id"), stratum_of(stratum).alias("stratum"), count.alias("f"))
    else:
        base = written(spark, docs.select(*[F.col(f"`{c}`") for c in keep], F.col(doc_id).alias("__label_id"),
                                          stratum_of(stratum).alias("__stratum"), count.alias("__f")), "features")
        narrow = base.select("__label_id", F.col("__stratum").alias("stratum"), F.col("__f").alias("f"))
    cut = thresholds(spark, narrow, marks, limits).select(
        F.col("stratum").alias("__stratum"), F.col("center").alias("__center"), F.col("unit").alias("__unit"), F.col("cutoff").alias("__cutoff"))
    judged = verdict(base.join(few(cut), "__stratum", "left"), limits, verdict_names)
    return judged.select(*[F.col(f"`{c}`") for c in keep if c not in verdict_names], "__f", *verdict_names)
