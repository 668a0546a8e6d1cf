"""The corpus pipeline: each stage is one operator, its output written as
Parquet and read again as the next one's documents.

All stages but the last return the columns of ``documents``; the last adds the mixture's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linedocs.llm import decontam, linededup, mixing, quality, simhash
from linedocs.llm.common import dropping_intermediates, table, written


def columns(docs: DataFrame) -> list[Column]:
    """The columns of ``docs``, whatever their names hold."""
    return [F.col(f"`{c}`") for c in docs.columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    A null or empty text has too few words and goes; repeated rows share their fate; an empty table stays empty, and
    without labels only the base rules act.  A column ``kept`` or ``base_failed`` of the documents stays theirs."""
    judged = quality.judge(spark, docs, table(spark, sf_dir, "labels"), again=True, verdict_names=("__base_failed", "__kept"))
    return judged.where("__kept").select(*columns(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out of the texts; no document goes.

    Null texts stay null; of repeated rows the texts are cut alike; n_chars follows a text that was cut."""
    out = linededup.dedup_lines(spark, docs)
    length = F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))
    return out.withColumn("n_chars", length).select(*columns(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays, that with the smallest id (nulls last).

    Texts without words, null ones too, are one class; rows equal in id and text are one document."""
    return simhash.keep_one(spark, docs, shingle=3, distance=2)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item.  A null or empty text has none and stays, as do
    repeated rows; without items all stay."""
    scanned = decontam.decontaminate(spark, docs, table(spark, sf_dir, "benchmark"), window=10)
    return scanned.where("_scan.n_hit = 0").select(*columns(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its source's weight, how often it is used, and in which blocks.  A null source is one of
    its own; repeated rows have places of their own."""
    return mixing.mixed(spark, docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("source mixing", mixing_stage),
]

#: Fitted thresholds, fingerprints and the mixing exponent have no DuckDB form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents through all stages.  A stage's own tables go when its output is written; that stays, as
    the result reads the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with dropping_intermediates(spark):
            docs = written(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
