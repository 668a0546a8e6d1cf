"""Benchmark decontamination with an Aho-Corasick automaton over words.

Texts and test items are normalised to words (A-Z lower-cased; digits,
letters and everything beyond ASCII).  The automaton's alphabet is the words
of the test items: each gets one code point, so a text becomes a string with
one character per word, is scanned once, and a match's offset is a word
number.  Patterns are all windows of ``window`` consecutive item words; an item
of fewer words is one window.  Word numbers are mapped back to code points of
the original text where something was hit.

The automaton is broadcast, so its size is checked: items are dealt by hash
into blocks of at most ``MAX_BLOCK_BYTES`` of text on average; beyond one block the
texts are scanned once per block and a document's hits are united.
"""

from __future__ import annotations

import re
from typing import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEY, document_key, null_safe, written

MAX_BLOCK_BYTES = 2 << 20

#: A-Z to lower case; every byte that is no word byte to a space.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
ORIGINAL_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
RESULT = "n_words long, n_hit long, hits array<struct<first:long,last:long>>, " \
         "spans array<struct<start:long,end:long>>, item_ids array<string>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


class Automaton:
    """All windows of the given (item_id, text) pairs."""

    def __init__(self, items: Iterable[tuple[str, str | None]], window: int):
        import ahocorasick

        self.letters: dict[bytes, str] = {}
        patterns: dict[str, set[str]] = {}
        for item, text in items:
            words = words_of(text)
            size = min(window, len(words))
            line = "".join(map(self.letter, words))
            for at in range(len(words) - size + 1 if size else 0):
                patterns.setdefault(line[at:at + size], set()).add(item)
        self.machine = ahocorasick.Automaton()
        for p, found in patterns.items():
            self.machine.add_word(p, (len(p), tuple(found)))
        self.empty = not patterns
        if patterns:
            self.machine.make_automaton()

    def letter(self, word: bytes) -> str:
        known = self.letters.get(word)
        if known is None:
            n = len(self.letters) + 1  # 0 stands for any other word
            known = self.letters[word] = chr(n if n < 0xD800 else n + 0x800)
        return known

    def scan(self, text: str | None) -> tuple:
        """n_words, n_hit, runs of hit words, their code points, item ids."""
        words = words_of(text)
        get = self.letters.get
        line = "".join([get(w, "\0") for w in words])
        if self.empty or not line.strip("\0"):
            return len(words), 0, [], [], []
        marks, items = np.zeros(len(words) + 1, np.int32), set()
        for last, (size, found) in self.machine.iter(line):
            marks[last - size + 1] += 1
            marks[last + 1] -= 1
            items.update(found)
        if not items:
            return len(words), 0, [], [], []
        inside = np.concatenate([[0], marks[:-1].cumsum() > 0, [0]]).astype(np.int8)
        turns = np.flatnonzero(np.diff(inside))
        runs = list(zip(turns[::2].tolist(), (turns[1::2] - 1).tolist()))
        at = [m.span() for m in ORIGINAL_WORD.finditer(text)]
        spans = [(at[a][0], at[b][1]) for a, b in runs]
        return len(words), sum(b - a + 1 for a, b in runs), runs, spans, sorted(items)


def scan_column(spark: SparkSession, text: Column, items: list[tuple[str, str | None]], window: int) -> Column:
    block = spark.sparkContext.broadcast(items)

    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = Automaton(block.value, window)
        for texts in batches:
            yield pd.DataFrame([machine.scan(t) for t in texts],
                               columns=["n_words", "n_hit", "hits", "spans", "item_ids"])

    return scan(F.coalesce(text, F.lit("")))


def unite(found: pd.Series) -> pd.Series:
    """Overlapping or touching runs as one each."""
    out = []
    for runs in found:
        merged: list[list[int]] = []
        for a, b in sorted((int(r["first"]), int(r["last"])) for r in runs):
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out.append([{"first": a, "last": b} for a, b in merged])
    return pd.Series(out)


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  max_block_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """``docs`` with one struct column ``_scan``: n_words, n_hit (words inside an
    occurrence of a window), hits (runs of word numbers), spans (their code points,
    end exclusive), item_ids (strings, sorted).

    Null texts have no words; null items give no window, a null item_id reads
    ``null``; rows pass one to one, repeated ones too; no items or no rows give no
    hits.  Any column but ``_scan`` and those starting with ``_r_`` may be present."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
                             F.col(item_text).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-total // max_block_bytes))
    if blocks == 1:
        one = [tuple(r) for r in items.collect()]  # at most max_block_bytes
        return docs.withColumn("_scan", scan_column(spark, F.col(text), one, window))
    parts = None
    dealt = written(spark, items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks))), "items")
    keyed = docs.select(*document_key(doc_id, text), F.col(text).alias("text"))
    for b in range(blocks):
        block = [(r["item"], r["text"]) for r in dealt.where(F.col("block") == b).collect()]  # one block
        part = written(spark, keyed.withColumn("s", scan_column(spark, F.col("text"), block, window))
                       .where("s.n_hit > 0").select(*KEY, "s.hits", "s.item_ids").dropDuplicates(KEY), "hits")
        part = part.withColumn("at", F.lit(b))
        parts = part if parts is None else parts.unionByName(part)
    union = F.pandas_udf(unite, "array<struct<first:long,last:long>>")
    merged = parts.groupBy(*KEY).agg(
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    merged = merged.select(*KEY, F.struct(union("hits").alias("hits"), "item_ids").alias("__m"))
    back = docs.withColumns(dict(zip(KEY, document_key(doc_id, text))))
    joined = null_safe(back, merged, KEY, "left")

    @F.pandas_udf(RESULT)
    def place(texts: pd.Series, m: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for t, hits, ids in zip(texts, m["hits"], m["item_ids"]):
            runs = [] if hits is None else [(int(r["first"]), int(r["last"])) for r in hits]
            at = [x.span() for x in ORIGINAL_WORD.finditer(t)] if runs else []
            rows.append((len(words_of(t)), sum(b - a + 1 for a, b in runs), runs,
                         [(at[a][0], at[b][1]) for a, b in runs], [] if ids is None else list(ids)))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "hits", "spans", "item_ids"])

    return joined.withColumn("_scan", place(F.coalesce(F.col(text), F.lit("")), F.col("__m"))).drop("__m", *KEY)
