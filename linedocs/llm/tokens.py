"""Token counts of a byte-pair vocabulary, without emitting identifiers.

Per word: the symbols form a linked list, the adjacent pairs that have a rank
a heap.  The pair of lowest rank (leftmost first) is popped and merged, its
neighbours' new pairs are pushed, until the heap is empty.  The count is the
initial symbols minus the merges, O(n log n) for a word of n symbols.

The vocabulary file is read once on the driver; what is broadcast is its merge
list, whose size is that of the file and does not grow with the data.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words remembered per worker, and the longest word worth remembering.
CACHE_WORDS, CACHE_BYTES = 400_000, 64
MAX_VOCABULARY_BYTES = 64 << 20


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in kept:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


def load_vocabulary(path: str) -> dict:
    """What counting needs of a ``tokenizers`` JSON file with byte-level symbols."""
    with open(path, "rb") as f:
        raw = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(raw) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: larger than {MAX_VOCABULARY_BYTES} bytes")
    j = json.loads(raw)
    model, steps = j["model"], [n["type"] for n in (j["normalizer"] or {}).get("normalizers", [])]
    split = next(p for p in j["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed":
        raise ValueError(f"{path}: not a vocabulary of the supported kind")
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    return {"merges": merges, "suffix": model["end_of_word_suffix"] or "", "pattern": split["pattern"]["Regex"],
            "specials": [t["content"] for t in j["added_tokens"]]}


def merged_length(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left after all merges."""
    n = len(symbols)
    if n < 2:
        return n
    symbols = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i] if symbols[i] else n
        # stale: the pair that was pushed has changed since
        if j >= n or ranks.get((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = ""
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i))
        h = before[i]
        if h >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return n - merges


class Counter:
    """Counts tokens of texts.  Words are separated by ASCII white space first:
    no token and no normalisation step reaches across it, and most words
    repeat, so a bounded memory of words answers most of them."""

    def __init__(self, vocabulary: dict):
        import regex

        self.ranks = {}
        for r, m in enumerate(vocabulary["merges"]):
            self.ranks.setdefault(m, r)
        self.suffix, self.alphabet = vocabulary["suffix"], byte_alphabet()
        self.pattern = regex.compile(vocabulary["pattern"])
        self.specials = vocabulary["specials"]
        self.special = regex.compile("|".join(map(regex.escape, self.specials)) or r"(?!)")
        self.known: dict[bytes, int] = {}

    def piece(self, piece: str) -> int:
        symbols = [self.alphabet[b] for b in piece.encode()]
        symbols[-1] += self.suffix
        return merged_length(symbols, self.ranks)

    def plain(self, text: str) -> int:
        # lower-casing is character by character: no word-final form of sigma
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return sum(map(self.piece, self.pattern.findall(text)))

    def word(self, word: bytes) -> int:
        text = word.decode()
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for w in text.encode().split():
            n = known.get(w)
            if n is None:
                n = self.word(w)
                if len(w) <= CACHE_BYTES:
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                    known[w] = n
            total += n
        return total


def token_count(spark: SparkSession, text: Column, path: str) -> Column:
    """Tokens of ``text`` under the vocabulary at ``path`` (null or empty: 0)."""
    vocabulary = spark.sparkContext.broadcast(load_vocabulary(path))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(vocabulary.value)
        for texts in batches:
            yield pd.Series([counter.text(t) for t in texts], dtype="int64")

    return count(F.coalesce(text, F.lit("")))


def count_tokens(spark: SparkSession, df: DataFrame, path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """``df`` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    A null text counts as empty (0, 0, false); columns of these names are
    replaced; rows, repeated ones too, pass one to one; an empty table stays
    empty; a text of any length is counted whole."""
    return (df.withColumns({"n_bytes": F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long"),
                            "n_tokens": token_count(spark, F.col(text), path)})
            .withColumn("over_limit", F.col("n_tokens") > limit))
