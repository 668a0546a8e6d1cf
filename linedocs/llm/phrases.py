"""Phrase collocations from counting quotient filters over packed word-id n-grams.

Texts become chunks of local word numbers with a dictionary each; only words that are frequent enough
to be in a candidate get a corpus-wide id.  An n-gram is its ids packed into one number, permuted
invertibly and cut into a quotient (which filter, which slot) and the full remainder, so that a
filter loses nothing: its keys are read back by the inverse permutation.  Tasks fill filters, and
the sorted filters of a shard are merged.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import count
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import placed, written

#: Separators of pieces, all made line feeds; a piece's words are then what white space parts.
PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
#: Word occurrences per chunk (a piece is never cut).
CHUNK = 1 << 19
#: n-grams that a task holds before it hands its filters on, and keys per shard to aim at.
HELD = 1 << 21
#: Ids are packed into two halves of 63 bits at most.
MAX_ID_BITS = 42


# --- packing and permuting ------------------------------------------------------

def half_bits(b: int) -> int:
    """Bits of each half of three packed ids of ``b`` bits."""
    return (3 * b + 1) // 2


def pack(ids: tuple[np.ndarray, np.ndarray, np.ndarray], b: int) -> tuple[np.ndarray, np.ndarray]:
    h = half_bits(b)
    one, two, three = (x.astype(np.uint64) for x in ids)
    cut = np.uint64(h - b)
    hi = (one << np.uint64(2 * b - h)) | (two >> cut)
    lo = ((two & np.uint64((1 << (h - b)) - 1)) << np.uint64(b)) | three
    return hi, lo


def unpack(hi: np.ndarray, lo: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = half_bits(b)
    one = hi >> np.uint64(2 * b - h)
    two = ((hi & np.uint64((1 << (2 * b - h)) - 1)) << np.uint64(h - b)) | (lo >> np.uint64(b))
    return one, two, lo & np.uint64((1 << b) - 1)


ROUNDS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray, k: int, mask: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        y = (x + np.uint64(k & 0xFFFFFFFF)) * np.uint64(k)
        y ^= y >> np.uint64(29)
        y *= np.uint64(0xBF58476D1CE4E5B9)
    return (y >> np.uint64(1)) & mask


def permute(hi: np.ndarray, lo: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    """A bijection of pairs of ``h``-bit halves (a Feistel network)."""
    mask = np.uint64((1 << h) - 1)
    for k in ROUNDS:
        hi, lo = lo, hi ^ _mixed(lo, k, mask)
    return hi, lo


def restore(hi: np.ndarray, lo: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << h) - 1)
    for k in reversed(ROUNDS):
        hi, lo = lo ^ _mixed(hi, k, mask), hi
    return hi, lo


# --- the filter -----------------------------------------------------------------

def tally(hi: np.ndarray, lo: np.ndarray, n: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, with their summed counts."""
    if not len(hi):
        return hi, lo, n
    if 2 * h <= 64:
        order = np.argsort((hi << np.uint64(h)) | lo)
    else:
        order = np.lexsort((lo, hi))
    hi, lo = hi[order], lo[order]
    first = np.flatnonzero(np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))))
    return hi[first], lo[first], np.add.reduceat(n[order], first)


def _narrow(values: np.ndarray, bits: int) -> bytes:
    width = max(1, (bits + 7) // 8)
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _wide(data: bytes, bits: int, n: int) -> np.ndarray:
    width = max(1, (bits + 7) // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(n, width)
    return out.view("<u8").reshape(n)


class QuotientFilter:
    """A counting quotient filter of the permuted keys of one shard: those whose first ``shard_bits`` bits
    are ``shard``.

    In bytes, the next bits of a key are its quotient: a bit vector has, slot by slot, a one per key and a zero
    at the end of the slot's run.  The rest is the remainder, stored whole; counts take a byte, larger ones
    an entry in a list.  It has about as many slots as keys, so filters of unlike size differ in their
    quotient's width, but all hold their keys in the same order and merge by it."""

    def __init__(self, shard: int, shard_bits: int, h: int, hi: np.ndarray, lo: np.ndarray, n: np.ndarray):
        self.shard, self.shard_bits, self.h, self.hi, self.lo, self.n = shard, shard_bits, h, hi, lo, n

    @property
    def rest(self) -> int:
        """Bits of the first half behind the quotient."""
        return max(0, self.h - self.shard_bits - max(1, len(self.hi)).bit_length())

    def to_bytes(self) -> bytes:
        keys, rest = len(self.hi), self.rest
        slots = 1 << (self.h - self.shard_bits - rest)
        slot = ((self.hi >> np.uint64(rest)) & np.uint64(slots - 1)).astype(np.int64)
        runs = np.zeros(keys + slots, np.uint8)
        runs[slot + np.arange(keys)] = 1  # a zero closes each slot before this key's
        large = np.flatnonzero(self.n >= 255)
        small = np.minimum(self.n, 255).astype(np.uint8)
        return b"".join([np.array([keys, len(large)], "<i8").tobytes(), np.packbits(runs).tobytes(),
                         _narrow(self.hi & np.uint64((1 << rest) - 1), rest), _narrow(self.lo, self.h), small.tobytes(),
                         self.n[large].astype("<i8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes, shard: int, shard_bits: int, h: int) -> "QuotientFilter":
        keys, large = (int(x) for x in np.frombuffer(data, "<i8", 2))
        self = cls(shard, shard_bits, h, np.zeros(keys, np.uint64), np.zeros(keys, np.uint64), np.zeros(keys, np.int64))
        rest, at = self.rest, 16
        slots = 1 << (h - shard_bits - rest)

        def take(size: int) -> bytes:
            nonlocal at
            at += size
            return data[at - size:at]

        ones = np.flatnonzero(np.unpackbits(np.frombuffer(take((keys + slots + 7) // 8), np.uint8))[:keys + slots])
        slot = (ones - np.arange(keys)).astype(np.uint64)
        prefix = np.uint64(shard << (h - shard_bits)) if shard_bits else np.uint64(0)
        high = _wide(take(keys * max(1, (rest + 7) // 8)), rest, keys)
        self.hi = prefix | (slot << np.uint64(rest)) | high
        self.lo = _wide(take(keys * max(1, (h + 7) // 8)), h, keys)
        self.n = np.frombuffer(take(keys), np.uint8).astype(np.int64)
        self.n[self.n == 255] = np.frombuffer(take(8 * large), "<i8")
        return self

    @classmethod
    def merged(cls, filters: list["QuotientFilter"]) -> "QuotientFilter":
        f = filters[0]
        parts = [np.concatenate(x) for x in zip(*[(g.hi, g.lo, g.n) for g in filters])]
        return cls(f.shard, f.shard_bits, f.h, *tally(*parts, f.h))


def filters_of(hi: np.ndarray, lo: np.ndarray, b: int, shard_bits: int) -> Iterator[QuotientFilter]:
    """One filter per shard of these packed n-grams (repeats are counted)."""
    h = half_bits(b)
    hi, lo, n = tally(*permute(hi, lo, h), np.ones(len(hi), np.int64), h)
    shard = (hi >> np.uint64(h - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(hi), np.int64)
    ends = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(hi)]
    for i, j in zip(ends, ends[1:]):
        if j > i:
            yield QuotientFilter(int(shard[i]), shard_bits, h, hi[i:j], lo[i:j], n[i:j])


# --- Spark ------------------------------------------------------------------------

CHUNKS = "lang string, words array<string>, counts array<long>, codes binary"


def chunked(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """Texts as chunks of one language: distinct words, their counts, and the text as numbers of
    these words (from 1), with a zero at the end of each piece, byte plane by byte plane."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary()]

        def flush() -> Iterator[pa.RecordBatch]:
            for name, (number, codes) in held.items():
                if not number:
                    continue
                codes = np.array(codes, np.uint32)
                counts = np.bincount(codes, minlength=len(number) + 1)[1:]
                planes = codes.view(np.uint8).reshape(-1, 4).T.tobytes()  # the high bytes are mostly zero, and compress
                row = [pa.array([v], t) for v, t in zip((name, list(number), counts, planes), kinds)]
                row[1] = row[1].cast(pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(row, ["lang", "words", "counts", "codes"])

        def fresh():
            return defaultdict(count(1).__next__), []

        held, size = defaultdict(fresh), 0
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                name = name.as_py()
                for piece in data.as_buffer().to_pybytes().lower().translate(PIECES).split(b"\n"):
                    words = piece.split()
                    if words:
                        number, codes = held[name]
                        codes.extend(map(number.__getitem__, words))
                        codes.append(0)
                        size += len(words)
                        if size >= CHUNK:
                            yield from flush()
                            held, size = defaultdict(fresh), 0
        yield from flush()

    rows = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(encode, CHUNKS)


def counted_ngrams(spark: SparkSession, chunks: DataFrame, words: DataFrame, vocabulary: int, min_count: int) -> DataFrame:
    """(id1, id2, id3, a) of the n-grams of 2 and 3 words (id3 0: two) that ``words`` holds all of and that occur ``min_count`` times."""
    b = max(1, vocabulary.bit_length())
    if b > MAX_ID_BITS:
        raise ValueError(f"{vocabulary} words: their ids do not fit {MAX_ID_BITS} bits")
    known = chunks.select("chunk", "lang", F.posexplode("words").alias("pos", "word")).join(words.select("lang", "word", "id"), ["lang", "word"])
    known = known.groupBy("chunk").agg(F.collect_list("pos").alias("pos"), F.collect_list("id").alias("ids"), F.count("*").alias("n"))
    occurrences = words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    shard_bits = min(half_bits(b), max(0, math.ceil(math.log2(max(1, 2 * occurrences / HELD)))))
    pairs = chunks.select("chunk", F.size("words").alias("size"), "codes").join(known, "chunk").select("size", "pos", "ids", "codes")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            made = list(filters_of(np.concatenate([p[0] for p in held]), np.concatenate([p[1] for p in held]), b, shard_bits))
            return pa.RecordBatch.from_arrays([pa.array([f.shard for f in made], pa.int32()),
                                               pa.array([f.to_bytes() for f in made], pa.binary())], ["shard", "filter"])

        held, n = [], 0
        for batch in batches:
            for i in range(len(batch)):
                size, pos, ids, codes = (batch.column(k)[i] for k in range(4))
                id_of = np.zeros(size.as_py() + 1, np.uint64)
                id_of[pos.values.to_numpy(zero_copy_only=False) + 1] = ids.values.to_numpy(zero_copy_only=False)
                planes = np.frombuffer(codes.as_buffer(), np.uint8).reshape(4, -1)
                g = id_of[np.ascontiguousarray(planes.T).view(np.uint32).reshape(-1)]
                two = (g[:-1] > 0) & (g[1:] > 0)
                at = np.flatnonzero(two)
                three = np.flatnonzero(two[:-1] & two[1:])
                held.append(pack((g[at], g[at + 1], np.zeros(len(at), np.uint64)), b))
                held.append(pack((g[three], g[three + 1], g[three + 2]), b))
                n += len(at) + len(three)
                if n >= HELD:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(parts: list[QuotientFilter]) -> pa.RecordBatch:
            f = QuotientFilter.merged(parts)
            often = f.n >= min_count
            ids = unpack(*restore(f.hi[often], f.lo[often], f.h), b)
            return pa.RecordBatch.from_arrays([*[pa.array(x.astype(np.int64)) for x in ids], pa.array(f.n[often])], ["id1", "id2", "id3", "a"])

        shard, parts, new = None, [], 0
        for batch in batches:
            for s, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if s != shard and parts:
                    yield result(parts)
                    parts, new = [], 0
                shard = s
                parts.append(QuotientFilter.from_bytes(data.as_buffer().to_pybytes(), s, shard_bits, half_bits(b)))
                new += len(parts[-1].n)
                if len(parts) > 1 and new >= HELD + len(parts[0].n):  # merged as they grow, each key a few times in all
                    parts, new = [QuotientFilter.merged(parts)], 0
        if parts:
            yield result(parts)

    filters = pairs.mapInArrow(fill, "shard int, filter binary").repartition(1 << shard_bits, "shard")
    return filters.sortWithinPartitions("shard").mapInArrow(merge, "id1 long, id2 long, id3 long, a long")


def collocations(spark: SparkSession, docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = 10,
                 inside_percent: int = 50, top: int = 2000, scale: int = 1_000_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words of each language.

    Words and pieces are those of lower-cased (A-Z) texts, all counts are whole.  A phrase with ``min_count``
    occurrences is scored by its worst cut: floor(scale * a * a / (l * r)), ties by the shorter first part; it is dropped
    if a longer candidate holds it and has ``inside_percent`` of its occurrences.  Null texts are empty, a null language
    is ``und`` (as is that name); repeated rows count each; other columns are not looked at; an empty table gives no rows.

    A filter is split by the permuted key, so no n-gram or word is a hot shard; a word is one row per chunk
    when ids are looked up."""
    chunks = written(spark, chunked(docs, lang, text).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    counts = chunks.select("lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("c"))))
    all_words = written(spark, counts.groupBy("lang", "word").agg(F.sum("c").alias("f")), "word-counts")
    totals = all_words.groupBy("lang").agg(F.sum("f").alias("n"))
    words, vocabulary = placed(spark, all_words.where(F.col("f") >= min_count), "id", "words", first=1)
    grams = written(spark, counted_ngrams(spark, chunks, words, vocabulary, min_count), "ngrams")

    def word(k: int) -> DataFrame:
        return words.select(F.col("id").alias(f"id{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"))

    pairs, triples = grams.where("id3 = 0").drop("id3"), grams.where("id3 > 0")
    held = triples.select("id1", "id2", "a").unionByName(triples.select(F.col("id2").alias("id1"), F.col("id3").alias("id2"), "a"))
    held = held.groupBy("id1", "id2").agg(F.max("a").alias("longer"))
    first = words.select(F.col("id").alias("id1"), "lang", F.col("word").alias("w1"), F.col("f").alias("f1"))
    two = pairs.join(held, ["id1", "id2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a")))
    two = two.join(first, "id1").join(word(2), "id2").select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a",
                                                              F.array(cut(F.col("f1"), F.col("f2"), scale, 1)).alias("cuts"))
    front = pairs.withColumnRenamed("a", "f12")
    back = pairs.select(F.col("id1").alias("id2"), F.col("id2").alias("id3"), F.col("a").alias("f23"))
    three = triples.join(front, ["id1", "id2"]).join(back, ["id2", "id3"]).join(first, "id1").join(word(2), "id2").join(word(3), "id3")
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                         F.array(cut(F.col("f1"), F.col("f23"), scale, 1), cut(F.col("f12"), F.col("f3"), scale, 2)).alias("cuts"))
    worst = F.array_min("cuts")
    scored = written(spark, two.unionByName(three).select("lang", "phrase", "a", worst["l"].alias("l"), worst["r"].alias("r"), worst["score"].alias("score")), "phrases")
    # the best of a language are among the best of its parts, so that no task sorts a whole language
    parts = max(1, scored.count() // 100_000)
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*best))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def cut(l: F.Column, r: F.Column, scale: int, k: int) -> F.Column:
    """Score of one cut, exact: a, l and r may have 15 digits, their products do not overflow 38."""
    a = F.col("a").cast("decimal(15,0)")
    squared = F.lit(scale).cast("decimal(7,0)") * a * a
    return F.struct(F.call_function("div", squared, l.cast("decimal(18,0)") * r.cast("decimal(18,0)")).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))
