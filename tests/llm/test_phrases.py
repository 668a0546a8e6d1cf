import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linedocs.llm import phrases
from linedocs.llm.phrases import QuotientFilter, filters_of, half_bits, pack, permute, restore, unpack


def brute(rows, min_count, percent, top):
    by = {}
    for lang, text in rows:
        f = by.setdefault(lang or "und", Counter())
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            f.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, f in by.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        cand = {g: c for g, c in f.items() if len(g) > 1 and c >= min_count}
        best = []
        for g, a in cand.items():
            if any(len(t) > len(g) and g in (t[:2], t[1:]) and 100 * c >= percent * a for t, c in cand.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            best.append((-score, -a, " ".join(g).encode(), " ".join(g), f[g[:k]], f[g[k:]]))
        for rank, (s, a, _, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p, -a, left, right, n, -s))
    return sorted(out)


def random_rows(seed, docs=150):
    r = random.Random(seed)
    words = ["a", "B", "cé", "d", "of", "The", "x\x00", "ÀÉ", "😀", "i.e", "e"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "! ", "\xa0"]
    return [(r.choice(["en", "en", "de", None, "und"]), "".join(r.choice(words) + r.choice(gaps) for _ in range(r.randrange(80)))) for _ in range(docs)]


def collected(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed,min_count,percent,top", [(1, 10, 50, 2000), (2, 2, 90, 7), (3, 1, 101, 2000)])
def test_equals_brute_force(spark, seed, min_count, percent, top):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert collected(phrases.collocations(spark, df, min_count=min_count, inside_percent=percent, top=top)) == brute(rows, min_count, percent, top)


def test_small_chunks_and_many_shards(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 50)
    monkeypatch.setattr(phrases, "HELD", 64)
    rows = random_rows(4)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert collected(phrases.collocations(spark, df, min_count=3)) == brute(rows, 3, 50, 2000)


def test_odd_rows(spark, odd_docs):
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    assert collected(phrases.collocations(spark, odd_docs, min_count=2)) == brute(rows, 2, 50, 2000)
    assert phrases.collocations(spark, odd_docs.where("false")).collect() == []
    assert phrases.collocations(spark, odd_docs.withColumn("text", F.lit(None).cast("string"))).collect() == []


def test_scores_are_exact(spark):
    big = 10 ** 14 + 7
    rows = [(big - 3, big, big - 1), (10 ** 15 - 1, 10 ** 15 - 1, 10 ** 15 - 1), (10, 10 ** 15 - 1, 10 ** 15 - 2), (3, 7, 11)]
    df = spark.createDataFrame(rows, "a long, l long, r long").select("*", phrases.cut(F.col("l"), F.col("r"), 1_000_000, 1)["score"].alias("score"))
    assert [r["score"] for r in df.collect()] == [1_000_000 * a * a // (x * y) for a, x, y in rows]


@pytest.mark.parametrize("b", [1, 2, 7, 15, 21, 22, 31, 32, 33, 42])
def test_packing_and_permuting_lose_nothing(b):
    rng = np.random.default_rng(b)
    ids = tuple(rng.integers(0, 1 << b, 500, dtype=np.uint64) for _ in range(3))
    packed = pack(ids, b)
    h = half_bits(b)
    assert all(int(x.max()) < 1 << h for x in packed)
    moved = permute(*packed, h)
    assert all(int(x.max()) < 1 << h for x in moved)
    back = restore(*moved, h)
    assert all((x == y).all() for x, y in zip(back, packed))
    assert all((x == y).all() for x, y in zip(unpack(*back, b), ids))


@pytest.mark.parametrize("b,shard_bits", [(1, 0), (2, 3), (9, 0), (9, 4), (30, 2), (42, 9)])
def test_filters_round_trip_and_merge(b, shard_bits):
    rng = np.random.default_rng(b)
    want, shards = Counter(), {}
    for part in range(4):
        ids = tuple(rng.integers(0, min(1 << b, 40), 900, dtype=np.uint64) for _ in range(3))
        ids[2][: 600] = 1 if b else 0
        want.update(zip(*(x.tolist() for x in ids)))
        for f in filters_of(*pack(ids, b), b, shard_bits):
            again = QuotientFilter.from_bytes(f.to_bytes(), f.shard, shard_bits, f.h)
            assert all((x == y).all() for x, y in ((f.hi, again.hi), (f.lo, again.lo), (f.n, again.n)))
            shards.setdefault(f.shard, []).append(again)
    got = Counter()
    for fs in shards.values():
        f = QuotientFilter.merged(fs)
        assert len(set(zip(f.hi.tolist(), f.lo.tolist()))) == len(f.hi)
        got.update(dict(zip(zip(*(x.tolist() for x in unpack(*restore(f.hi, f.lo, f.h), b))), f.n.tolist())))
    assert got == want


def test_large_counts_keep_their_value():
    hi, lo = np.arange(5, dtype=np.uint64), np.zeros(5, np.uint64)
    f = QuotientFilter(0, 0, 40, hi, lo, np.array([1, 254, 255, 256, 1 << 50]))
    assert QuotientFilter.from_bytes(f.to_bytes(), 0, 0, 40).n.tolist() == [1, 254, 255, 256, 1 << 50]
