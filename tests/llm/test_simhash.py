import numpy as np
import pandas as pd
import pytest
import xxhash

from linedocs.llm import simhash


def brute_fingerprint(text, k=3):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps, distance):
    fps = list(fps)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", ["", None, "One", "One two", "a b c", "a b c a b c a b c", "Ä ö\tX\x0bY\nZ  q", "w " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}x{i % 31}" for i in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_every_near_pair_shares_a_bucket_and_a_chain(distance):
    rng = np.random.default_rng(distance)
    masks = [np.uint64(m) for m in simhash.first_masks(distance)]
    for _ in range(2000):
        bits = rng.choice(64, rng.integers(0, distance + 1), replace=False)
        x = np.uint64(sum(1 << int(b) for b in bits))
        shared = [m for m in masks if not x & m]
        assert shared and simhash.chains_kept(np.array([x]), distance).all()
        assert any(not x & np.uint64(f) for f in simhash.finer_masks(int(shared[0]), distance))


@pytest.mark.parametrize("bucket", [4096, 24])
def test_classes_as_brute_force(spark, bucket):
    rng = np.random.default_rng(5)
    fps = [0]
    for b in rng.integers(0, 1 << 63, 30):
        fps.append(int(b))
        for _ in range(6):
            fps.append(fps[-1] ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 4), replace=False)))
    # one crowded neighbourhood: the refinement has work
    fps += [int(x) for x in rng.integers(0, 1 << 10, 80)] + [int(x) << 20 for x in rng.integers(0, 1 << 10, 80)]
    fps = sorted(set(fps))
    df = spark.createDataFrame(pd.DataFrame({"doc_id": range(len(fps)), "fp": np.array(fps, np.uint64).view(np.int64)}))
    got = simhash.classes(spark, df, 2, bucket).toPandas()
    mine = {int(f) % (1 << 64): int(c) for f, c in zip(got["fp"], got["component_id"])}
    roots = brute_classes(fps, 2)
    least = {}
    for i, r in enumerate(roots):
        least.setdefault(r, i)
    assert mine == {f: least[r] for f, r in zip(fps, roots)}


def test_rows(spark, odd_docs):
    rows = simhash.near_duplicates(spark, odd_docs).collect()
    assert len(rows) == odd_docs.count()
    expected = sorted((f"{brute_fingerprint(r['text']):016x}", r["doc_id"] or -1) for r in odd_docs.collect())
    assert sorted((r["fingerprint"], r["doc_id"] or -1) for r in rows) == expected
    zero = {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16}
    assert zero == {2}
    assert simhash.near_duplicates(spark, odd_docs.where("false")).count() == 0


def test_keep_one(spark, odd_docs):
    kept = simhash.keep_one(spark, odd_docs)
    assert kept.columns == odd_docs.columns
    rows = simhash.near_duplicates(spark, odd_docs).collect()
    got = sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect())
    # a class of null ids alone keeps one row, every other its smallest id
    assert got == sorted({(r["doc_id"] or -1, r["text"] or "") for r in odd_docs.collect()}
                         - {(-1, ""), (3, ""), (4, " \t\n "), (6, odd_docs.where("doc_id = 6").first()["text"])})
    assert {r["component_id"] for r in rows} == {1, 2, 5, 7, 8, None}
    assert simhash.keep_one(spark, odd_docs.where("false")).count() == 0
