import random
import re

import pytest

from linedocs.llm import linededup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, least):
    """(doc_id, text) with distinct ids: runs named by their lines."""
    runs, lines = {}, {}
    for d, text in docs:
        all_lines = (text or "").split("\n")
        seq = [(i, x, len(WORD.findall(x))) for i, x in enumerate(all_lines) if WORD.search(x)]
        lines[d] = all_lines, seq
        found = set()
        for i in range(len(seq)):
            for step in (1, -1):
                j, words = i, 0
                while 0 <= j < len(seq):
                    words += seq[j][2]
                    if words >= least:
                        found.add((min(i, j), max(i, j)))
                        break
                    j += step
        for a, b in found:
            runs.setdefault(tuple(x for _, x, _ in seq[a:b + 1]), []).append((d, a))
    gone = {d: set() for d, _ in docs}
    for name, places in runs.items():
        first = min(places)
        for d, a in places:
            if d != first[0] or a >= first[1] + len(name):
                gone[d] |= set(range(a, a + len(name)))
    out = {}
    for d, text in docs:
        all_lines, seq = lines[d]
        dead = set()
        for s in gone[d]:
            dead.add(seq[s][0])
            if s + 1 in gone[d]:
                dead |= set(range(seq[s][0], seq[s + 1][0]))
        out[d] = text if not dead else "\n".join(x for i, x in enumerate(all_lines) if i not in dead)
    return out


@pytest.mark.parametrize("seed,least", [(1, 4), (2, 6), (3, 9)])
def test_random_corpora_as_brute_force(spark, seed, least):
    rng = random.Random(seed)
    pool = ["a", "b b", "c c c", "", "  ", "d d d d d", "e e e e e e e e e e"]
    passage = [rng.choice(pool) for _ in range(8)]
    docs = []
    for d in range(60):
        body = [rng.choice(pool) for _ in range(rng.randint(0, 14))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(body))
            body[at:at] = passage[rng.randint(0, 3):]
        docs.append((d, "\n".join(x if rng.random() < 0.8 else f"u{rng.random()}" for x in body)))
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(
        spark, spark.createDataFrame(docs, "doc_id long, text string"), min_words=least).collect()}
    assert got == brute(docs, least)


def test_passage_of_several_lines(spark):
    passage = "one two three four five six seven eight nine ten\n" * 5 + "the end of the passage\n"
    docs = [(i, f"head {i} is its own line\n{passage}tail {i}") for i in range(40)] + [(99, "clean text\nof its own")]
    out = {r["doc_id"]: r for r in linededup.dedup_lines(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out[0]["text"] == docs[0][1] and out[99]["text"] == docs[-1][1]
    assert all(out[i]["text"] == f"head {i} is its own line\ntail {i}" for i in range(1, 40))


def test_common_line_in_slices(spark, monkeypatch):
    monkeypatch.setattr(linededup, "SLICE_BITS", 2)
    docs = [(i, "\n".join(["common line here"] * 2 + [f"pair {i // 2} of this"] + ["common line here"])) for i in range(80)]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(
        spark, spark.createDataFrame(docs, "doc_id long, text string"), min_words=7).collect()}
    assert got == brute(docs, 7)


def test_rows(spark, odd_docs):
    out = linededup.dedup_lines(spark, odd_docs, min_words=3)
    assert out.columns == [*odd_docs.columns, "_gone"] and out.count() == odd_docs.count()
    texts = {(r["doc_id"], r["source"]): r["text"] for r in out.collect()}
    assert texts[(5, "s1")] and texts[(6, "s3")] == "" and texts[(2, "s2")] is None and texts[(3, "s2")] == ""
    assert [r["text"] for r in out.where("doc_id = 1 and source = 's1'").collect()] == ["a b c d"] * 2
    assert linededup.dedup_lines(spark, odd_docs.where("false")).count() == 0
