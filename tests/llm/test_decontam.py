import re

from linedocs.llm import decontam
from pyspark.sql import functions as F

RX = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return RX.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, k):
    w = words(text)
    hit, ids = set(), set()
    for item, t in items:
        iw = words(t)
        n = min(k, len(iw))
        for s in range(len(iw) - n + 1 if n else 0):
            for a in range(len(w) - n + 1):
                if w[a:a + n] == iw[s:s + n]:
                    hit |= set(range(a, a + n))
                    ids.add(item)
    return len(w), len(hit), sorted(ids)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog"), (2, "a b c d e f"), (10, "über naïve café"), (3, ""), (4, None),
         (5, "a b c d e f"), (None, "only null id here now")]
DOCS = ["THE quick, brown fox--jumps! over", "quick brown fox jumps over the lazy dog a b c d", "x a b c d e f a b c d e f", "ÜBER naïve café",
        "über naïve café", "", None, "only null id here now " * 3, "nothing", "a\nb\tc.d e_f"]


def check(rows, items, k):
    names = [(str(i) if i is not None else "null", t) for i, t in items]
    for r in rows:
        s = r["_scan"]
        assert (s["n_words"], s["n_hit"], s["item_ids"]) == brute(r["text"], names, k), r["text"]
        covered = [words(r["text"][x["start"]:x["end"]]) for x in s["spans"]]
        whole = words(r["text"])
        assert covered == [whole[x["first"]:x["last"] + 1] for x in s["hits"]]


def test_windows_as_brute_force(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(DOCS * 2)], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for k in (3, 5, 10):
        rows = decontam.decontaminate(spark, docs, bench, window=k).collect()
        assert len(rows) == 2 * len(DOCS)
        check(rows, ITEMS, k)


def test_blocks_give_the_same(spark, odd_docs):
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(DOCS * 2)], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    one = decontam.decontaminate(spark, docs, bench, window=4)
    many = decontam.decontaminate(spark, docs, bench, window=4, max_block_bytes=150)
    key = lambda r: (r["doc_id"], str(r["text"]))
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)
    check(many.collect(), ITEMS, 4)
    for size in (1 << 20, 100):
        out = decontam.decontaminate(spark, odd_docs, bench, max_block_bytes=size)
        assert out.count() == odd_docs.count() and set(odd_docs.columns) < set(out.columns)
        assert decontam.decontaminate(spark, odd_docs.where("false"), bench, max_block_bytes=size).count() == 0
    nothing = decontam.decontaminate(spark, odd_docs, bench.where("false"))
    assert nothing.agg(F.sum("_scan.n_hit")).first()[0] == 0
