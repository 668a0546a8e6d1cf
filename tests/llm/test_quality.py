import math
import random
import re

import pytest

from linedocs.llm import quality

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = SPACE.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if SPACE.search(x) and x in lines[:i])
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


def test_counts_as_brute_force():
    rng = random.Random(6)
    parts = ["a", "b", "cc", "A#", "é|", "\n", " ", "\t", "\x0b", "\x1c", " ", "x<", "a b c ", "\n\n", "😀"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 40)))
        assert quality.counts_of(text)[:5] == brute_counts(text), repr(text)


@pytest.mark.parametrize("k,n", [(0, 50), (3, 50), (49, 50), (50, 50), (0, 1), (7, 3000)])
def test_exact_binomial_bounds(k, n):
    def at_most(k, p):
        return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))

    upper = quality.binomial_bound(k, n, 0.05, True)
    assert upper == 1.0 if k == n else abs(at_most(k, upper) - 0.05) < 1e-6
    lower = quality.binomial_bound(k, n, 0.05, False)
    assert lower == 0.0 if k == 0 else abs(1 - at_most(k - 1, lower) - 0.05) < 1e-6


def clean(rng, words=80):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(words)) + "."


def labelled_corpus(n):
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(n):
        kind = rng.random()
        text = clean(rng)
        quality_label, toxic = 1, 0
        if kind < 0.15:
            text, quality_label = " ".join(w + "###" for w in text.split()), 0
        elif kind < 0.3:
            text, toxic = text + " zounds " + clean(rng, 9), 1
        docs.append((i, text, "en" if i % 20 else None))
        if i % 3:
            labels.append((i, quality_label, toxic))
    return docs, labels


def test_thresholds_catch_junk_and_keep_clean(spark):
    docs, labels = labelled_corpus(6000)
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(6)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality.judge(spark, d, lab).collect()}
    again = {r["doc_id"]: r["kept"] for r in quality.judge(spark, d, lab, again=True).collect()}
    assert len(out) == 6000 and again == {i: r["kept"] for i, r in out.items()}
    rejected_clean = junk = caught = 0
    for i, text, lang in docs:
        assert not out[i]["base_failed"]
        bad = "###" in text or "zounds" in text
        rejected_clean += not bad and not out[i]["kept"]
        if lang and bad:
            junk += 1
            caught += not out[i]["kept"]
        if lang is None:  # too few labels in this stratum for any guarantee
            assert out[i]["kept"]
    assert rejected_clean <= 0.01 * 6000 and caught >= 0.97 * junk


def test_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (None, 1, 0), (5, None, 0), (7, 1, None)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.where("false")):
        out = quality.judge(spark, odd_docs.drop("kept"), lab)
        assert out.count() == odd_docs.count()
        for r in out.collect():
            n, *_, repeated = counts = brute_counts(r["text"]) if len(r["text"] or "") < 1000 else quality.counts_of(r["text"])[:5]
            assert tuple(r["__f"][c] for c in quality.COUNTS) == counts
            assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n) and r["kept"] <= (not r["base_failed"])
        assert quality.judge(spark, odd_docs.drop("kept").where("false"), lab).count() == 0


def test_small_languages_share_a_cutoff(spark):
    """Each of three languages has too few labels for a bound of its own; together they have enough."""
    docs, labels = labelled_corpus(6000)
    d = spark.createDataFrame([(i, t, ("de", "fr", "es")[i % 7 % 3] if i % 2 else "en") for i, t, _ in docs], "doc_id long, text string, lang string")
    lab = spark.createDataFrame([x for x in labels if x[0] % 2], "doc_id long, quality int, toxic int")
    out = quality.judge(spark, d, lab).where("lang <> 'en'").collect()
    junk = [r for r in out if "###" in r["text"]]
    assert len(junk) > 300 and sum(not r["kept"] for r in junk) >= 0.97 * len(junk)
    assert sum(not r["kept"] for r in out if "###" not in r["text"] and "zounds" not in r["text"]) <= 0.01 * len(out)


def test_words_of_each_language_and_documents_that_the_base_rules_reject(spark):
    """Insults of four languages, few of them in the small ones, and good labels on texts that are too short anyway."""
    rng = random.Random(12)
    insults = {"en": "zounds", "de": "réêou", "fr": "achkeiter", "es": "漢字"}
    docs, labels = [], []
    for i in range(7000):
        lang = rng.choice(["en"] * 7 + ["de", "fr", "es"])
        toxic = rng.random() < 0.1
        short = not toxic and rng.random() < 0.05
        text = clean(rng, 20 if short else 80) + (f" {insults[lang].upper() if lang == 'en' else insults[lang]}, {clean(rng, 5)}" if toxic else "")
        docs.append((i, text, lang))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)
    out = quality.judge(spark, d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    for lang, word in insults.items():
        own = [r for r in out if r["lang"] == lang]
        toxic = [r for r in own if word in r["text"].lower()]
        clean_ones = [r for r in own if word not in r["text"].lower() and not r["base_failed"]]
        assert len(toxic) > 40 and sum(not r["kept"] for r in toxic) >= 0.97 * len(toxic), lang
        assert sum(not r["kept"] for r in clean_ones) <= 0.01 * len(clean_ones) + 2, lang
    assert sum(r["base_failed"] for r in out) > 200


@pytest.mark.parametrize("k,n,p", [(0, 5, .2), (3, 5, .2), (5, 5, .3), (18, 18, .1), (40, 90, .4), (3, 2, .5), (1, 3, 0.0), (2, 3, 1.0)])
def test_exact_binomial_tails(k, n, p):
    assert abs(quality.binomial_tail(k, n, p) - sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k, n + 1))) < 1e-12


def test_strata_that_stand_alone():
    assert quality.carrying({5000: 3, 100: 1}, 0.05, 0.01) == 5000 and quality.carrying({299: 1}, 0.05, 0.01) == 299
    assert quality.carrying({437: 4}, 0.05, 0.01) == 437 and quality.carrying({435: 4}, 0.05, 0.01) > 435
