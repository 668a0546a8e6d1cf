import math
from collections import defaultdict

import pytest

from linedocs.llm import mixing
from pyspark.sql import functions as F


def corpus(spark, sizes):
    rows = [(f"{s}", i, "w " * (1 + (i * 7 + len(s)) % 13)) for s, n in sizes.items() for i in range(n)]
    rows = [(k, s, t + f"{k}") for k, (s, _, t) in enumerate(rows)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string")


def shares(rows):
    tokens = defaultdict(int)
    for _, s, t in rows:
        tokens[s] += len(t.split())
    total = sum(tokens.values())
    return tokens, {s: n / total for s, n in tokens.items()}


def weights_at(p, a):
    z = sum(x ** a for x in p.values())
    return {s: x ** a / z for s, x in p.items()}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values())


def brute_exponent(p, mix):
    low = next((1 - a / 20000 for a in range(20001) if entropy(weights_at(p, 1 - a / 20000)) >= mix.entropy * math.log(len(p)) - 1e-12), 0.0)
    limit = next(a / 20000 for a in range(20001) if (min(p.values()) / max(p.values())) ** (a / 20000 - 1) <= mix.max_epochs)
    return max(low, limit)


@pytest.mark.parametrize("mix", [mixing.Mixture(block_tokens=300), mixing.Mixture(entropy=0.6, block_tokens=300),
                                 mixing.Mixture(entropy=1.0, max_epochs=1.7, block_tokens=1000)])
def test_weights_and_places_as_brute_force(spark, mix):
    rows, df = corpus(spark, {"big": 400, "mid": 90, "small": 25, "tiny": 9})
    tokens, p = shares(rows)
    a = brute_exponent(p, mix)
    placed = mixing.placements(spark, df, mix).collect()
    got = {r["source"]: r["weight"] for r in placed}
    assert all(abs(got[s] - w) < 2e-4 for s, w in weights_at(p, a).items())
    # every document is used, the largest source once, the others as often as its weight says
    budget = max(tokens[s] / got[s] for s in tokens)
    by_source = defaultdict(list)
    for r in placed:
        by_source[r["source"]].append(r)
    for s, found in by_source.items():
        epochs = got[s] * budget / tokens[s]
        assert epochs <= mix.max_epochs + 1e-3
        by_epoch = defaultdict(list)
        for r in found:
            by_epoch[r["epoch"]].append(r)
        assert sorted(by_epoch) == list(range(math.ceil(epochs - 1e-9)))
        for e, some in by_epoch.items():
            some.sort(key=lambda r: r["place"])
            at = e * tokens[s]
            for r in some:  # places are running sums, none beyond the budget
                assert r["place"] == at and at < epochs * tokens[s] + 1e-6
                assert r["block"] == int(at // (got[s] * mix.block_tokens))
                at += r["n_tokens"]
            whole = e + 1 <= epochs + 1e-9
            assert len(some) == sum(1 for _, x, _ in rows if x == s) if whole else at >= epochs * tokens[s] - 1e-6
        orders = [[r["__id"] for r in by_epoch[e]] for e in sorted(by_epoch)]
        assert len(orders) < 2 or len(orders[0]) < 8 or orders[0] != orders[1]
    assert len(by_source["big"]) == 400


def test_given_budget(spark):
    rows, df = corpus(spark, {"big": 400, "mid": 90})
    tokens, _ = shares(rows)
    placed = mixing.placements(spark, df, mixing.Mixture(budget=sum(tokens.values()) / 2, block_tokens=100))
    assert abs(placed.agg(F.sum("n_tokens")).first()[0] - sum(tokens.values()) / 2) < 40


def test_rows(spark, odd_docs):
    out = mixing.mixed(spark, odd_docs, mixing.Mixture(block_tokens=10))
    assert out.count() == odd_docs.count()
    assert out.columns == [c for c in odd_docs.columns if c not in ("weight", "copies")] + ["weight", "copies", "blocks"]
    assert all(r["copies"] == len(r["blocks"]) >= 1 for r in out.collect())
    assert mixing.mixed(spark, odd_docs.where("false")).count() == 0
    empty = odd_docs.where("doc_id in (2, 3, 4)")
    assert {(r["weight"], r["copies"]) for r in mixing.mixed(spark, empty).collect()} == {(0.0, 1)}


def test_a_budget_does_not_break_the_limit(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "ab"[i % 5 == 0]) for i in range(100)], "doc_id long, text string, source string")
    mix = mixing.Mixture(budget=10_000, max_epochs=2.0)
    placed = mixing.placements(spark, docs, mix)
    per_doc = placed.groupBy("__id").count()
    assert per_doc.where("count <> 2").count() == 0 and per_doc.count() == 100
    tokens = docs.selectExpr("concat('=', source) AS s", "10L AS tokens")
    plan = {r["s"]: r for r in mixing.weights(spark, tokens, mix).collect()}
    assert all(r["epochs"] == 2.0 for r in plan.values())
    assert abs(sum(r["lacking"] for r in plan.values()) - (10_000 - 2 * 1000)) < 1e-3
    small = mixing.weights(spark, tokens, mixing.Mixture(budget=500)).collect()
    assert all(r["lacking"] == 0 for r in small) and abs(sum(r["epochs"] * r["tokens"] for r in small) - 500) < 1e-3
