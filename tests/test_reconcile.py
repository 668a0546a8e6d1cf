"""AGG6 by content: brute force over multisets of lines."""

import random
from collections import Counter

from pyspark.sql import functions as F

from linedocs.operators.reconcile import content_digest, differing_keys, reconcile_content

SCHEMA = "index string, path string, offset bigint, line string"
KEYS = ["index", "path"]


def brute(source, indexed):
    a, b = Counter(source), Counter(indexed)
    out = []
    for place in {x[:3] for x in (*a, *b)}:
        def key(x):
            return (x[3] is not None, x[3] or "")
        less = sorted((x for x in a if x[:3] == place and a[x] > b[x]), key=key)
        more = sorted((x for x in b if x[:3] == place and b[x] > a[x]), key=key)
        for i in range(max(len(less), len(more))):
            p, q = (less[i] if i < len(less) else None), (more[i] if i < len(more) else None)
            status = "altered" if p and q else "lost" if p else "doubled" if a[q] else "extra"
            out.append((*place, status, p[3] if p else q[3] if a[q] else None, q[3] if q else p[3] if b[p] else None,
                        a[p] if p else a[q], b[q] if q else b[p]))
    return sorted(out, key=str)


def found(spark, source, indexed):
    df = reconcile_content(spark.createDataFrame(source, SCHEMA), spark.createDataFrame(indexed, SCHEMA), KEYS)
    return sorted(map(tuple, df.collect()), key=str)


def test_random_damage(spark):
    r = random.Random(1)
    for seed in range(3):
        source = [(r.choice(["i", "j", None]), f"/p{r.randrange(6)}", o, r.choice(["", "a", "b", None, "é", "a b"])) for o in range(60)]
        source += r.sample(source, 5)
        indexed = []
        for x in source:
            k = r.random()
            indexed += [] if k < .07 else [x, x] if k < .14 else [(*x[:3], r.choice(["b", "new", None]))] if k < .2 else [x]
        indexed += [("i", "/unread", 0, "x"), ("i", "/p1", 999, None)]
        assert found(spark, source, indexed) == brute(source, indexed)


def test_equal_tables_in_any_order(spark):
    rows = [("i", "/p", o, str(o % 3)) for o in range(500)] + [("i", None, None, None)] * 3
    assert found(spark, rows, rows[::-1]) == []
    assert found(spark, [], []) == [] and len(found(spark, rows, [])) == 501


def test_swapped_and_null_values_are_seen(spark):
    """Equal counts with other content, which a comparison of counts passes."""
    rows = [("i", "/p", 0, "a"), ("i", "/p", 1, "b"), ("i", "/q", 0, None), ("i", "/r", 0, "same")]
    other = [("i", "/p", 0, "b"), ("i", "/p", 1, "a"), ("i", "/q", 0, ""), ("i", "/r", 0, "same")]
    a, b = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(other, SCHEMA)
    assert sorted(tuple(x) for x in differing_keys(a, b, KEYS, ["offset", "line"]).collect()) == [("i", "/p", 2, 2), ("i", "/q", 1, 1)]
    assert [x[3] for x in found(spark, rows, other)] == ["altered"] * 3


def test_digest_is_a_partial_aggregate(spark):
    df = spark.range(0, 1000, 1, 4).select(F.lit("i").alias("index"), F.lit("/hot").alias("path"), F.col("id").alias("offset"), F.lit("x").alias("line"))
    plan = content_digest(df, KEYS, ["offset", "line"])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") == 2 and "partial_sum" in plan
