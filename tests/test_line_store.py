"""ORD1, RET3-RET5 on stored lines: clustered by file, found by postings."""

import json
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from linedocs.functions.text import tokens
from linedocs.operators import token_index
from linedocs.sinks.line_store import LineStore

from test_snapshots import ROOT


def _files(seed=1):
    r = random.Random(seed)
    words = ["me", "Meter", "the", "foo-bar", "x", "naïve", "İs", "漢字", "some", "me2", "\U0001F600", "THE", ""]
    out = {}
    for f in ("/a", "/b c", "/d'e", "/big", None):
        at, lines = 0, []
        for _ in range(900 if f == "/big" else r.randrange(1, 40)):
            line = " ".join(r.choice(words) for _ in range(r.randrange(6)))
            lines.append((at, line))
            at += len(line.encode()) + 1
        out[f] = lines
    return out


@pytest.fixture(scope="module")
def files():
    return _files()


@pytest.fixture(scope="module")
def store(spark, files, tmp_path_factory):
    rows = [(p, o, x) for p, lines in files.items() for o, x in lines]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "path string, offset long, line string").repartition(5)
    return LineStore.write(df, str(tmp_path_factory.mktemp("store") / "s"), buckets=6, part_bytes=2000)


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _rows_read(df):
    """Rows that the scans of ``df`` have read, once it has run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def _bucket_rows(store, path, part):
    own = store.lines().where((F.col("path") == path) & (F.col("part") == part)).select(F.pmod(F.hash("slot"), F.lit(6))).first()[0]
    return store.lines().where(F.pmod(F.hash("slot"), F.lit(6)) == own).count()


def test_line_numbers_without_exchange(spark, store, files):
    df = store.numbered()
    want = sorted(((p, i, o, x) for p, lines in files.items() for i, (o, x) in enumerate(lines)), key=str)
    assert sorted(map(tuple, df.collect()), key=str) == want
    plan = _plan(df)
    assert "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan and "Window" in plan


def test_a_file_comes_in_order(spark, store, files):
    again = LineStore(spark, store.out)
    for p in ("/a", "/b c", "/d'e", "/big"):
        df = again.file_in_order(p)
        assert [(r["offset"], r["line"]) for r in df.collect()] == files[p] and [r["path"] for r in df.collect()] == [p] * len(files[p])
        assert "Exchange" not in _plan(df)
    assert _rows_read(again.file_in_order("/a")) == _bucket_rows(store, "/a", 0) < store.lines().count() / 2
    assert store.parts().where("path = '/big'").count() > 3  # a large file lies in several buckets
    assert store.lines().where("path = '/big'").select(F.pmod(F.hash("slot"), F.lit(6))).distinct().count() > 1
    assert again.file_in_order("/none").collect() == []


def test_a_very_long_file_is_sorted(spark, store, files, monkeypatch):
    from linedocs.sinks import line_store
    monkeypatch.setattr(line_store, "MAX_BRANCHES", 2)
    assert [(r["offset"], r["line"]) for r in store.file_in_order("/big").collect()] == files["/big"]


def test_a_line_by_its_place(store, files):
    for p, k in (("/big", 700), ("/a", 0)):
        o, x = files[p][k]
        df = store.at(p, o)
        assert [tuple(r) for r in df.collect()] == [(p, o, x)]
        assert _rows_read(df) == _bucket_rows(store, p, o // 2000)
    assert store.at("/a", 10 ** 9).collect() == []


@pytest.fixture(scope="module")
def postings(spark, store, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("postings") / "p")
    token_index.write_postings(store, out)
    return token_index.read_postings(spark, out)


@pytest.mark.parametrize("few", [0, 1000])
@pytest.mark.parametrize("term", ["me", "The", "foo-bar", "bar", "naïve", "漢字", "absent"])
def test_terms(spark, store, postings, term, few, monkeypatch):
    monkeypatch.setattr(token_index, "FEW_SLOTS", few)
    from linedocs.functions.text import has_token
    want = store.lines().where(has_token("line", term)).select("path", "offset", "line").collect()
    assert sorted(token_index.term_search(store, postings, term).collect(), key=str) == sorted(want, key=str)
    assert (term == "absent") == (not want)


@pytest.mark.parametrize("prefix", ["me*", "foo-b*", "T", "漢", "zzz"])
def test_prefixes(spark, store, postings, prefix):
    from linedocs.functions.text import has_token_prefix
    want = store.lines().where(has_token_prefix("line", prefix)).select("path", "offset", "line").collect()
    assert sorted(token_index.prefix_search(store, postings, prefix).collect(), key=str) == sorted(want, key=str)


def test_after_a_prefix():
    assert token_index._after("me") == "mf" and token_index._after("m\U0010FFFF") == "n" and token_index._after("\U0010FFFF") is None
    assert token_index._after("퟿") == ""


def test_empty_store(spark, tmp):
    df = spark.createDataFrame([], "path string, offset long, line string")
    empty = LineStore.write(df, str(tmp / "s"))
    token_index.write_postings(empty, str(tmp / "p"))
    post = token_index.read_postings(spark, str(tmp / "p"))
    assert empty.numbered().collect() == [] and empty.file_in_order("/a").collect() == [] and empty.at("/a", 0).collect() == []
    assert token_index.term_search(empty, post, "x").collect() == []


SEARCH = """
import sys
sys.path.insert(0, {root!r})
from linedocs.session import local_session
from linedocs.operators import token_index
from linedocs.sinks.line_store import LineStore
spark = local_session(4, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": {log!r}, "spark.eventLog.compress": "false",
                                 "spark.eventLog.rolling.enabled": "false"}})
token_index.ROW_GROUP_BYTES = 64 << 10
docs = spark.range(0, 60000, 1, 8).selectExpr("concat('/p', id % 50) AS path", "id AS offset", "concat('w', id % 3000, ' common v', id) AS line")
store = LineStore.write(docs, {out!r} + "/s", buckets=8)
token_index.write_postings(store, {out!r} + "/p")
post = token_index.read_postings(spark, {out!r} + "/p")
spark.sparkContext.setLocalProperty("phase", "full")
assert post.where("length(token) < 0").count() == 0
spark.sparkContext.setLocalProperty("phase", "search")
assert post.where("token = 'w17'").count() == 20
spark.stop()
"""


def test_a_search_reads_few_rows(tmp):
    """Rows read by a term's scan of the postings, from the event log."""
    (tmp / "log").mkdir()
    subprocess.run([sys.executable, "-c", SEARCH.format(root=ROOT, log=str(tmp / "log"), out=str(tmp))], check=True, timeout=300,
                   stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    events = [json.loads(x) for x in open(next((tmp / "log").iterdir()))]
    phase = {e["Stage Info"]["Stage ID"]: (e.get("Properties") or {}).get("phase") for e in events if e["Event"] == "SparkListenerStageSubmitted"}
    read = {"full": 0, "search": 0}
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and phase.get(e["Stage ID"]) in read:
            read[phase[e["Stage ID"]]] += e["Task Metrics"]["Input Metrics"]["Records Read"]
    assert read["full"] >= 180_000 and 0 < read["search"] < read["full"] / 5


def test_tokens_are_those_of_the_postings(spark, store, postings):
    lines = store.lines().select(F.size(F.array_distinct(tokens("line"))).alias("n"))
    assert postings.count() == lines.agg(F.sum("n")).first()[0]


def test_blocks_hold_each_token_of_a_line_once():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"slot": [5, -7, 5, 9], "mark": [1, 2, 1, 3], "offset": pa.array([0, 4, None, 1], pa.int64()),
                                        "tokens": pa.array([["b", "a", "b"], ["b"], [], None], pa.list_(pa.string()))})
    got = [r for b in token_index.block_maker()(iter([batch, batch.slice(1, 1), batch.slice(2), batch.slice(0, 0)])) for r in b.to_pylist()]
    want = [("a", 5, [5], [1], [0]), ("b", -7, [-7], [2], [4]), ("b", -7, [5, -7], [1, 2], [0, 4])]
    assert sorted((tuple(r.values()) for r in got), key=str) == sorted(want, key=str)


def test_lines_are_tokenized_once_and_by_many_tasks(spark, tmp, monkeypatch):
    """A bucket's file has several row groups, and its lines are read once for the postings."""
    from pyspark.sql import functions as F

    from linedocs.sinks import line_store
    monkeypatch.setattr(line_store, "ROW_GROUP_BYTES", 64 << 10)
    df = spark.range(0, 20000, 1, 4).selectExpr("concat('/p', id) AS path", "0L AS offset", "concat('w', sha2(cast(id AS string), 256)) AS line")
    one = LineStore.write(df, str(tmp / "s"), size=1)
    import pyarrow.parquet as pq
    assert one.buckets == 1 and sum(pq.ParquetFile(f).num_row_groups for f in (tmp / "s" / "lines").glob("*.parquet")) > 3
    seen = spark.sparkContext.accumulator(0)
    plain = token_index.block_maker()

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield from plain(iter([b]))
    monkeypatch.setattr(token_index, "block_maker", lambda: counted)
    token_index.write_postings(one, str(tmp / "p"))
    assert seen.value == 20000 and token_index.read_postings(spark, str(tmp / "p")).agg(F.count("*")).first()[0] == 20000
