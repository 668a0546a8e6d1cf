import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linedocs.llm import lmscore


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    pairs = {w: rng.sample(words, 6) for w in words}

    def sentence():
        w = rng.choice(words)
        out = [w]
        for _ in range(rng.randint(5, 80)):
            w = rng.choice(pairs[w])
            out.append(w)
        return " ".join(out)

    return [sentence() for _ in range(1500)]


def items(texts):
    return [i for t in texts for i in lmscore.items_of(lmscore.split_words(t))]


def streams_of(texts):
    return [lmscore.stream_of(lmscore.split_words(t)) for t in texts]


@pytest.fixture(scope="module")
def model(texts):
    streams = streams_of(texts)
    coder = lmscore.Coder(lmscore.code_trees(b"".join(streams[:1000])))
    counts = lmscore.Counts(coder)
    counts.texts(iter(streams[:1000]))
    words = Counter(w for t in texts[:1000] for w in [*t.lower().split(), "\n"])
    counts.words(list(words), np.array(list(words.values())))
    codes = [lmscore.codes_of(t[::2].astype(float), t[1::2].astype(float)) for t in counts.finish()]
    return coder, codes, lmscore.learn_mixer(streams[1000:1200], coder, codes), streams


@pytest.mark.parametrize("chunk", [1 << 15, 300])
def test_tables_are_counts_of_all_decisions(texts, model, chunk, monkeypatch):
    """The shortcuts (three-byte sequences, counted words, pieces) give what counting each decision gives."""
    monkeypatch.setattr(lmscore, "CHUNK", chunk)
    coder, some = model[0], texts[:40] + ["", " ".join(texts[40:60])]
    streams = streams_of(some)
    plain = [np.zeros(2 << b, np.uint32) for b in lmscore.TABLE_BITS]
    for s in streams:
        _, slots, bit, _ = coder.decisions([s])
        for t, x in zip(plain, slots):
            np.add.at(t, (x << 1) + bit, np.ones(len(bit), np.uint32))
    counts = lmscore.Counts(coder)
    counts.texts(iter(streams))
    words = Counter(w for t in some for w in [*t.lower().split(), "\n"])
    counts.words(list(words), np.array(list(words.values())))
    assert all((a == b).all() for a, b in zip(plain, counts.finish()))


def test_code_tree_is_a_prefix_code(model):
    lengths = model[0].tree["length"].reshape(256, 256)
    assert (abs((2.0 ** -lengths).sum(axis=1) - 1) < 1e-12).all()


def test_next_byte_probabilities_sum_to_one(model):
    coder, codes, mixer, streams = model
    for head in (b"", streams[5][:17], streams[7][:40]):
        total = 0.0
        for x in range(256):
            cost, _ = lmscore.decision_costs([head + bytes([x])], coder, codes, mixer)
            total += 10 ** float(cost[coder.skipped(head):].sum(dtype=np.float64))
        assert abs(total - 1) < 1e-3


def test_contexts_by_definition(model):
    """Equal contexts give equal slots; a text sees nothing of its neighbours."""
    coder = model[0]
    batch = [b"ab cd \n", b"xyab cd \n", b"\n"]
    node, slots, bit, starts = coder.decisions(batch)
    for i, s in enumerate(batch):
        alone = coder.decisions([s])
        part = slice(starts[i], starts[i + 1] if i + 1 < len(starts) else len(node))
        assert (alone[0] == node[part]).all() and (alone[2] == bit[part]).all()
        assert all((a == b[part]).all() for a, b in zip(alone[1], slots))
    n = coder.skipped(batch[0]) - coder.skipped(b"ab ")
    first, second = (coder.decisions([s]) for s in batch[:2])
    assert (first[1][2][-n:] == second[1][2][-n:]).all() and (first[1][0][-n:] == second[1][0][-n:]).all()
    assert (first[1][1][-n:] != second[1][1][-n:]).any()  # other four bytes where "cd" starts


def test_held_out_accuracy(model):
    coder, codes, mixer, streams = model
    test = streams[1200:]
    n = sum(map(len, test))
    bits = -sum(lmscore.log10_probabilities(test, coder, codes, mixer)) * math.log2(10) / n
    p = np.bincount(np.frombuffer(b"".join(streams[:1000]), np.uint8), minlength=256) + 1e-9
    order0 = -np.log2(p[np.frombuffer(b"".join(test), np.uint8)] / p.sum()).mean()
    alone = []
    for j in range(3):  # each predictor by itself
        only = [c if i == j else np.zeros_like(c) for i, c in enumerate(codes)]
        m = lmscore.learn_mixer(streams[1000:1200], coder, only)
        alone.append(-sum(lmscore.log10_probabilities(test, coder, only, m)) * math.log2(10) / n)
    assert bits < 0.7 * order0 and bits < min(alone)


def test_long_text_in_pieces(model, monkeypatch):
    coder, codes, mixer, streams = model
    text = b" ".join(s.strip() for s in streams[:200]) + b" \n"
    whole = float(lmscore.decision_costs([text], coder, codes, mixer)[0].sum(dtype=np.float64))
    monkeypatch.setattr(lmscore, "CHUNK", 1000)
    assert abs(lmscore.log10_probabilities([streams[0], text, b"\n"], coder, codes, mixer)[1] - whole) < 1e-6 * -whole


def check_base(rows, docs, head=None):
    train = Counter()
    for i, t in docs:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1:
            train.update(lmscore.split_words(t))
            train["end"] += 1
    n, v = sum(train.values()), len(train)
    expected = []
    for i, t in docs:
        w = [*lmscore.split_words(t), "end"]
        base = sum(math.log10((train[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        expected.append((str(i), zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1, len(w), sum(train[x] > 0 for x in w), n, round(base, 4)))
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows]
    assert sorted(got) == sorted(expected)
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in rows)


@pytest.mark.parametrize("head", [20, 100_000])
def test_scores_in_spark(spark, texts, head):
    docs = [(i, t) for i, t in enumerate(texts[:400])] + [(0, texts[0]), (7, None), (None, "ETA x"), (8, ""), (9, "K İ E")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    check_base(lmscore.score(spark, df, head_words=head).collect(), docs)


def test_rows(spark, odd_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    check_base(lmscore.score(spark, odd_docs).collect(), docs)
    assert lmscore.score(spark, odd_docs.where("false")).count() == 0


def test_mixer_learns_from_every_training_text(spark, texts):
    """Tasks' sums hold each decision of all texts once, past 500 texts and 1 MB, long ones whole."""
    some = texts + [" ".join(texts * 8)]
    assert sum(map(len, some)) > 1 << 20
    streams = streams_of(some)
    df = spark.createDataFrame([(t, i % 2, i) for i, t in enumerate(some)], "text string, fold int, place long").repartition(4)
    pairs = lmscore.pair_counts(df.select("text"))
    assert pairs[ord("e") << 8 | ord("t")] == sum(s.count(b"et") for s in streams)
    coder = lmscore.Coder(lmscore.trees_of(pairs))
    blank = [np.zeros(1 << b, np.uint8) for b in lmscore.TABLE_BITS]
    mixer = lmscore.mixed_in_tasks(spark, df, coder.tree, [blank, blank], size=100 << 20)
    assert mixer.total.sum() == sum(coder.skipped(s) for s in streams)
    ones = sum(int(coder.decisions([s])[2].sum()) for s in streams[:-1])
    assert ones < mixer.ones.sum() < mixer.total.sum()


def test_no_training_text_is_withheld_from_the_tables(spark):
    """Copies of training texts are known ones, all of them."""
    rng = random.Random(11)
    ids = {h: [i for i in range(2000) if (zlib.crc32(str(i).encode()) % 5 == 1) == h] for h in (False, True)}
    own = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(10)) for _ in range(60)]
    docs = list(zip(ids[False], own)) + list(zip(ids[True], own))
    rows = lmscore.score(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).where("held_out").collect()
    bits = sorted(r["bits_per_byte"] for r in rows)
    assert len(bits) == 60 and bits[-1] < 1.3 * bits[0]


def test_scores_do_not_depend_on_partitions(spark, texts, monkeypatch):
    monkeypatch.setattr(lmscore, "SHARD_BYTES", 50_000)
    docs = [(i, t) for i, t in enumerate(texts[:500])] + [(i, texts[0]) for i in range(500, 540)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    one, many = ({r["doc_id"]: r["score"] for r in lmscore.score(spark, df.repartition(n)).collect()} for n in (1, 13))
    assert one.keys() == many.keys() and all(abs(one[i] - many[i]) <= 1e-6 * abs(one[i]) for i in one)


def test_scores_as_in_one_process(spark, texts):
    """The model learned and applied in one process over all texts, shards of one."""
    docs = [(i, t) for i, t in enumerate(texts[:300])] + [(301, None), (302, ""), (303, texts[0])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    full = F.coalesce("text", F.lit(""))
    rows = df.select("doc_id", full.alias("text"), F.pmod(F.xxhash64(full), F.lit(2)).alias("fold"), F.xxhash64("doc_id", full).alias("place")).collect()
    train = sorted((r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1), key=lambda r: r["place"])
    streams = {r["doc_id"]: lmscore.stream_of(lmscore.split_words(r["text"])) for r in rows}
    coder = lmscore.Coder(lmscore.trees_of(sum(lmscore.pairs_of(b" " + streams[r["doc_id"]]) for r in train)))
    sums = []
    for fold in (0, 1):
        own = [r for r in train if r["fold"] == fold]
        words = Counter(w for r in own for w in [*lmscore.split_words(r["text"]), b"\n"])
        counts = lmscore.Counts(coder)
        counts.texts(streams[r["doc_id"]] for r in own)
        counts.words([w.decode() for w in words], np.array(list(words.values())))
        sums.append(counts.finish())
    sums.append([a + b for a, b in zip(*sums)])
    tables = [[lmscore.codes_of(t[::2].astype(float), t[1::2].astype(float)) for t in s] for s in sums]
    mixer = lmscore.Mixer()
    for at in range(0, len(train), 400):
        part = train[at:at + 400]
        for fold in (0, 1):
            mixer.streams([streams[r["doc_id"]] for r in part if r["fold"] == fold], coder, tables[1 - fold])
    model = lmscore.mixer_of(mixer.weights, mixer.total, mixer.ones)
    want = dict(zip(streams, lmscore.log10_probabilities(list(streams.values()), coder, tables[2], model)))
    got = {r["doc_id"]: r["score"] for r in lmscore.score(spark, df).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) <= 1e-5 * abs(want[i]) for i in want)


def test_counts_of_a_whole_corpus_do_not_wrap(spark, model):
    many = 5_000_000_000
    words = spark.createDataFrame([("abc", many), ("abd", 3)], "word string, c long")
    tree = model[0].tree
    slices = lmscore.word_tables(words, tree)
    pa_codec, total = __import__("pyarrow").Codec("zstd"), 0
    for r in slices.collect():
        total += int(np.frombuffer(pa_codec.decompress(bytes(r["data"]), 16 * lmscore.SLICE, asbytes=True), np.uint64).sum())
    coder = lmscore.Coder(tree)
    assert total == many * coder.skipped(b"abc ") + 3 * coder.skipped(b"abd ")
    folded = slices.withColumn("fold", F.lit(0)).select("fold", "slice", "salt", "data")
    codes = lmscore.summed_tables(spark, folded)[2][2]
    counts = lmscore.Counts(coder, np.uint64)
    counts.words(["abc", "abd"], np.array([many, 3]))
    assert (codes == lmscore.codes_of(counts.tables[2][::2].astype(float), counts.tables[2][1::2].astype(float))).all()


def test_scoring_looks_each_part_of_a_word_up_once(texts, model, monkeypatch):
    """Sums over remembered heads and tails are those over all decisions; texts met again need no decision."""
    coder, codes, mixer, _ = model
    odd = ["", "\x00", "a\x00 \x00", "abcdefg\x00 abcdefg abcdefgh abcdefghi", "x y z", "é 世界 " + "q" * 5000, " ".join(texts[:300]), "z" * 70_000]
    words = [lmscore.split_words(t) for t in [*texts[1000:1200], *odd]]
    streams = list(map(lmscore.stream_of, words))
    want = lmscore.log10_probabilities(streams, coder, codes, mixer)
    made, expand = [], lmscore.Coder.expand

    def counting(self, pair, reps, contexts):
        made.append(int(reps.sum()))
        return expand(self, pair, reps, contexts)

    monkeypatch.setattr(lmscore.Coder, "expand", counting)
    parts = lmscore.Parts(coder, codes, mixer, {b"x": -1.5, b"abcdefghi": -2.5}.get)
    for again in range(2):
        rows = list(lmscore.text_scores(words, parts))
        assert all(abs(r[4] - w) <= 1e-9 * abs(w) for r, w in zip(rows, want))
    assert [r[:2] for r in rows] == [(len(s), len(w) + 1) for s, w in zip(streams, words)]
    known = [[w for w in ws if w in (b"x", b"abcdefghi")] for ws in words]
    assert [r[2:4] for r in rows] == [(len(k), sum(-1.5 if w == b"x" else -2.5 for w in k)) for k in known]
    assert all(dict(zip(*r[5:])) == Counter(w for w in [*ws, b"\n"] if w not in (b"x", b"abcdefghi")) for r, ws in zip(rows, words))
    made.clear()
    short = [w for w, s in zip(words, streams) if len(s) <= 2 * lmscore.CHUNK]
    assert len(short) < len(words) and len(list(lmscore.text_scores(short, parts))) == len(short) and sum(made) == 0
    parts.forget(0)  # changes no result
    assert not parts.long and abs(list(lmscore.text_scores(short, parts))[0][4] - want[0]) <= 1e-9 * abs(want[0])


def test_pairs_of_counted_words_are_those_of_the_texts(spark, texts):
    df = spark.createDataFrame([(t, i % 2) for i, t in enumerate([*texts[:50], "", "É x"])], "text string, fold int").repartition(3)
    words = lmscore.counted(df).where("word is not null").selectExpr("word", "c0 + c1 as c")
    plain = sum(lmscore.pairs_of(b" " + s) for s in streams_of([*texts[:50], "", "É x"]))
    assert (lmscore.pair_counts(words) == plain).all()
