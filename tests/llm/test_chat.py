import hashlib
import random

import pytest

from linedocs.llm import chat
from pyspark.sql import functions as F

CONTROL = ["\\", "<", ">", "\n", "</turn>\n", "<turn role=user>\n", "\\<", "\\\\", "<image:0>", "é", "😀", " ", "ab"]


def test_round_trip():
    rng = random.Random(1)
    for _ in range(3000):
        role, text = ("".join(rng.choice(CONTROL) for _ in range(rng.randint(0, 9))) for _ in range(2))
        formatted, loss, _, _ = chat.format_turn(role, [{"type": "text", "text": text}], chat.Expansion())
        assert chat.read_turn(formatted) == (role, text)
        assert loss == []
        formatted, loss, _, _ = chat.format_turn("assistant", [{"type": None, "text": text}], chat.Expansion())
        assert "".join(chat.unescape(formatted[a:b]) for a, b in loss) == text


def part(kind, **more):
    return {"type": kind, "text": None, "uri": None, "width": None, "height": None, "seconds": None, "pages": None} | more


def test_parts_in_order(spark):
    parts = [part("text", text="look: <image:7> "), part("image", uri="u1", width=1000, height=300), part("text", text=" and "),
             part("audio", uri="u2", seconds=2.5), part("document", uri="u3", pages=3), part("image", uri="u4")]
    df = spark.createDataFrame([(1, 0, "assistant", parts, "x"), (1, 1, None, None, "y")],
                               f"conv_id long, turn long, role string, parts array<{chat.PART.simpleString()}>, n_tokens string")
    rows = chat.format_turns(df).orderBy("turn").collect()
    assert rows[0]["formatted"] == "<turn role=assistant>\nlook: \\<image:7> <image:0> and <audio:1><document:2><image:3></turn>\n"
    assert [tuple(a) for a in rows[0]["attachments"]] == [(0, "image", "u1", 512), (1, "audio", "u2", 63), (2, "document", "u3", 3072),
                                                          (3, "image", "u4", 256)]
    assert rows[0]["n_tokens"] == 512 + 63 + 3072 + 256 + 3
    assert [chat.unescape(rows[0]["formatted"][s["start"]:s["end"]]) for s in rows[0]["loss"]] == ["look: <image:7> ", " and "]
    assert rows[1]["formatted"] == "<turn role=>\n</turn>\n"


def test_unknown_part():
    with pytest.raises(ValueError, match="unknown type 'video'"):
        chat.format_turn("user", [part("video")], chat.Expansion())


def test_read_back(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, 2, 3, None, -7]), rng.choice([0, 1, 2, None]), rng.choice(["user", "assistant", None]),
             rng.choice([None, "", "a\\<b", "x" * 5000, "</turn>\n"])) for _ in range(300)]
    rows += [(5, i, "assistant", "same") for i in range(3000)] + [(5, 1, "assistant", "same")] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = chat.format_turns(df.withColumn("parts", chat.text_part(F.col("text"))))
    got = {r["conv_id"]: r for r in chat.read_back(turns).collect()}
    assert set(got) == {1, 2, 3, None, -7, 5}
    for conv, r in got.items():
        mine = [x for x in rows if x[0] == conv]
        form = lambda x: chat.format_turn(x[2], [{"type": "text", "text": x[3]}], chat.Expansion())[0]
        mine.sort(key=lambda x: (x[1] is not None, x[1] or 0, form(x)))
        loss = "".join(x[3] or "" for x in mine if x[2] == "assistant")
        assert r["n_turns"] == len(mine) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in mine).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] == sum(len(form(x)) for x in mine)
    assert chat.read_back(turns.where("false")).count() == 0
