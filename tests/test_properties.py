"""Property tests: STR3 against Java String.split rules, stored-text offsets
against the raw UTF-8 bytes."""

import random

from linedocs.functions.text import java_split_space
from linedocs.sources.stored import explode_lines


def java_split(s: str) -> list[str]:
    """Java ``s.split(" ")``: trailing empty strings removed; "" -> [""]."""
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _texts(seed: int, n: int = 800) -> list[str]:
    """Many short texts over an alphabet of edge cases, all in one run."""
    rng = random.Random(seed)
    return ["", " ", "  ", "a ", " a", "a  b  "] + [
        "".join(rng.choice("ab \tçé \n") for _ in range(rng.randint(0, 24))) for _ in range(n)]


def test_java_split_space_matches_java_rules(spark):
    values = [v.replace("\n", "") for v in _texts(1)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    got = {r["i"]: r["w"] for r in df.select("i", java_split_space(df["v"]).alias("w")).collect()}
    for i, v in enumerate(values):
        assert got[i] == java_split(v), repr(v)


def test_stored_offsets_point_at_the_line_bytes(spark):
    values = _texts(2)
    df = spark.createDataFrame(list(enumerate(values)), "i int, text string").repartition(3)
    by_doc = {}
    for r in explode_lines(df, keep=["i"], line_no=True).collect():
        by_doc.setdefault(r["i"], []).append((r["line_no"], r["offset"], r["line"]))
    for i, v in enumerate(values):
        raw, got = v.encode(), sorted(by_doc[i])
        assert [line for _, _, line in got] == v.split("\n")
        at = 0
        for _, off, line in got:
            assert off == at and raw[off:off + len(line.encode())] == line.encode()
            at += len(line.encode()) + 1


def test_one_huge_text_is_linear(spark):
    import time
    n = 200_000
    text = "\n".join(f"l{i}" for i in range(n))
    df = spark.createDataFrame([(1, text)], "i int, text string")
    t0 = time.time()
    last = explode_lines(df, keep=["i"], line_no=True).filter(f"line_no = {n - 1}").first()
    assert last["line"] == f"l{n - 1}"
    assert last["offset"] == len(text.encode()) - len(f"l{n - 1}")
    assert time.time() - t0 < 60  # a quadratic prefix sum would take far longer
