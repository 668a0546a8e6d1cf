import random

import pytest

from linedocs.llm import tokens

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_random_texts_count_as_the_library(library):
    counter, rng = tokens.Counter(tokens.load_vocabulary(PATH)), random.Random(3)
    parts = [*"abcdeft'sSTV  \t\n\r\x0b\x0c\x1c\x85  　᠎09½²éÉéΣςİıſKßẞ漢́ͅǅﬁ😀‍.,;!<|>_-", "<|endoftext|>",
             "<|startoftext|>", "'ll", "don't", "가", "ΑΣ", "क्षि"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert counter.text(text) == library(text), text


def test_long_word_and_full_memory(library, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 2)
    counter = tokens.Counter(tokens.load_vocabulary(PATH))
    for text in ("ab" * 20000, "one two three four five six", "one two three"):
        assert counter.text(text) == library(text)


def test_merges_leftmost_of_equal_rank_first():
    ranks = {("a", "a"): 0, ("aa", "b"): 1}
    assert tokens.merged_length(list("aaab"), ranks) == 3  # aa, a, b
    assert tokens.merged_length(list("aab"), ranks) == 1
    assert tokens.merged_length([], ranks) == 0


def test_rows(spark, odd_docs, library):
    out = tokens.count_tokens(spark, odd_docs, PATH, limit=100)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and "`x.y`".strip("`") in out.columns
    for r in rows:
        text = r["text"] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), library(text))
        assert r["over_limit"] == (r["n_tokens"] > 100)
    assert tokens.count_tokens(spark, odd_docs.where("false"), PATH).count() == 0
