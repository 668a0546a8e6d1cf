import pytest
from pyspark.sql import functions as F

LONG = "lorem ipsum dolor sit amet " * 9000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and columns whose names operators might use."""
    rows = [(1, "a b c d", "en", "s1"), (1, "a b c d", "en", "s1"), (1, "other text under the same id", "en", None),
            (None, "no id here", None, "s1"), (None, "no id here", None, "s1"), (None, None, None, None),
            (2, None, "en", "s2"), (3, "", "de", "s2"), (4, " \t\n ", "de", "s2"), (5, LONG, "fr", "s1"), (6, LONG, "fr", "s3"),
            (7, "ÀÉ ß ﬁ 漢字 😀 İ Σ", "es", "s3"), (8, "x\n\ny\n\nx", "es", "s3")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    extra = {c: F.lit(c) for c in ("fp", "key", "n", "r", "a", "b", "w", "seq", "start", "l", "tokens", "s", "h", "slice", "weight", "copies",
                                   "word", "c", "score", "n_tokens", "n_words", "hits", "host", "path", "rule", "kept", "f", "good", "x.y")}
    return df.withColumns(extra)
