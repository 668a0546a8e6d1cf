"""Secret scans: fixed patterns plus a randomness test battery.

Patterns find what announces itself.  For the rest, every long run of key
characters that mixes letters and digits is a candidate.  Its encoding is
inferred (hexadecimal, base 32, base 62, base 64; a run with separators of both
kinds of base 64 is cut at either, or is one of 66 symbols), and three tests ask whether
its symbols look drawn at random from that alphabet: chi-squared uniformity
(Wilson-Hilferty), a Wald-Wolfowitz runs test about the middle of the alphabet,
and lag-1 serial correlation.  Their Bonferroni combination is the candidate's
p-value.  A secret is random, so a *rejected* candidate is ordinary text; what
the battery cannot reject is reported.

False dismissals of random strings are held below ``rate`` by a step-up procedure in each
class of length (20 to 31 symbols, 32 to 63, and so on by doubling): a long string has a sharper battery than a short one, so
the classes have thresholds of their own, and neither the many short candidates of a table nor its ordinary
text decide how long ones are judged.  In each class a random string is dismissed with chance ``rate`` at
most.  The thresholds need only counts of p-values by class on a fine grid (rounded up, so the
rate still holds), never the candidates themselves, in one place.
"""

from __future__ import annotations

import hashlib
import math
import re
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs either way
KEYWORD = re.compile(rb"password|passwd|secret|token|api_?key")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
KINDS = ["assign", "access", "hex", "random"]

#: Grid of -log10 p (step, largest).
STEP, LARGEST = 0.01, 40.0

SCAN = ("base array<struct<kind:int,start:long,end:long>>, "
        "found array<struct<start:long,end:long,symbols:int,logp:double>>")

ALPHABETS = [  # encoding, symbols in order, the fewest that a string needs to be one
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("joint", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end): leftmost non-overlapping per kind, by start then kind."""
    out = []
    if KEYWORD.search(text.encode().lower()):
        out += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def encoding(word: str) -> tuple[str, np.ndarray] | None:
    """The smallest alphabet that holds the word, and its symbols' numbers."""
    used = set(word)
    for name, alphabet in ALPHABETS:
        if used <= set(alphabet):
            return name, np.array([alphabet.index(c) for c in word])
    return None


def upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(symbols: np.ndarray, size: int) -> float:
    """Combined p-value of the three tests under uniform independent symbols."""
    n = len(symbols)
    counts = np.bincount(symbols, minlength=size)
    df = size - 1
    chi2 = float(((counts - n / size) ** 2).sum() * size / n)
    cube = (max(chi2, 1e-9) / df) ** (1 / 3)
    tests = [upper_tail((cube - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))]
    high = symbols * 2 >= size
    a, b = int(high.sum()), int(n - high.sum())
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 1 + 2 * a * b / n
    var = 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
    # all on one side of the middle: as unlikely as n equal tosses
    tests.append(2 * upper_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 2.0 ** (1 - n))
    x = symbols - symbols.mean()
    power = float((x * x).sum())
    r = float((x[1:] * x[:-1]).sum()) / power if power else 1.0
    tests.append(2 * upper_tail(abs(r * n + 1) / math.sqrt(n)))
    return min(1.0, 3 * min(tests))


def mixes(word: str) -> bool:
    return any(c.isdigit() for c in word) and any(c.isalpha() for c in word)


def pieces(word: str) -> list[tuple[int, int]]:
    """Spans of the candidates in a run with separators of both base 64 alphabets: what lies between those of the
    one and between those of the other, so that a token is found whole whichever it uses; else the whole run."""
    found = {m.span() for other in ("[^+/]{20,}", "[^_-]{20,}") for m in re.finditer(other, word) if mixes(m[0])}
    return sorted(found) or [(0, len(word))]


def candidates(text: str) -> list[tuple[int, int, int, float]]:
    """(start, end, symbols, -log10 p) of runs that mix letters and digits."""
    out = []
    for m in CANDIDATE.finditer(text):
        word = m[0].rstrip("=")
        if not mixes(word):
            continue
        for a, b in pieces(word) if encoding(word)[0] == "joint" else [(0, len(word))]:
            name, symbols = encoding(word[a:b])
            p = battery(symbols, len(dict(ALPHABETS)[name]))
            out.append((m.start() + a, m.end() if b == len(word) else m.start() + b, b - a, min(LARGEST, -math.log10(max(p, 1e-300)))))
    return out


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the struct column ``_scan``: pattern spans and tested candidates."""
    @F.pandas_udf(SCAN)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([(base_spans(t), candidates(t)) for t in texts], columns=["base", "found"])

    return df.withColumn("_scan", of(F.coalesce(F.col(text), F.lit(""))))


def length_class(symbols: int) -> int:
    """Doubling classes of length."""
    return symbols.bit_length()


def dismissal(found: DataFrame, rate: float) -> dict[int, float]:
    """Threshold by length class from rows (symbols, logp): a candidate is dismissed as ordinary text when
    logp >= threshold.  The step-up rule at level ``rate`` in each class; a class without candidates has none."""
    step = F.floor(F.greatest(F.col("logp"), F.lit(0.0)) / STEP).alias("bin")
    bins = (found.select(F.length(F.bin("symbols")).alias("class"), step).groupBy("class", "bin")
            .agg(F.count("*").alias("n")).collect())  # at most one row per class and grid step
    out = {}
    for c in {b["class"] for b in bins}:
        own = sorted((b for b in bins if b["class"] == c), key=lambda b: -b["bin"])
        total, passed, out[c] = sum(b["n"] for b in own), 0, math.inf
        for b in own:
            passed += b["n"]
            if 10 ** (-b["bin"] * STEP) <= rate * passed / total:
                out[c] = b["bin"] * STEP
    return out


def joined(kinds_and_spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in kinds_and_spans)


def find_secrets(spark: SparkSession, df: DataFrame, keep: list[str], text: str = "text", rate: float = 0.05) -> DataFrame:
    """The columns ``keep`` of ``df`` with n_assign, n_access, n_hex, base_sha256 and spans.

    ``spans`` has the pattern spans and, as ``random``, each candidate that the
    battery does not dismiss and that lies in no pattern span.  Null or empty
    texts have no spans (the digest is that of an empty string); rows pass one to
    one; an empty table gives an empty one.  Texts are scanned once, spans and
    p-values are written to the shared folder."""
    rows = written(spark, scan(df.select(*[F.col(k) for k in keep], F.col(text).alias("__text")), "__text").drop("__text"), "spans")
    thresholds = dismissal(rows.select(F.explode("_scan.found").alias("c")).select("c.symbols", "c.logp"), rate)

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def report(scans: pd.DataFrame) -> pd.DataFrame:
        out = []
        for base, found in zip(scans["base"], scans["found"]):
            fixed = [(s["kind"], s["start"], s["end"]) for s in base]
            more = [(3, c["start"], c["end"]) for c in found
                    if math.floor(max(0.0, c["logp"]) / STEP) * STEP < thresholds[length_class(c["symbols"])]  # the same steps as the bins
                    and not any(a <= c["start"] and c["end"] <= b for _, a, b in fixed)]
            kinds = [k for k, _, _ in fixed]
            out.append((kinds.count(0), kinds.count(1), kinds.count(2),
                        hashlib.sha256(joined(fixed).encode()).hexdigest(),
                        joined(sorted(fixed + more, key=lambda s: (s[1], s[0])))))
        return pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    done = rows.select(*[F.col(k) for k in keep], report(F.col("_scan")).alias("__report"))
    return done.select(*[F.col(k) for k in keep], "__report.*")
