"""Column -> Column helpers for paths, words, names and dates.

All of them are built-in Spark expressions (JVM side, whole-stage codegen);
none needs Python at run time.  Regular expressions are Java regexes; every
end anchor is ``\\z`` (absolute end), never ``$``, which also matches before
a final line terminator.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
#  STR1 full scheme/host strip:  '^file:(?://)?/' -> '/'
#                                '^hdfs://(?:[\w.-]+(?::\d+)?)?/' -> '/'
#  STR2 prefix-only strip:       '^file:' -> ''
#                                '^hdfs://[\w.-]+(?:\d+)?' -> ''
#  STR3 word separator:          one literal space, Java String.split rules
#  STR4 file-safe name:          '[^A-Za-z0-9_-]' -> '_'
# ---------------------------------------------------------------------------
FILE_SCHEME_FULL = r"^file:(?://)?/"
HDFS_SCHEME_FULL = r"^hdfs://(?:[\w.-]+(?::\d+)?)?/"
FILE_SCHEME_PREFIX = r"^file:"
HDFS_SCHEME_PREFIX = r"^hdfs://[\w.-]+(?:\d+)?"
UNSAFE_NAME_CHARS = r"[^A-Za-z0-9_-]"

# Token separator for full-text matching (our choice, not a reference fact):
# anything that is not a Unicode letter or digit.
TOKEN_SEPARATOR = r"[^\p{L}\p{N}]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_scheme_host(path) -> Column:
    """STR1: ``hdfs://nn:8020/a`` and ``file:///a`` both become ``/a``."""
    p = F.regexp_replace(_c(path), FILE_SCHEME_FULL, "/")
    return F.regexp_replace(p, HDFS_SCHEME_FULL, "/")


def strip_scheme_prefix(path) -> Column:
    """STR2: the weaker prefix-only variant (leaves ``:8020/a`` etc.)."""
    p = F.regexp_replace(_c(path), FILE_SCHEME_PREFIX, "")
    return F.regexp_replace(p, HDFS_SCHEME_PREFIX, "")


def java_split_space(line) -> Column:
    """STR3: split on one literal space with Java ``String.split`` rules.

    Leading and interior empty strings are kept, trailing ones dropped;
    ``""`` gives ``[""]`` and an all-space line gives ``[]``.
    """
    s = _c(line)
    # the regex runs only on lines that end in a space (rare in prose)
    trimmed = F.when(s.endswith(" "), F.regexp_replace(s, r" +\z", "")).otherwise(s)
    return (F.when(s == "", F.array(F.lit("")))
             .when(trimmed == "", F.array().cast("array<string>"))
             .otherwise(F.split(trimmed, " ", -1)))


def safe_name(name) -> Column:
    """STR4: every character outside ``[A-Za-z0-9_-]`` becomes ``_``."""
    return F.regexp_replace(_c(name), UNSAFE_NAME_CHARS, "_")


def split_list(value: str | list[str] | tuple[str, ...]) -> list[str]:
    """STR5: a comma list (``"a,b"``) or a sequence -> list of non-empty items.

    A comma inside braces belongs to a glob (``/in/{a,b}/*.log``) and does not
    split.  This runs on the driver on an *option value* (paths, topics), never on data.
    """
    if not isinstance(value, str):
        items = list(value)
    else:
        items, depth, start = [], 0, 0
        for i, c in enumerate(value):
            depth += (c == "{") - (c == "}")
            if c == "," and depth <= 0:
                items.append(value[start:i])
                start = i + 1
        items.append(value[start:])
    return [i.strip() for i in items if i and i.strip()]


def tokens(line) -> Column:
    """Lower-cased tokens: maximal runs of letters and digits."""
    return F.array_remove(F.split(F.lower(_c(line)), TOKEN_SEPARATOR, -1), "")


TOKEN_CHAR = r"[\p{L}\p{N}]"


def _term_tokens(term: str) -> list[str]:
    """The tokens of a search term (Python's view of ``TOKEN_SEPARATOR``)."""
    found = "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in term.lower()).split()
    if not found:
        raise ValueError(f"the search term {term!r} has no letter or digit")
    return found


def _has_literal(line, found: list[str]) -> Column:
    """The longest token is somewhere in the line: a byte search, which spares most lines the regex."""
    return F.contains(F.lower(_c(line)), F.lit(max(found, key=len)))


def _starts(token: str) -> str:
    """No token character before this place.  Behind the first letter's own test, so that the look-behind runs
    where that letter is and not at every character."""
    first = re.escape(token[0])
    return f"(?={first})(?<!{TOKEN_CHAR})"


def has_token(line, term: str) -> Column:
    """RET4 predicate: ``term`` is one of the line's tokens (case-insensitive).

    Same answer as ``array_contains(tokens(line), term)`` for a term that is one
    token, as one regex test on the lower-cased line.  A term of several tokens
    (``foo-bar``) matches them in a row with any separator between them.
    """
    found = _term_tokens(term)
    t = TOKEN_SEPARATOR.join(map(re.escape, found))
    return _has_literal(line, found) & F.lower(_c(line)).rlike(f"{_starts(found[0])}{t}(?!{TOKEN_CHAR})")


def has_token_prefix(line, prefix: str) -> Column:
    """RET3 predicate: some token starts with ``prefix`` (query ``me*``)."""
    found = _term_tokens(prefix.rstrip("*"))
    p = TOKEN_SEPARATOR.join(map(re.escape, found))
    return _has_literal(line, found) & F.lower(_c(line)).rlike(_starts(found[0]) + p)


def decode_file_uri(uri) -> Column:
    """``_metadata.file_path`` is a percent-encoded URI; decode it exactly.

    ``url_decode`` treats ``+`` as a space, so literal ``+`` is protected first.
    """
    return F.url_decode(F.replace(_c(uri), F.lit("+"), F.lit("%2B")))


# ---------------------------------------------------------------------------
# FN5 date detection (our own choice of formats; the original leaves it as a
# to-do).  The leftmost date-like text in the line is found with ONE regex
# pass; at one position the longer forms are tried first.  The match is then
# classified by its length and separator characters, and rewritten as ISO text
# (so each row pays one scan and one cast).  Digits on either side of a date
# keep it from being one.  An
# impossible date (month 13) gives null, as does a line without a date.
# Fractional seconds and zone suffixes after a match are not part of it: the
# result is the wall-clock time written in the line, to the second.
# Normalised output is ISO-8601 ``yyyy-MM-dd'T'HH:mm:ss``.
# ---------------------------------------------------------------------------
DATE_FORMATS = [
    ("iso_t", r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}", "yyyy-MM-dd'T'HH:mm:ss"),
    ("iso_space", r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", "yyyy-MM-dd HH:mm:ss"),
    ("slashes", r"\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}", "yyyy/MM/dd HH:mm:ss"),
    ("access_log", r"\d{2}/[A-Z][a-z]{2}/\d{4}:\d{2}:\d{2}:\d{2}", "dd/MMM/yyyy:HH:mm:ss"),
    ("date_only", r"\d{4}-\d{2}-\d{2}", "yyyy-MM-dd"),
]
DATE_PATTERN = r"(?<!\d)(?:" + "|".join(p for _, p, _ in DATE_FORMATS) + r")(?!\d)"
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def _date_kind(found: Column) -> dict[str, Column]:
    n = F.length(found)
    sep5, sep11 = F.substring(found, 5, 1), F.substring(found, 11, 1)
    return {
        "iso_t": (n == 19) & (sep11 == "T"),
        "iso_space": (n == 19) & (sep5 == "-"),
        "slashes": (n == 19) & (sep5 == "/"),
        "access_log": n == 20,
        "date_only": n == 10,
    }


def iso_of_found(found: Column) -> Column:
    """Straight to a time without zone: through an ISO text, never through a
    timestamp of the session's zone, where some wall-clock times do not exist."""
    kinds = _date_kind(found)
    month = F.lpad(((F.instr(F.lit(MONTHS), F.substring(found, 4, 3)) + 2) / 3).cast("int").cast("string"), 2, "0")
    access = F.concat(F.substring(found, 8, 4), F.lit("-"), month, F.lit("-"), F.substring(found, 1, 2),
                      F.lit(" "), F.substring(found, 13, 8))
    iso = (F.when(kinds["slashes"], F.translate(found, "/", "-"))
            .when(kinds["access_log"], access).when(F.length(found) > 0, found))
    return iso.try_cast("timestamp_ntz")


def event_time(line, bind: bool = False) -> Column:
    """First date in the line as ``timestamp_ntz`` (null if none).

    In a projection, whole-stage codegen evaluates the regex match once and
    shares it between the tests below.  A filter does not share it: when a
    predicate on this value is pushed down, the match would be recomputed
    for every reference.  ``bind=True`` binds the match to a lambda variable
    (``transform`` over a one-element array), so it runs once per row even
    inside a filter; use it for columns that range filters read.
    """
    found = F.regexp_extract(_c(line), DATE_PATTERN, 0)
    if bind:
        return F.element_at(F.transform(F.array(found), iso_of_found), 1)
    return iso_of_found(found)


def iso_text(time: Column) -> Column:
    """A whole-second ``timestamp_ntz`` as ``yyyy-MM-dd'T'HH:mm:ss`` (a format function would take
    it through the session's zone)."""
    return F.translate(time.cast("string"), " ", "T")


def detect_date(line) -> Column:
    """FN5: normalised ISO-8601 date string of the line, or null."""
    return iso_text(event_time(line))
