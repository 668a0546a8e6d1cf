"""Registered queries over the supplied tables, each with its SQL oracle.

Every query reads whole tables (``documents``, ``events``, ``pages``,
``conversations``) and turns them into the reference's inputs: a stored text
becomes a file of lines (path ``/<source>/<doc_id>``), an event becomes a
dated line or a keyed message.  The oracle strings are DuckDB SQL over the
same tables and compute the same result independently (window functions
for offsets, ``time_bucket`` for windows, etc.).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import (FILE_SCHEME_FULL, FILE_SCHEME_PREFIX, HDFS_SCHEME_FULL, HDFS_SCHEME_PREFIX, event_time,
                              iso_text, safe_name, strip_scheme_host)
from ..operators import counts, dates, documents, search
from ..sinks import writers
from ..sources.stored import explode_lines
from . import end_to_end

SEARCH_TERM = "the"
SEARCH_PREFIX = "me*"
RANGE_START = "2024-01-10 00:00:00"
RANGE_END = "2024-01-12 00:00:00"
FIRST_PAGE = 10


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table.  Its schema is read from the Parquet footers once per
    process and then declared, so later reads plan without a footer job."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


# --- inputs derived from the tables ------------------------------------------

def document_lines(spark: SparkSession, sf_dir: str, line_no: bool = False,
                   offsets: bool = True) -> DataFrame:
    """Attributed lines of ``documents``: source, doc_id, path, [line_no], [offset], line."""
    d = table(spark, sf_dir, "documents").select(
        "source", "doc_id", "text",
        F.concat(F.lit("/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("path"))
    return explode_lines(d, "text", keep=["source", "doc_id", "path"], line_no=line_no, offsets=offsets)


# Five URI spellings of one path, chosen per document, to exercise STR1/STR2.
URI_PREFIXES = ["hdfs://nameservice1:8020", "hdfs://namenode", "hdfs://", "file://", "file:"]


def _uri(doc_id, source):
    k = F.pmod(doc_id, F.lit(len(URI_PREFIXES)))
    prefix = F.element_at(F.array(*[F.lit(p) for p in URI_PREFIXES]), (k + 1).cast("int"))
    return F.concat(prefix, F.lit("/"), source, F.lit("/"), doc_id.cast("string"))


def _uri_sql(doc_id: str, source: str) -> str:
    arr = ", ".join(f"'{p}'" for p in URI_PREFIXES)
    return (f"([{arr}])[({doc_id} % {len(URI_PREFIXES)}) + 1] || '/' || {source} || '/' "
            f"|| CAST({doc_id} AS VARCHAR)")


def _event_line(ev: DataFrame) -> DataFrame:
    """Events as dated log lines; the date format depends on the event type,
    and sign-ups carry no date at all."""
    ts, et, props = F.col("ts"), F.col("event_type"), F.col("props")
    line = (F.when(et == "click", F.concat_ws(" ", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), et, props))
             .when(et == "view", F.concat_ws(" ", F.date_format(ts, "yyyy/MM/dd HH:mm:ss"), et, props))
             .when(et == "purchase", F.concat(F.lit("["), F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss"),
                                               F.lit("] "), et, F.lit(" "), props))
             .when(et == "error", F.concat_ws(" ", F.date_format(ts, "yyyy-MM-dd"), et, props))
             .otherwise(F.concat_ws(" ", et, props)))
    return ev.select(
        F.concat(F.lit("/events/"), F.col("user_id").cast("string")).alias("path"),
        F.col("event_id").alias("offset"), line.alias("line"))


EVENT_LINES_SQL = """
SELECT '/events/' || CAST(user_id AS VARCHAR) AS path, event_id AS "offset",
  CASE event_type
    WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || ' ' || event_type || ' ' || props
    WHEN 'view' THEN strftime(ts, '%Y/%m/%d %H:%M:%S') || ' ' || event_type || ' ' || props
    WHEN 'purchase' THEN '[' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || '] ' || event_type || ' ' || props
    WHEN 'error' THEN strftime(ts, '%Y-%m-%d') || ' ' || event_type || ' ' || props
    ELSE event_type || ' ' || props END AS line,
  CASE event_type
    WHEN 'error' THEN strftime(ts, '%Y-%m-%d') || 'T00:00:00'
    WHEN 'signup' THEN NULL
    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS date
FROM events
"""

DOC_LINES_SQL = """
WITH d AS (
  SELECT source, doc_id, '/' || source || '/' || CAST(doc_id AS VARCHAR) AS path,
         string_split(text, chr(10)) AS ls
  FROM documents WHERE text IS NOT NULL),
u AS (
  SELECT source, doc_id, path, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS k FROM d)
SELECT source, doc_id, path, k - 1 AS line_no,
       CAST(SUM(strlen(line) + 1) OVER (PARTITION BY doc_id ORDER BY k) - (strlen(line) + 1) AS BIGINT)
         AS "offset",
       line
FROM u
"""

WORDS_SQL = """CASE WHEN {l} = '' THEN ['']
     WHEN rtrim({l}, ' ') = '' THEN []::VARCHAR[]
     ELSE string_split(rtrim({l}, ' '), ' ') END"""

TOKENS_SQL = "list_filter(regexp_split_to_array(lower({l}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def _with(body: str, *ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n" + body


# --- the queries --------------------------------------------------------------

def q_lines_with_offset(spark, sf):
    """SRC3 + DOC1: every line of every document with its byte offset."""
    return documents.offset_documents(document_lines(spark, sf))


def q_lines_no_offset(spark, sf):
    """DOC2."""
    return documents.line_documents(document_lines(spark, sf, offsets=False))


def q_line_numbers(spark, sf):
    """ORD1 support: line number next to the offset."""
    return document_lines(spark, sf, line_no=True).select("path", "line_no", "offset")


def q_paths_stripped(spark, sf):
    """STR1 on five URI spellings, one per document."""
    d = table(spark, sf, "documents").select("doc_id", _uri(F.col("doc_id"), F.col("source")).alias("uri"))
    return d.select("doc_id", "uri", strip_scheme_host("uri").alias("path"))


def q_paths_prefix_stripped(spark, sf):
    """STR2 + DOC3: prefix-only stripping applied to every line's URI."""
    lines = document_lines(spark, sf).withColumn("path", _uri(F.col("doc_id"), F.col("source")))
    return documents.prefix_stripped_documents(lines)


def q_doc_json(spark, sf):
    """DOC8: JSON source of each document, field order path, offset, line."""
    docs = documents.offset_documents(document_lines(spark, sf))
    return docs.select("path", "offset", documents.json_source("path", "offset", "line").alias("source"))


def q_doc_map(spark, sf):
    """DOC4: map documents (date key only when a date was found), as key/value rows."""
    ev = documents.dated_documents(_event_line(table(spark, sf, "events")))
    # explode the map expression in place: exploding a named map column lets
    # the optimizer infer a "non-empty" filter that recomputes the whole map
    doc = documents.map_document(F.col("path"), F.col("line"), F.col("offset"), F.col("date"))
    return ev.select("path", "offset", F.explode(doc).alias("key", "value"))


def q_dated_lines(spark, sf):
    """FN5 + DOC5/DOC6: detected, normalised date per line (null if none)."""
    return documents.dated_documents(_event_line(table(spark, sf, "events")))


def q_date_range(spark, sf):
    """RET7: dated documents whose detected time is in [RANGE_START, RANGE_END]."""
    # output columns in codegen; the filter binds its one regex pass per row
    ev = documents.dated_documents(_event_line(table(spark, sf, "events")))
    return search.time_range(ev, RANGE_START, RANGE_END, event_time(F.col("line"), bind=True))


def _two_order_lines(ev: DataFrame) -> DataFrame:
    """Events as log lines of one file per user; half of the users write the day first, half the month."""
    day_first = F.col("user_id") % 2 == 0
    when = F.when(day_first, F.date_format("ts", "dd/MM/yyyy HH:mm:ss")).otherwise(F.date_format("ts", "MM/dd/yyyy HH:mm:ss"))
    return ev.select(F.concat(F.lit("/events/"), F.col("user_id").cast("string")).alias("path"), F.col("event_id").alias("offset"),
                     F.concat_ws(" ", when, "event_type", "props").alias("line"))


def q_dates_by_vote(spark, sf):
    """FN5: dates whose day and month are both numbers, read as the lines of their file vote."""
    lines = _two_order_lines(table(spark, sf, "events"))
    timed = dates.voted_time(lines, ["path"], dates.date_votes(lines, ["path"]))
    return timed.select("path", "offset", iso_text(F.col("event_time")).alias("date"), "line")


def q_stream_dated_lines(spark, sf):
    """DOC6/DOC7 stream shapes: message value -> {date, line}."""
    msgs = _event_line(table(spark, sf, "events")).select(F.col("line").alias("value"))
    return documents.stream_dated_line_documents(msgs)


def q_word_frequency(spark, sf):
    """STR3 + AGG4: occurrences per word over all document lines."""
    return counts.word_counts(document_lines(spark, sf, offsets=False))


def q_line_count(spark, sf):
    """AGG2 per source (lines counted per text, no row per line)."""
    return counts.text_line_totals(table(spark, sf, "documents"), by=["source"])


def q_word_count(spark, sf):
    """AGG3 per source."""
    return counts.batch_counts(document_lines(spark, sf, offsets=False), by=["source"]).select("source", "words")


def q_counts_per_10s(spark, sf):
    """STM6: lines and words per 10-second window (props as the line)."""
    return counts.windowed_counts(table(spark, sf, "events"), "ts", "props")


def q_words_per_10s(spark, sf):
    """AGG4 + STM6: per-word counts per 10-second window."""
    return counts.windowed_word_counts(table(spark, sf, "events"), "ts", "props")


def q_counts_zero_filled(spark, sf):
    """STM7: every 10-second window from first to last, idle ones as zero."""
    return counts.zero_filled_counts(table(spark, sf, "events"), "ts", "props")


def q_pair_text(spark, sf):
    """DOC10: ``(key,value)`` text of keyed messages; sign-ups have no key."""
    ev = table(spark, sf, "events")
    key = F.when(F.col("event_type") != "signup", F.col("user_id"))
    return ev.select("event_id", documents.pair_text(key, F.col("props")).alias("text"))


def q_safe_names(spark, sf):
    """STR4: file-safe names from page URLs."""
    return table(spark, sf, "pages").select("page_id", "url", safe_name("url").alias("name"))


def q_search_term(spark, sf):
    """RET4: lines that contain the token SEARCH_TERM."""
    return search.term_search(documents.offset_documents(document_lines(spark, sf)), SEARCH_TERM)


def q_search_prefix_me(spark, sf):
    """RET3: lines with a token starting with ``me``."""
    return search.prefix_search(documents.offset_documents(document_lines(spark, sf)), SEARCH_PREFIX)


def q_search_total(spark, sf):
    """RET1: match-all hit total per index (one index per source), without a row per line."""
    docs = table(spark, sf, "documents").withColumnRenamed("source", "index")
    return counts.text_line_totals(docs, by=["index"]).withColumnRenamed("lines", "total")


def q_first_page(spark, sf):
    """RET2 + ORD1: first page of 10 hits in (path, offset) order."""
    return search.first_page(documents.offset_documents(document_lines(spark, sf)), FIRST_PAGE)


def q_bulk_lines(spark, sf):
    """SNK1b + SNK6: bulk request lines (action + source) with deterministic ids."""
    docs = documents.offset_documents(document_lines(spark, sf))
    return writers.bulk_lines(docs, "docs", "line")


def q_conversation_lines(spark, sf):
    """Second line source: every conversation turn as a file of lines."""
    c = table(spark, sf, "conversations").select(
        F.concat(F.lit("/conversations/"), F.col("conv_id").cast("string"), F.lit("/"),
                 F.col("turn").cast("string")).alias("path"), "text")
    return explode_lines(c, "text", keep=["path"])


def q_words_per_role(spark, sf):
    """AGG2-AGG4 grouped by speaker role over conversation lines."""
    c = table(spark, sf, "conversations").select("role", "text")
    lines = explode_lines(c, "text", keep=["role"], offsets=False)
    return counts.word_counts(lines, by=["role"])


def q_python_builder(spark, sf):
    """UDF1, UDF2: a user's own Python document builder, one call per Arrow batch."""
    def with_length(frame):
        return frame[["path", "line"]].assign(n=frame["line"].str.len())

    documents.python_builder("line_length", with_length, "path string, line string, n bigint")
    return documents.to_documents(document_lines(spark, sf, offsets=False).select("path", "line"), "line_length")


def q_jvm_builder(spark, sf):
    """UDF1, UDF2: a document builder of JVM methods, named as text."""
    documents.jvm_builder("line_digest", {"path": "path", "line": "line",
                                          "sha1": ("org.apache.commons.codec.digest.DigestUtils", "sha1Hex", ("line",))})
    return documents.to_documents(document_lines(spark, sf, offsets=False).select("path", "line"), "line_digest")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lines_with_offset": q_lines_with_offset,
    "lines_no_offset": q_lines_no_offset,
    "line_numbers": q_line_numbers,
    "paths_stripped": q_paths_stripped,
    "paths_prefix_stripped": q_paths_prefix_stripped,
    "doc_json": q_doc_json,
    "doc_map": q_doc_map,
    "dated_lines": q_dated_lines,
    "date_range": q_date_range,
    "dates_by_vote": q_dates_by_vote,
    "stream_dated_lines": q_stream_dated_lines,
    "word_frequency": q_word_frequency,
    "line_count": q_line_count,
    "word_count": q_word_count,
    "counts_per_10s": q_counts_per_10s,
    "words_per_10s": q_words_per_10s,
    "counts_zero_filled": q_counts_zero_filled,
    "pair_text": q_pair_text,
    "safe_names": q_safe_names,
    "search_term": q_search_term,
    "search_prefix_me": q_search_prefix_me,
    "search_total": q_search_total,
    "first_page": q_first_page,
    "bulk_lines": q_bulk_lines,
    "conversation_lines": q_conversation_lines,
    "words_per_role": q_words_per_role,
    "python_builder": q_python_builder,
    "jvm_builder": q_jvm_builder,
    **end_to_end.QUERIES,
}


_W = WORDS_SQL.format(l="line")
_TOK = TOKENS_SQL.format(l="line")
_STRIP1 = f"regexp_replace(regexp_replace({{p}}, '{FILE_SCHEME_FULL}', '/'), '{HDFS_SCHEME_FULL}', '/')"
_STRIP2 = f"regexp_replace(regexp_replace({{p}}, '{FILE_SCHEME_PREFIX}', ''), '{HDFS_SCHEME_PREFIX}', '')"
_DATED = "SELECT path, \"offset\", date, line FROM ev"
_CONV_LINES = """
WITH d AS (
  SELECT '/conversations/' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS path,
         role, string_split(text, chr(10)) AS ls FROM conversations WHERE text IS NOT NULL),
u AS (SELECT path, role, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS k FROM d)
"""

ORACLE_SQL: dict[str, str] = {
    "lines_with_offset": _with('SELECT path, "offset", line FROM l', ("l", DOC_LINES_SQL)),
    "lines_no_offset": _with("SELECT path, line FROM l", ("l", DOC_LINES_SQL)),
    "line_numbers": _with('SELECT path, line_no, "offset" FROM l', ("l", DOC_LINES_SQL)),
    "paths_stripped": (
        f"SELECT doc_id, {_uri_sql('doc_id', 'source')} AS uri, "
        f"{_STRIP1.format(p=_uri_sql('doc_id', 'source'))} AS path FROM documents"),
    "paths_prefix_stripped": _with(
        f"SELECT {_STRIP2.format(p=_uri_sql('doc_id', 'source'))} AS path, \"offset\", line FROM l",
        ("l", DOC_LINES_SQL)),
    "doc_json": _with(
        "SELECT path, \"offset\", json_object('path', path, 'offset', \"offset\", 'line', line) AS source FROM l",
        ("l", DOC_LINES_SQL)),
    "doc_map": _with(
        "SELECT path, \"offset\", 'path' AS key, path AS value FROM ev UNION ALL "
        "SELECT path, \"offset\", 'line', line FROM ev UNION ALL "
        "SELECT path, \"offset\", 'offset', CAST(\"offset\" AS VARCHAR) FROM ev WHERE \"offset\" > -1 UNION ALL "
        "SELECT path, \"offset\", 'date', date FROM ev WHERE date IS NOT NULL",
        ("ev", EVENT_LINES_SQL)),
    "dated_lines": _with(_DATED, ("ev", EVENT_LINES_SQL)),
    "date_range": _with(
        _DATED + f" WHERE CAST(date AS TIMESTAMP) BETWEEN TIMESTAMP '{RANGE_START}' "
                 f"AND TIMESTAMP '{RANGE_END}'",
        ("ev", EVENT_LINES_SQL)),
    "stream_dated_lines": _with("SELECT date, line FROM ev", ("ev", EVENT_LINES_SQL)),
    "word_frequency": _with(
        f"SELECT word, count(*) AS n FROM (SELECT unnest({_W}) AS word FROM l) GROUP BY word",
        ("l", DOC_LINES_SQL)),
    "line_count": _with("SELECT source, count(*) AS lines FROM l GROUP BY source", ("l", DOC_LINES_SQL)),
    "word_count": _with(
        f"SELECT source, CAST(sum(len({_W})) AS BIGINT) AS words FROM l GROUP BY source",
        ("l", DOC_LINES_SQL)),
    "counts_per_10s": (
        "SELECT time_bucket(INTERVAL '10 seconds', ts) AS window_start, "
        "time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds' AS window_end, "
        f"count(*) AS lines, CAST(sum(len({WORDS_SQL.format(l='props')})) AS BIGINT) AS words "
        "FROM events GROUP BY 1, 2"),
    "words_per_10s": (
        "SELECT window_start, window_start + INTERVAL '10 seconds' AS window_end, word, count(*) AS n FROM ("
        "SELECT time_bucket(INTERVAL '10 seconds', ts) AS window_start, "
        f"unnest({WORDS_SQL.format(l='props')}) AS word FROM events) GROUP BY 1, 2, 3"),
    "counts_zero_filled": _with(
        "SELECT g.window_start, g.window_start + INTERVAL '10 seconds' AS window_end, "
        "coalesce(c.lines, 0) AS lines, coalesce(c.words, 0) AS words "
        "FROM (SELECT unnest(generate_series(lo, hi, INTERVAL '10 seconds')) AS window_start FROM b) g "
        "LEFT JOIN c ON g.window_start = c.window_start",
        ("c", "SELECT time_bucket(INTERVAL '10 seconds', ts) AS window_start, count(*) AS lines, "
              f"CAST(sum(len({WORDS_SQL.format(l='props')})) AS BIGINT) AS words FROM events GROUP BY 1"),
        ("b", "SELECT min(window_start) AS lo, max(window_start) AS hi FROM c")),
    "pair_text": (
        "SELECT event_id, '(' || coalesce(CASE WHEN event_type <> 'signup' THEN CAST(user_id AS VARCHAR) END, 'null') "
        "|| ',' || coalesce(props, 'null') || ')' AS text FROM events"),
    "safe_names": "SELECT page_id, url, regexp_replace(url, '[^A-Za-z0-9_-]', '_', 'g') AS name FROM pages",
    "search_term": _with(
        f"SELECT path, \"offset\", line FROM l WHERE list_contains({_TOK}, '{SEARCH_TERM}')",
        ("l", DOC_LINES_SQL)),
    "search_prefix_me": _with(
        f"SELECT path, \"offset\", line FROM l WHERE len(list_filter({_TOK}, lambda t: starts_with(t, 'me'))) > 0",
        ("l", DOC_LINES_SQL)),
    "search_total": _with("SELECT source AS index, count(*) AS total FROM l GROUP BY source",
                          ("l", DOC_LINES_SQL)),
    "first_page": _with(f'SELECT path, "offset", line FROM l ORDER BY path, "offset" LIMIT {FIRST_PAGE}',
                        ("l", DOC_LINES_SQL)),
    "bulk_lines": _with(
        "SELECT value FROM ("
        "SELECT json_object('index', json_object('_index', 'docs', '_type', 'line', '_id', "
        "sha256(path || chr(0) || CAST(\"offset\" AS VARCHAR)))) AS value FROM l UNION ALL "
        "SELECT json_object('path', path, 'offset', \"offset\", 'line', line) FROM l)",
        ("l", DOC_LINES_SQL)),
    "conversation_lines": _CONV_LINES + (
        'SELECT path, CAST(SUM(strlen(line) + 1) OVER (PARTITION BY path ORDER BY k) - (strlen(line) + 1) '
        'AS BIGINT) AS "offset", line FROM u'),
    "words_per_role": _CONV_LINES + (
        f"SELECT role, word, count(*) AS n FROM (SELECT role, unnest({_W}) AS word FROM u) GROUP BY role, word"),
}

ORACLE_SQL["python_builder"] = _with("SELECT path, line, length(line) AS n FROM l", ("l", DOC_LINES_SQL))
ORACLE_SQL["jvm_builder"] = _with("SELECT path, line, sha1(line) AS sha1 FROM l", ("l", DOC_LINES_SQL))
ORACLE_SQL |= end_to_end.oracle_sql(DOC_LINES_SQL, EVENT_LINES_SQL, _W)
ORACLE_SQL["live_zero_filled"] = ORACLE_SQL["counts_zero_filled"]
ORACLE_SQL["dates_by_vote"] = """
WITH l AS (
  SELECT '/events/' || CAST(user_id AS VARCHAR) AS path, event_id AS "offset",
    concat_ws(' ', CASE WHEN user_id % 2 = 0 THEN strftime(ts, '%d/%m/%Y %H:%M:%S') ELSE strftime(ts, '%m/%d/%Y %H:%M:%S') END,
              event_type, props) AS line FROM events),
a AS (SELECT *, CAST(substr(line, 1, 2) AS INT) AS x, CAST(substr(line, 4, 2) AS INT) AS y FROM l),
v AS (SELECT path, sum(CASE WHEN x > 12 THEN 1 WHEN y > 12 THEN -1 ELSE 0 END) AS margin FROM a GROUP BY path),
o AS (SELECT a.*, CASE WHEN x > 12 THEN true WHEN y > 12 THEN false ELSE margin >= 0 END AS day_first FROM a JOIN v USING (path))
SELECT path, "offset", substr(line, 7, 4) || '-' || CASE WHEN day_first THEN substr(line, 4, 2) || '-' || substr(line, 1, 2)
       ELSE substr(line, 1, 2) || '-' || substr(line, 4, 2) END || 'T' || substr(line, 12, 8) AS date, line FROM o
"""
ORACLE_SQL["search_term_stored"] = ORACLE_SQL["search_term"]
ORACLE_SQL["search_prefix_stored"] = ORACLE_SQL["search_prefix_me"]
ORACLE_SQL["lines_in_file_order"] = _with('SELECT path, line_no, "offset", line FROM l', ("l", DOC_LINES_SQL))
