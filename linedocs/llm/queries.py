"""Registered queries of the operators, each with its oracle where SQL has one."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, linededup, lmscore, mixing, phrases, quality, repair, secrets, simhash, tokens, urlfilter, warc
from .common import table

#: Name of the vocabulary file; its folder is that of the installed package.
VOCABULARY = "word_bpe_49k.json"

#: host, path, verdict
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]

#: The conversation whose texts hold the template's own strings.
PROBE = (-7, "\\### Assistant: </turn> ok")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(spark, docs, public_tokenizers.path(VOCABULARY)).drop("text")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixing.placements(spark, table(spark, sf_dir, "documents"))
    return placed.select(F.col("__id").alias("doc_id"), "source", "n_tokens", "weight", "epoch", "place", "block")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many went, which ranges, and the text that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long"))
    out = linededup.dedup_lines(spark, docs)
    gone = F.coalesce("_gone", F.array().cast("array<struct<from:int,to:int>>"))
    return out.select(
        "doc_id", "n_lines",
        F.aggregate(gone, F.lit(0).cast("long"), lambda n, g: n + g["to"] - g["from"] + 1).alias("n_deleted"),
        F.array_join(F.transform(gone, lambda g: F.concat_ws("-", g["from"], g["to"])), ",").alias("deleted"), "text")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(spark, pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.decontaminate(spark, docs, table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "_scan.n_words", "_scan.n_hit", F.size("_scan.item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("_scan.item_ids", ","), 256).alias("items_sha256"),
                        (F.col("_scan.n_hit") > 0).alias("contaminated"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE[0], 0, "user", PROBE[1]), (PROBE[0], 1, "assistant", PROBE[1])], rows.schema)
    turns = rows.unionByName(probe).withColumn("parts", chat.text_part(F.col("text")))
    return chat.read_back(chat.format_turns(turns))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(spark, table(spark, sf_dir, "documents"), ["doc_id"])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    return judged.select("doc_id", *[f"__f.{c}" for c in quality.COUNTS], "base_failed", "kept")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(spark, table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_warc(spark, table(spark, sf_dir, "pages"))
    return warc.page_records(warc.read_warc(spark, files))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repair(spark, repair.damaged(rows), conversations=rows)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(spark, table(spark, sf_dir, "documents"), min_count=10, inside_percent=50, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_simhash, op3_mixing, op4_line_dedup, op5_url_filter, op6_decontamination,
                            op7_chat_format, op8_secret_scan, op9_quality_rules, op10_lm_score, op11_warc,
                            op12_conversation_repair, op13_phrases)
}

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op5_url_filter"] = r"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(rhost, rpath, verdict) AS (VALUES """ + ", ".join(map(str, URL_RULES)) + r"""),
fit AS (
  SELECT page_id, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS k
  FROM h JOIN rules ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM h LEFT JOIN (SELECT * FROM fit WHERE k = 1) USING (page_id)
"""

ORACLE_SQL["op6_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bs AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS t FROM bs),
sizes AS (SELECT DISTINCT n FROM win),
ds AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT r, s, win.n AS n, item_id FROM (SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS t FROM ds) x
        JOIN win ON x.n = win.n AND x.t = win.t),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

ORACLE_SQL["op7_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (
  SELECT *, '<turn role=' || replace(replace(replace(role, '\', '\\'), '<', '\<'), '>', '\>') || '>' || chr(10)
         || replace(replace(text, '\', '\\'), '<', '\<') || '</turn>' || chr(10) AS formatted FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, formatted)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, formatted), '')) AS loss_sha256,
       CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

ORACLE_SQL["op4_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq, sum(n) OVER (PARTITION BY doc_id ORDER BY pos) AS upto
      FROM w WHERE n > 0),
pairs AS (SELECT x.doc_id, x.seq AS a, y.seq AS b FROM s x JOIN s y ON x.doc_id = y.doc_id AND y.seq >= x.seq AND y.upto - x.upto + x.n >= 50),
runs AS (SELECT doc_id, a, min(b) AS b FROM pairs GROUP BY doc_id, a UNION SELECT doc_id, max(a), b FROM pairs GROUP BY doc_id, b),
named AS (SELECT r.doc_id, r.a, r.b, string_agg(line, chr(10) ORDER BY seq) AS name
          FROM runs r JOIN s ON s.doc_id = r.doc_id AND s.seq BETWEEN r.a AND r.b GROUP BY r.doc_id, r.a, r.b),
placed AS (SELECT *, first_value(doc_id) OVER p AS fd, first_value(a) OVER p AS fa FROM named WINDOW p AS (PARTITION BY name ORDER BY doc_id, a)),
gone AS (SELECT DISTINCT p.doc_id, s.seq, s.pos FROM placed p JOIN s ON s.doc_id = p.doc_id AND s.seq BETWEEN p.a AND p.b
         WHERE p.doc_id <> p.fd OR p.a > p.fa + p.b - p.a),
ranges AS (SELECT doc_id, min(pos) AS f, max(pos) AS t
           FROM (SELECT *, seq - row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS k FROM gone) GROUP BY doc_id, k),
per AS (SELECT doc_id, sum(t - f + 1) AS n_deleted, string_agg(f || '-' || t, ',' ORDER BY f) AS deleted FROM ranges GROUP BY doc_id),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM l LEFT JOIN ranges r ON l.doc_id = r.doc_id AND pos BETWEEN f AND t
         WHERE f IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_deleted, 0) AS BIGINT) AS n_deleted, coalesce(deleted, '') AS deleted,
       CASE WHEN n_deleted IS NULL THEN d.text ELSE coalesce(kept.text, '') END AS text
FROM documents d LEFT JOIN per USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLE_SQL["op11_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(hex, 10 * CAST(i // 8 AS INT) + 1, 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INT)) & 31 AS INT), 1)), '') AS payload_digest,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""

ORACLE_SQL["op13_phrases"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS s FROM w, (VALUES (1), (2), (3)) t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, w[s:s + k - 1] AS gram, CAST(count(*) AS HUGEINT) AS a FROM g GROUP BY ALL),
total AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE k > 1 AND a >= 10),
longer AS (SELECT lang, gram, max(a) AS a FROM (
  SELECT lang, gram[1:2] AS gram, a FROM cand WHERE k = 3 UNION ALL SELECT lang, gram[2:3], a FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (SELECT c.* FROM cand c LEFT JOIN longer o ON c.lang = o.lang AND c.gram = o.gram WHERE o.a IS NULL OR 100 * o.a < 50 * c.a),
cuts AS (SELECT lang, gram, a, unnest(range(1, k)) AS cut FROM kept),
scored AS (
  SELECT c.lang, c.gram, c.a, c.cut, x.a AS l, y.a AS r, (1000000 * c.a * c.a) // (x.a * y.a) AS score FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.gram = c.gram[1:c.cut] JOIN f y ON y.lang = c.lang AND y.gram = c.gram[c.cut + 1:len(c.gram)]),
worst AS (SELECT *, array_to_string(gram, ' ') AS phrase, row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) AS i FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst WHERE i = 1)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


def _edited(value: str, cost: int, edit: str) -> str:
    """SQL: a (cost, audit) string of 12 digits and edits, with one more edit."""
    return f"(lpad(CAST(CAST(substr({value}, 1, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || substr({value}, 13) || '{edit}')"


def _kept(value: str, initial: str) -> str:
    """SQL: ``value`` with the row kept, or with it reroled to the same state; null if it must go."""
    add = "(CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END)"
    keep = f"CASE WHEN initial = '{initial}' THEN {_edited(value, add, 'K')} END"
    return f"CASE WHEN coalesce(fault, '') NOT IN ('blank', 'duplicate') THEN least({keep}, {_edited(value, f'(1 + {add})', 'R')}) END"


# the least (cost, audit) to each state, row by row
ORACLE_SQL["op12_conversation_repair"] = rf"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY c) AS t FROM (SELECT c, list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(c))),
h AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda x: CAST(ascii(x) AS BIGINT))), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 20 AS dmg
  FROM conversations, crc),
d AS (
  SELECT coalesce('=' || conv_id, '') AS k, turn, CASE WHEN dmg = 4 THEN 'user' ELSE role END AS role,
    CASE dmg WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN dmg = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE dmg <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text, copy) AS i, substr(role, 1, 1) AS initial FROM d),
f AS (
  SELECT *, lag(initial) OVER (PARTITION BY k ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
         WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'duplicate'
         WHEN regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM o),
w(k, i, s0, s1, s2, s3) AS (
  SELECT DISTINCT k, CAST(0 AS BIGINT), '000000000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM f
  UNION ALL
  SELECT k, i, {_edited('s0', 2, 'D')},
    least({_edited('s1', 2, 'D')}, CASE WHEN coalesce(fault, '') NOT IN ('blank', 'duplicate') AND initial = 's'
                                   THEN {_edited('s0', "(CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END)", 'K')} END),
    least({_edited('e2', 2, 'D')}, {_kept('s0', 'u')}, {_kept('s1', 'u')}, {_kept('e3', 'u')}),
    least({_edited('e3', 2, 'D')}, {_kept('e2', 'a')})
  FROM (SELECT *, least(s3, {_edited('e2', 5, 'I')}) AS e3
        FROM (SELECT w.k, f.i, f.initial, f.fault, s0, s1, s2, s3, least(s2, {_edited('s0', 5, 'I')}, {_edited('s1', 5, 'I')}, {_edited('s3', 5, 'I')}) AS e2
              FROM w JOIN f ON f.k = w.k AND f.i = w.i + 1))),
last AS (
  SELECT k, least(s0, s3, {_edited('s2', 5, 'I')}, {_edited('s1', 10, 'II')}) AS best
  FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY i DESC) = 1),
a AS (SELECT k, CAST(substr(best, 1, 12) AS BIGINT) AS cost, substr(best, 13) AS audit FROM last),
e AS (SELECT k, unnest(string_split(audit, '')) AS edit, unnest(range(1, length(audit) + 1)) AS j FROM a WHERE audit <> ''),
n AS (SELECT *, CASE WHEN edit <> 'I' THEN count(*) FILTER (edit <> 'I') OVER (PARTITION BY k ORDER BY j) END AS i,
        count(*) FILTER (edit <> 'D') OVER (PARTITION BY k ORDER BY j) AS m FROM e),
x AS (SELECT n.*, f.role, f.text, max(CASE WHEN edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY n.k) AS has_s
      FROM n LEFT JOIN f ON f.k = n.k AND f.i = n.i),
r AS (SELECT k, string_agg(CASE WHEN edit = 'K' THEN role WHEN (m - has_s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS t
      FROM x WHERE edit <> 'D' GROUP BY k),
g AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY k),
c AS (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS k FROM conversations)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM c LEFT JOIN g USING (k) LEFT JOIN a USING (k) LEFT JOIN r USING (k)
"""
