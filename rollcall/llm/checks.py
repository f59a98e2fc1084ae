"""Check SQL of the queries that SQL can express, for DuckDB."""

from rollcall.llm.quality import FURNITURE, MAX_LOST, MIN_WORDS, SHORT
from rollcall.llm.secret_scan import RULES

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP1 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)
), often AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM often) GROUP BY doc_id
), lines AS (
  SELECT doc_id, l, string_split(l, '') AS cs, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), ruled AS (
  SELECT doc_id, l, CASE
    WHEN NOT regexp_matches(l, '[.!?…。！？:;]["''”’)»\]]*(\s|$)') OR (runs * 4 >= n AND runs >= 3) THEN 'punctuation'
    WHEN parts >= 4 AND n <= parts * 4 THEN 'navigation'
    WHEN n < {SHORT} AND regexp_matches(lower(l), '{'|'.join(FURNITURE)}') THEN 'boilerplate' END AS rule
  FROM (SELECT *, len(list_filter(range(2, len(cs) + 1), lambda i: cs[i] = cs[i - 1] AND (i = 2 OR cs[i - 2] <> cs[i])
                  AND regexp_matches(cs[i], '[^\p{{L}}\p{{N}}\s]'))) AS runs,
               len(regexp_extract_all(regexp_replace(l, '\s', '  ', 'g') || ' ', '\s[|»›•·>]+\s')) + 1 AS parts FROM lines)
), judged AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS dup, sum(length(l)) AS chars,
         coalesce(sum(length(l)) FILTER (rule IS NULL), 0) AS kept_chars FROM ruled GROUP BY doc_id
), counted AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, coalesce(chars, 0) AS chars, coalesce(kept_chars, 0) AS kept_chars
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN judged USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)
         AND kept_chars >= {1 - MAX_LOST} * chars AND kept_chars > 0 AS kept
FROM counted
"""

OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
first AS (SELECT h, min(page_id) AS original FROM p GROUP BY h)
SELECT page_id, strlen(h) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
         ((CAST('0x' || substr(d, CAST(i // 4 * 5 + 1 AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM p JOIN first USING (h)
"""

# DuckDB's patterns cannot look behind, so inside a run of a token's characters "eyJ" is first
# written over (twice, as matches do not overlap); what stands there is still of the run.
_RUN = "[A-Za-z0-9_-]"
_NO_INNER = f"regexp_replace(regexp_replace(t, '({_RUN})eyJ', '\\1zzz', 'g'), '({_RUN})eyJ', '\\1zzz', 'g')"
_TOKEN = rf"eyJ{_RUN}{{8,}}\.eyJ{_RUN}{{8,}}\.{_RUN}+"


def _matches(no: int, rule) -> str:
    text, pattern = (_NO_INNER, _TOKEN) if rule.kind == "jwt" else ("t", rule.pattern.replace("'", "''"))
    return f"""SELECT doc_id, {no} AS no, '{rule.kind}' AS kind, {rule.least} AS least, unnest(range(1, len(m) + 1)) AS i, g, m, v FROM (
    SELECT doc_id, string_split_regex({text}, '{pattern}') AS g, regexp_extract_all({text}, '{pattern}') AS m,
           regexp_extract_all({text}, '{pattern}', {rule.value}) AS v FROM d)"""


_SPANS = " UNION ALL ".join(_matches(no, r) for no, r in enumerate(RULES))
_JOINED = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no){0}, '')"
_BASE = " FILTER (no < 3)"
OP6 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_SPANS}),
placed AS (
  SELECT doc_id, no, kind, least, length(v[i]) AS size, length(m[i]) AS n,
         sum(length(g[i]) + length(m[i])) OVER (PARTITION BY doc_id, no ORDER BY i) AS stop FROM found
), held AS (SELECT doc_id, no, kind, CAST(stop - n AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM placed WHERE size >= least)
SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex, sha256({_JOINED.format(_BASE)}) AS base_sha256, {_JOINED.format('')} AS spans
FROM d LEFT JOIN held USING (doc_id) GROUP BY doc_id
"""

OP7 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{ALNUM}') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER}, '{ALNUM}') AS ws FROM benchmark),
grams AS (
  SELECT DISTINCT item, size, array_to_string(ws[i : i + size - 1], ' ') AS gram
  FROM (SELECT item, ws, least(len(ws), 13) AS size, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), places AS (
  SELECT doc_id, size, i, array_to_string(ws[i : i + size - 1], ' ') AS gram
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM grams))
), hits AS (SELECT doc_id, i, size, item FROM places JOIN grams USING (size, gram)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
OP8 = rf"""
WITH p AS (SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INT) AS fetched, {_HOST} AS host FROM pages),
h AS (SELECT host, CAST('0x' || substr(md5(host), 1, 4) AS INT) AS h, regexp_extract(host, '([^.]*[.])?[^.]*$') AS parent
      FROM (SELECT DISTINCT host FROM p WHERE host <> '')),
entries AS (
  SELECT 'hosts' AS list, host AS key, 'block' AS action, h % 200 AS day FROM h WHERE h % 3 = 0
  UNION ALL SELECT 'hosts', host, 'remove', h % 200 + 90 FROM h WHERE h % 3 = 0
  UNION ALL SELECT 'hosts', host, 'block', h % 200 + 120 FROM h WHERE h % 6 = 0
  UNION ALL SELECT 'paths', host || '/en', 'block', 50 + h % 50 FROM h WHERE h % 4 = 1
  UNION ALL SELECT 'paths', host || '/de', 'allow', 100 FROM h WHERE h % 5 = 0
  UNION ALL SELECT 'domains', parent, 'block', h % 300 FROM h WHERE h % 7 = 0
  UNION ALL SELECT 'domains', parent, 'remove', h % 300 FROM h WHERE h % 7 = 1
), daily AS (
  SELECT list, key, DATE '2024-01-01' + CAST(day AS INT) AS since,
         arg_min(action, CASE action WHEN 'allow' THEN 1 WHEN 'block' THEN 2 ELSE 3 END) AS action
  FROM entries GROUP BY list, key, day
), parts AS (
  SELECT *, string_split(host, '.') AS ls,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1), '/'), lambda x: x <> '') AS ps FROM p WHERE host <> ''
), keys AS (
  SELECT DISTINCT page_id, fetched, unnest(list_concat(
    list_transform(range(1, len(ls) + 1), lambda i: array_to_string(ls[i:], '.')),
    list_transform(range(1, least(len(ps), 2) + 1), lambda i: host || '/' || array_to_string(ps[1:i], '/')))) AS key FROM parts
), active AS (
  SELECT page_id, k.key, arg_max(d.action, d.since) AS action FROM keys k JOIN daily d ON k.key = d.key AND d.since <= k.fetched
  GROUP BY page_id, k.key, d.list HAVING arg_max(d.action, d.since) <> 'remove'
), decided AS (
  SELECT page_id, count(*) AS n, arg_max(key, (length(key), CASE action WHEN 'allow' THEN 1 ELSE 0 END, key)) AS key,
         arg_max(action, (length(key), CASE action WHEN 'allow' THEN 1 ELSE 0 END, key)) AS action FROM active GROUP BY page_id
)
SELECT page_id, url, fetched, coalesce(n, 0) AS n_active, key AS decided_by, coalesce(action = 'block', false) AS blocked
FROM p LEFT JOIN decided USING (page_id)
"""

CHECKS = {"op1_quality": OP1, "op5_warc": OP5, "op6_secrets": OP6, "op7_decontamination": OP7, "op8_url_filters": OP8}
