"""DuckDB SQL that gives the rows of the operators' queries, by plain definitions.

What can't be put in SQL (token ids, packing, models) or would join all windows of all texts
(suffix dedup) has none; tests/llm holds those queries against brute force.
"""

from __future__ import annotations

from flotilla.llm.line_dedup import OP9_SQL
from flotilla.llm.vector_codes import op13_sql

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

OP2_SQL = rf"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item, least(10, len(words)) AS size, array_to_string(list_slice(words, place, place + 9), ' ') AS win
  FROM (SELECT item, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS place FROM item_words WHERE len(words) > 0)
), doc_lists AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), doc_words AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM doc_lists
), ahead AS (
  SELECT doc_id, pos, list(word) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS nxt
  FROM doc_words
), sizes AS (
  SELECT DISTINCT size FROM item_windows
), found AS (
  SELECT doc_id, pos, a.size, item
  FROM (SELECT doc_id, pos, size, array_to_string(list_slice(nxt, 1, size), ' ') AS win FROM ahead, sizes WHERE len(nxt) >= size) a
  JOIN item_windows w ON a.win = w.win AND a.size = w.size
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_lists d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP5_SQL = rf"""
WITH RECURSIVE lists AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, place, place + 2), ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 2) + 1)) AS place FROM lists WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
  WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""

OP6_SQL = r"""
WITH lists AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), word_rows AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM lists
), windows AS (
  SELECT doc_id, pos, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w AS win
  FROM word_rows WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), again AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows WHERE win IS NOT NULL)
  WHERE n > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(pos, pos + 3)) AS place FROM again) GROUP BY doc_id
), line_rows AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM lists
), dup_lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM line_rows WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), measured AS (
  SELECT l.doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(d.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM lists l LEFT JOIN repeated r USING (doc_id) LEFT JOIN dup_lines d USING (doc_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
), hosts AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE base_failed) AS DOUBLE) AS f FROM judged GROUP BY source
), moments AS (
  SELECT sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) AS square, count(*) / sum(n) AS per_row FROM hosts
), prior AS (
  SELECT mean, greatest(0, square - mean * mean - mean * (1 - mean) * per_row) AS between_hosts FROM moments
), weights AS (
  SELECT mean, CASE WHEN between_hosts > 0 THEN least(1e6, greatest(1, mean * (1 - mean) / between_hosts - 1)) ELSE 1e6 END AS weight
  FROM prior
), verdicts AS (
  SELECT source, (f + mean * weight) / (n + weight) <= 0.8 AS host_ok FROM hosts, weights
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_ok AS kept
FROM judged j JOIN verdicts v ON j.source IS NOT DISTINCT FROM v.source
"""

ORACLES = {
    "op2_decontaminate": OP2_SQL,
    "op5_near_duplicates": OP5_SQL,
    "op6_quality": OP6_SQL,
    "op9_line_dedup": OP9_SQL,
    "op13_vector_codes": op13_sql(),
}
