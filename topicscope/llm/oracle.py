"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

# words [^\x20\x09-\x0D]+ ; \n-split lines; 5-word windows found twice or more
_OP5 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), g AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM (
    SELECT rid, i, array_to_string(ws[i:i+4], ' ') AS k
    FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5))
), s AS (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nx FROM g WHERE c > 1
), r AS (
  SELECT rid, sum(least(coalesce(nx - i, 5), 5)) AS n FROM s GROUP BY rid
), m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(ls) AS BIGINT) AS n_lines,
         length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_marks
  FROM w LEFT JOIN r USING (rid)
), f AS (
  SELECT *, n_words < 10 AS b0, 100 * n_repeat_words > 20 * n_words AS b1,
         10 * n_symbols > n_words AS b2, 2 * n_dup_lines > n_lines AS b3,
         word_chars < 2 * n_words OR word_chars > 15 * n_words AS b4,
         10 * n_upper > 3 * word_chars AS b5, 10 * n_marks > n_words AS b6
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       b0 OR b1 AS base_failed, NOT (b0 OR b1 OR b2 OR b3 OR b4 OR b5 OR b6) AS kept,
       CAST(b0::INT + 2 * b1::INT + 4 * b2::INT + 8 * b3::INT + 16 * b4::INT + 32 * b5::INT
            + 64 * b6::INT AS BIGINT) AS failures
FROM f
"""

# prefix-target expansion; escaping adds one character per backslash and control string
_OP6 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), s AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
         count(*) OVER (PARTITION BY conv_id) AS n,
         length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
           + len(regexp_extract_all(text, '</?s>|\[/?INST\]'))
           + CASE WHEN role = 'assistant' THEN 7 ELSE 14 + length(role) END AS size
  FROM c
), e AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY p) AS upto FROM s
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY p)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY p) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR p = n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

# windows of 13 words (shorter items whole); a document word inside a window is hit
_OP10 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), bw AS (
  SELECT DISTINCT item, least(len(ws), 13) AS n, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS k
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), sizes AS (
  SELECT DISTINCT n FROM bw
), dw AS (
  SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS k
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n)
), h AS (
  SELECT rid, i, dw.n, item FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n
), hit AS (
  SELECT rid, count(*) AS n_hit FROM (
    SELECT DISTINCT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM h))
  GROUP BY rid
), it AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""

ORACLE_SQL = {
    "op5_quality_rules": _OP5,
    "op6_chat_formatting": _OP6,
    "op10_decontamination": _OP10,
}
