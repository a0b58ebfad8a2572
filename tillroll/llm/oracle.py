"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM rep, range(0, 5) r(k) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper,
         CAST(length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS BIGINT) AS n_letters,
         CAST(len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS BIGINT) AS n_echo_words
  FROM d LEFT JOIN cov c ON c.doc_id = d.doc_id),
b AS (
  SELECT *, CAST(
    CASE WHEN n_words < 10 THEN 1 ELSE 0 END
  + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
  + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END
  + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
  + CASE WHEN word_chars > 20 * n_words THEN 16 ELSE 0 END
  + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 32 ELSE 0 END
  + CASE WHEN 2 * n_upper > n_letters AND n_letters > 0 THEN 64 ELSE 0 END
  + CASE WHEN 100 * n_echo_words > 30 * n_words THEN 128 ELSE 0 END AS BIGINT) AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, n_lines, fail_bits
FROM b
"""

OP5 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
hits AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

# the length of the formatted text follows from the template: fixed marks of 8
# characters each around role and content, one backslash per control string
OP9 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, 24 + length(role) + length(text) + len(regexp_extract_all(text,
    '[<\[]\\*(?:\|turn\|>|\|says\|>|\|done\|>|\|image\|>|\|audio\|>|\|document\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|startoftext\|>|s>|/s>|INST\]|/INST\])')) AS c
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(c) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(len(t)) AS BIGINT) AS nt FROM d WHERE len(t) > 0),
q AS (
  SELECT item_id, term, CAST(count(*) AS BIGINT) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, term),
v AS (SELECT DISTINCT term FROM q),
f AS (
  SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(t) AS term FROM d) u
  WHERE term IN (SELECT term FROM v) GROUP BY r, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term, nd),
c AS (
  SELECT f.r, d.doc_id, f.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(t) * nd) // nt))) AS p
  FROM f JOIN d ON d.r = f.r JOIN w ON w.term = f.term, s),
x AS (
  SELECT item_id, r, doc_id, CAST(sum(times * p) AS BIGINT) AS score FROM c JOIN q ON q.term = c.term
  WHERE doc_id IS NOT NULL GROUP BY item_id, r, doc_id HAVING sum(times * p) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x) WHERE rank <= 20
"""

ORACLE = {"op12_lexical_search": OP12, "op9_chat_format": OP9, "op1_quality_rules": OP1, "op5_decontamination": OP5}
