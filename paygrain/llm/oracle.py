"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

GAP = r"[\x20\x09-\x0D]+"

ORACLE: dict[str, str] = {}

ORACLE["op2_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '{GAP}'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS full_lines
  FROM d
), placed AS (
  SELECT r, unnest(words) AS a, unnest(range(len(words))) AS i FROM w
), win AS (
  SELECT r, i, a || ' ' || lead(a) OVER o || ' ' || lead(a, 2) OVER o AS three
  FROM placed WINDOW o AS (PARTITION BY r ORDER BY i)
), twice AS (
  SELECT r, i FROM win WHERE three IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, three) > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), f AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(full_lines) - len(list_distinct(full_lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(full_lines) AS n_lines,
         length(regexp_replace(t, '\P{{Lu}}', '', 'g')) AS n_capitals,
         length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digits,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclamations
  FROM w LEFT JOIN covered c USING (r)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 20 * n_symbols > word_chars OR 10 * n_capitals > 4 * word_chars
            OR 5 * n_exclamations > n_words OR 2 * n_digits > word_chars
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words
            OR 10 * n_dup_lines > 5 * n_lines) AS kept
FROM b
"""

ORACLE["op3_line_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), held AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT k.*, held.key IS NOT NULL AND k.doc_id <> held.holder AS gone FROM k LEFT JOIN held USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""

ORACLE["op4_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLE["op10_source_mixing"] = rf"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}'), lambda x: x <> ''))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
         3 * source_size AS cap FROM s
), p AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(cap) OVER before, 0) AS cap_before, sum(weight) OVER rest AS weight_rest
  FROM w
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (
  SELECT arg_min(total - cap_before, cap / weight) FILTER (WHERE weight * (total - cap_before) / weight_rest <= cap) AS rest,
         arg_min(weight_rest, cap / weight) FILTER (WHERE weight * (total - cap_before) / weight_rest <= cap) AS weights
  FROM p
), t AS (
  SELECT source, source_size, least(weight * rest::DOUBLE / weights, cap::DOUBLE) AS target FROM w, level
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS repeats FROM t
), hashes AS (
  SELECT source, h, sum(size) AS words FROM d WHERE size > 0 GROUP BY source, h
), c AS (
  SELECT hashes.source, h, words, target - repeats * source_size AS remainder,
         sum(words) OVER (PARTITION BY hashes.source ORDER BY h) AS upto
  FROM hashes JOIN q ON hashes.source IS NOT DISTINCT FROM q.source
), extra AS (
  SELECT source, h FROM c
  WHERE upto <= remainder OR (upto - words <= remainder AND upto - remainder < remainder - (upto - words))
)
SELECT d.doc_id, d.size, q.source_size, q.target,
       (d.size * (q.repeats + CASE WHEN extra.h IS NULL THEN 0 ELSE 1 END))::BIGINT AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
LEFT JOIN extra ON d.source IS NOT DISTINCT FROM extra.source AND d.h = extra.h
"""
