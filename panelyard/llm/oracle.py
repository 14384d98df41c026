"""The queries that SQL can express, as SQL over the tables.

Nothing is taken from the operators: bounds and words are written out here again.
"""

from __future__ import annotations

OP1 = r"""
WITH t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents),
words AS (
  SELECT doc_id, len(w) AS n, unnest(list_transform(range(1, len(w) + 1), lambda i: {
    'spot': i, 'g1': w[i], 'g2': CASE WHEN i > 1 THEN w[i - 1] || ' ' || w[i] END,
    'g3': CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END}), recursive := true)
  FROM t),
others AS (
  SELECT doc_id, n, spot,
    count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY doc_id, g1) AS c1,
    count(g2) OVER (PARTITION BY g2) - count(g2) OVER (PARTITION BY doc_id, g2) AS c2,
    count(g3) OVER (PARTITION BY g3) - count(g3) OVER (PARTITION BY doc_id, g3) AS c3
  FROM words),
placed AS (
  SELECT *, lag(c1) OVER doc AS before1, lag(c2) OVER doc AS before2
  FROM others WINDOW doc AS (PARTITION BY doc_id ORDER BY spot)),
sized AS (
  SELECT *, CASE WHEN c3 > 0 THEN 3 WHEN c2 > 0 THEN 2 ELSE 1 END AS size FROM placed),
scores AS (
  SELECT doc_id, size, CASE size WHEN 3 THEN ln(c3 / before2) WHEN 2 THEN ln(c2 / before1)
      ELSE ln(greatest(c1, 1) / ((SELECT count(*) FROM words) - n + 1)) END
    + (least(spot, 3) - size) * ln(0.4) AS score FROM sized)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, count(*) FILTER (WHERE size = 1) AS n_1_gram,
  count(*) FILTER (WHERE size = 2) AS n_2_gram, count(*) FILTER (WHERE size = 3) AS n_3_gram,
  round(sum(score), 4) AS log_score
FROM t LEFT JOIN scores USING (doc_id) GROUP BY t.doc_id, len(t.w)
"""

OP3 = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM t WINDOW same AS (PARTITION BY norm)
"""

OP4 = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT doc_id, text,
    list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM t),
windows AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 1),
    lambda i: {'spot': i, 'gram': w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]}), recursive := true)
  FROM parts WHERE len(w) >= 3),
repeated AS (SELECT doc_id, spot FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, gram) >= 2),
covered AS (
  SELECT doc_id, count(DISTINCT spot + k) AS n
  FROM repeated, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
counts AS (
  SELECT p.doc_id, len(w) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    len(l) AS n_lines,
    length(regexp_replace(text, '[^!]', '', 'g')) AS n_marks,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_letters,
    len(list_filter(w, lambda x: lower(x) IN ({STOP}))) AS n_stop,
    len(list_filter(l, lambda x: regexp_matches(ltrim(x, ' '), '^[-*•]'))) AS n_bullets,
    len(list_filter(l, lambda x: suffix(x, '...') OR suffix(x, '…'))) AS n_dots
  FROM parts p LEFT JOIN covered c USING (doc_id)),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 12 * n_words
    AND n_symbols <= 0.1 * n_words AND n_stop >= 2 AND n_letters >= 0.6 * n_words
    AND n_marks <= 0.3 * n_words AND n_dup_lines <= 0.5 * n_lines
    AND n_bullets <= 0.9 * n_lines AND n_dots <= 0.3 * n_lines AS kept
FROM base
""".replace("{STOP}", ", ".join(f"'{w}'" for w in """
the be to of and that have with in is was a for it as on by this an at from are or not
der die und das den von mit zu dem des ist auf im sich ein eine als auch es nicht
le la les de et un une du que qui en pour dans est au pas par sur avec ce il elle
el los las y se del con una su para es al lo como por no""".split()))

ORACLE: dict[str, str] = {
    "op1_lm_scoring": OP1,
    "op3_exact_dedup": OP3,
    "op4_quality_rules": OP4,
}
