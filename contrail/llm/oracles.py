"""DuckDB SQL for the queries that SQL can express, written from their contracts
and the rules in the operators' docstrings; nothing is taken from their code."""

from __future__ import annotations

#: The notices of the boilerplate rule.
_NOTICES = (
    "all rights reserved|licensed under|released under the|terms of use|terms of service|privacy policy|cookie policy|we use cookies|"
    "accept cookies|enable javascript|sign up for our newsletter|subscribe to our|click here to|follow us on|share this article|"
    "powered by|lorem ipsum")

QUALITY = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (
  SELECT r, unnest(generate_series(1, len(w) - 4)) AS i, w FROM words WHERE len(w) >= 5),
grams AS (SELECT r, i, w[i : i + 4] AS g FROM windows),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams),
repeats AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(i, i + 4)) AS p FROM twice WHERE n > 1) GROUP BY r),
lines AS (
  SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs),
spoken AS (SELECT r, line FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
figures AS (
  SELECT r, line,
    length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS visible,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n_words,
    length(regexp_replace(line, '[^#*$%&|<>{{}}~^=]+', '', 'g'))
      + coalesce(list_sum([length(x) for x in regexp_extract_all(line, '[!?]{{2,}}')]), 0) AS marks,
    length(regexp_replace(line, '[^|>»›•·]+', '', 'g')) AS separators
  FROM spoken),
judged AS (
  SELECT r, line, visible,
    NOT (marks > 0.1 * visible AND regexp_matches(line, '[#*$%&|<>{{}}~^=»›•·]|[!?]{{2}}')
      OR separators >= 3 AND separators * 2 >= n_words - separators
      OR n_words >= 20 AND NOT regexp_matches(line, '[.,;:!?…。！？،۔।]')
      OR length(line) <= 200 AND regexp_matches(lower(line), '{_NOTICES}')) AS good
  FROM figures),
by_line AS (
  SELECT r, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN good THEN visible ELSE 0 END) AS left_chars FROM judged GROUP BY r),
base AS (
  SELECT d.doc_id, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
    length(regexp_replace(d.t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    coalesce(l.dup, 0)::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words, coalesce(l.left_chars, 0) AS left_chars
  FROM docs d JOIN words w USING (r) LEFT JOIN by_line l USING (r) LEFT JOIN repeats p USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND left_chars >= word_chars * 0.3 AS kept
FROM base"""

DECONTAMINATION = r"""
WITH said AS (
  SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS w FROM documents),
items AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, [x for x in string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, w[i : i + n - 1] AS g, n FROM (
    SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM grams),
windows AS (
  SELECT doc_id, i, n, w[i : i + n - 1] AS g FROM (
    SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM said JOIN sizes ON len(w) >= n)),
hits AS (SELECT doc_id, i, b.n, item_id FROM windows a JOIN grams b ON a.n = b.n AND a.g = b.g),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
met AS (SELECT doc_id, list_sort(list(DISTINCT item_id)) AS ids FROM hits GROUP BY doc_id)
SELECT s.doc_id, len(s.w)::BIGINT AS n_words, coalesce(p.n_hit, 0)::BIGINT AS n_hit, coalesce(len(m.ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(m.ids, ','), '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM said s LEFT JOIN places p USING (doc_id) LEFT JOIN met m USING (doc_id)"""

LINE_DEDUP = r"""
WITH raw AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
spoken AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS no,
    trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS said
  FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
windows AS (
  SELECT doc_id, no, [said, lead(said, 1) OVER d, lead(said, 2) OVER d] AS g, lead(no, 2) OVER d AS last
  FROM spoken WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
ranked AS (
  SELECT doc_id, no, row_number() OVER (PARTITION BY g ORDER BY doc_id, no) AS k FROM windows WHERE last IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest([no, no + 1, no + 2]) AS no FROM ranked WHERE k > 1),
told AS (SELECT doc_id, count(*) AS n_removed, string_agg(CAST(no AS VARCHAR), ',' ORDER BY no) AS removed FROM gone GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n_lines FROM spoken GROUP BY doc_id),
kept AS (
  SELECT r.doc_id, string_agg(r.line, chr(10) ORDER BY r.pos) AS text, bool_or(s.no IS NOT NULL) AS any_left
  FROM raw r LEFT JOIN spoken s USING (doc_id, pos) LEFT JOIN gone g ON g.doc_id = r.doc_id AND g.no = s.no
  WHERE g.no IS NULL GROUP BY r.doc_id)
SELECT d.doc_id, coalesce(c.n_lines, 0)::BIGINT AS n_lines, coalesce(t.n_removed, 0)::BIGINT AS n_removed,
  coalesce(t.removed, '') AS removed,
  CASE WHEN t.n_removed IS NULL THEN d.text WHEN k.any_left THEN k.text ELSE '' END AS text
FROM documents d LEFT JOIN counts c USING (doc_id) LEFT JOIN told t USING (doc_id) LEFT JOIN kept k USING (doc_id)"""

#: crc32 by its usual table of bytes.
_CRC_TABLE = r"""crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b::BIGINT, [1, 2, 3, 4, 5, 6, 7, 8]), lambda c, k:
      CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(b)))"""


def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a string's UTF-8 bytes, where ``t`` is the table."""
    return (f"xor(list_reduce(list_prepend(4294967295, [('0x' || x)::BIGINT FOR x IN regexp_extract_all(hex(encode({text})), '..')]), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


#: Pairs of equal words at a distance of at most a quarter of the text; stretches of
#: consecutive pairs at one distance; the smallest distance of each stretch is its period.
PERIODIC_RUNS = rf"""
WITH {_CRC_TABLE},
given AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_crc32('doc_id::VARCHAR')} AS h FROM documents, crc_table),
placed AS (
  SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a, (h // 10) % 8 AS g8 FROM given),
said AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN [w[(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g8)) END) + 1] FOR i IN range(n)] ELSE w END AS w FROM placed),
words AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS x FROM said WHERE n > 0),
pairs AS (
  SELECT a.doc_id, a.i, b.i - a.i AS d FROM words a JOIN words b ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
islands AS (
  SELECT doc_id, d, min(i) AS start, count(*) + d AS length FROM (
    SELECT doc_id, d, i, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island FROM pairs) GROUP BY doc_id, d, island),
runs AS (
  SELECT doc_id, start, length, min(d) AS period FROM islands WHERE length >= greatest(6, 4 * d) GROUP BY doc_id, start, length),
told AS (
  SELECT doc_id, count(*) AS n_runs, first([start, length, period] ORDER BY length::DOUBLE / period DESC, start, period) AS best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS all_runs FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS text FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY doc_id)
SELECT s.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[1]::BIGINT AS start, best[2]::BIGINT AS length, best[3]::BIGINT AS period,
  (1000 * best[2] // best[3])::BIGINT AS exponent_milli, sha256(coalesce(all_runs, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM said s LEFT JOIN told t ON s.doc_id = t.doc_id LEFT JOIN kept k ON s.doc_id = k.doc_id"""

SPELLING_VARIANTS = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n, {_crc32("doc_id || ':' || run")} AS h FROM counted, crc_table),
said AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM said WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS short FROM places),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.short = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.short = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other COLLATE C) AS other, max(n) AS best_n FROM near GROUP BY word),
told AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN other END AS form, CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
paths AS (
  SELECT word, word AS at FROM told
  UNION ALL SELECT p.word, t.form FROM paths p JOIN told t ON t.word = p.at WHERE t.form IS NOT NULL),
roots AS (SELECT p.word, p.at AS root FROM paths p JOIN told t ON t.word = p.at WHERE t.form IS NULL)
SELECT t.word, t.form, r.root, t.n, t.n_near, t.form_n FROM told t JOIN roots r USING (word)"""

ORACLES: dict[str, str] = {
    "op1_quality_rules": QUALITY,
    "op8_decontamination": DECONTAMINATION,
    "op9_line_dedup": LINE_DEDUP,
    "op11_periodic_runs": PERIODIC_RUNS,
    "op13_spelling_variants": SPELLING_VARIANTS,
}
