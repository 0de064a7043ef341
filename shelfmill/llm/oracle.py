"""DuckDB SQL with the same rows as the registered queries."""

_OP1 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
starts AS (
  SELECT item_id, w, least(len(w), 13) AS n, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS s FROM i WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS words FROM starts),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n),
found AS (
  SELECT doc_id, item_id, p.n, s FROM places p JOIN windows v ON v.n = p.n AND v.words = array_to_string(list_slice(w, s, s + p.n - 1), ' ')),
hit AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS spot FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP8 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
sizes AS (SELECT unnest([5, 20]) AS n),
windows AS (
  SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)),
twice AS (
  SELECT doc_id, n, s FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, n, words) AS c FROM windows) WHERE c > 1),
parts AS (
  SELECT doc_id, n, count(DISTINCT spot) AS covered FROM (SELECT doc_id, n, unnest(generate_series(s, s + n - 1)) AS spot FROM twice) GROUP BY doc_id, n),
too_long AS (
  SELECT DISTINCT doc_id FROM (
    SELECT doc_id, count(*) OVER (PARTITION BY doc_id, array_to_string(list_slice(w, s, s + 100), ' ')) AS c
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 100)) AS s
          FROM d JOIN (SELECT DISTINCT doc_id FROM twice WHERE n = 20) USING (doc_id) WHERE len(w) >= 101))
  WHERE c > 1),
m AS (
  SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(a.covered, 0) AS n_repeat_words, coalesce(b.covered, 0) AS covered, t.doc_id IS NOT NULL AS long_repeat
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN parts a ON a.doc_id = d.doc_id AND a.n = 5
  LEFT JOIN parts b ON b.doc_id = d.doc_id AND b.n = 20 LEFT JOIN too_long t ON t.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 15 * n_words) AND NOT (100 * covered > 5 * n_words) AND NOT long_repeat AS kept
FROM m
"""

_OP7 = r"""
WITH h AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (
  SELECT doc_id, s, md5(substring(x, 2 * s + 1, 400)) AS k FROM (SELECT doc_id, x, unnest(range(0, n - 199)) AS s FROM h WHERE n >= 200)),
twice AS (
  SELECT doc_id, s FROM (SELECT *, count(*) OVER (PARTITION BY k) AS c FROM w) WHERE c > 1),
marked AS (
  SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 THEN 0 ELSE 1 END AS fresh FROM twice),
islands AS (
  SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM marked),
spans AS (
  SELECT doc_id, min(s) AS a, max(s) + 200 AS b FROM islands GROUP BY doc_id, g),
parts AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM spans),
cut AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS stop, string_agg(substring(x, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS front
  FROM parts JOIN h USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN stop IS NULL THEN x ELSE front || substring(x, 2 * stop + 1) END)) AS kept_sha256
FROM h LEFT JOIN cut USING (doc_id)
"""

_OP4 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS told,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(17 + length(text) + length(role) + 2 * len(regexp_extract_all(role, '[%<\n]')) + len(regexp_extract_all(text, '</?turn'))) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g
"""

_OP11 = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 10
"""

_OP13 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, s, s + 3), ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS s FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

ORACLE_SQL = {
    "op1_decontamination": _OP1,
    "op4_chat_format": _OP4,
    "op7_substring_dedup": _OP7,
    "op8_quality_rules": _OP8,
    "op11_hard_negatives": _OP11,
    "op13_ngram_jaccard_join": _OP13,
}
