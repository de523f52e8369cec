"""SQL equivalents of the queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

_LINE_FREQUENCY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws
  FROM documents
),
windows AS (SELECT rid, i, list_slice(ws, i, i + 4) AS g FROM d, unnest(range(1, len(ws) - 3)) AS r(i)),
twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
repeated AS (SELECT rid, count(DISTINCT p) AS n FROM twice, unnest(range(i, i + 5)) AS r(p) GROUP BY rid),
split_lines AS (SELECT rid, source, t, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (
  SELECT *, len(regexp_extract_all(line, '{_WORD}')) AS n,
         translate(array_to_string(regexp_extract_all(line, '{_WORD}'), ' '),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000') AS norm
  FROM split_lines WHERE regexp_matches(line, '{_WORD}')
),
dups AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY rid),
hosts AS (SELECT source, count(DISTINCT t) AS n FROM d GROUP BY source),
spread AS (SELECT source, norm, count(DISTINCT t) AS n FROM lines GROUP BY source, norm),
removed AS (
  SELECT l.rid, sum(l.n) AS n
  FROM lines l
  JOIN spread s ON s.norm = l.norm AND s.source IS NOT DISTINCT FROM l.source
  JOIN hosts h ON h.source IS NOT DISTINCT FROM l.source
  WHERE s.n > 5 AND s.n > 0.01 * h.n
  GROUP BY l.rid
),
base AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words,
         len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(u.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         len(ws) - coalesce(x.n, 0) AS n_left
  FROM d LEFT JOIN dups u USING (rid) LEFT JOIN repeated r USING (rid) LEFT JOIN removed x USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_left >= 10 AND n_left >= 0.5 * n_words AS kept
FROM base
"""

_EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)
"""

_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
words AS (
  SELECT lang, piece_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT lang, row_number() OVER () AS piece_id, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces)
),
neighbours AS (
  SELECT lang, w, lead(w) OVER later AS w2, lead(w, 2) OVER later AS w3
  FROM words WINDOW later AS (PARTITION BY piece_id ORDER BY i)
),
occurrences AS (
  SELECT lang, 1 AS k, w AS phrase FROM neighbours
  UNION ALL SELECT lang, 2, w || ' ' || w2 FROM neighbours WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM neighbours WHERE w3 IS NOT NULL
),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS n FROM occurrences GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, l.n AS l, r.n AS r,
         (1000000 * c.a::HUGEINT * c.a::HUGEINT) // (l.n::HUGEINT * r.n::HUGEINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.ws, 1, cut), ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.ws, cut + 1, c.k), ' ')
),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
covered AS (
  SELECT DISTINCT s.lang, s.phrase
  FROM candidates s
  JOIN (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase
        FROM candidates WHERE k = 3) b ON b.lang = s.lang AND b.phrase = s.phrase
  WHERE s.k = 2 AND 100 * b.a >= 50 * s.a
),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM scored s ANTI JOIN covered USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, t.n, score::BIGINT AS score
FROM ranked JOIN totals t USING (lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op6_line_frequency": _LINE_FREQUENCY,
    "op11_exact_dedup": _EXACT_DEDUP,
    "op13_phrases": _PHRASES,
}
