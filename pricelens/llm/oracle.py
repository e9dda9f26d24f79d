"""SQL equivalents (DuckDB) of the queries that SQL can express."""

from pricelens.llm.quality import ENDINGS, MAX_LOSS, PHRASES, SYMBOLS

SPACE_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
BOILERPLATE = "|".join(p if p.isascii() and p[0].isalpha() else f"[{p}]" for p in PHRASES)
UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


LINE_DEDUP = f"""
WITH rows_ AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM rows_
),
keyed AS (SELECT *, translate(trim(line, {SPACE_CHARS}), {UPPER_LOWER}) AS k FROM lines),
often AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
),
marked AS (SELECT keyed.*, often.k IS NOT NULL AND keyed.doc_id <> often.keeper AS gone FROM keyed LEFT JOIN often ON keyed.k = often.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

QUALITY = f"""
WITH rows_ AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM rows_),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)
),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM rows_),
cores AS (SELECT r, line, trim(line, {SPACE_CHARS}) AS core FROM lines),
parts AS (
  SELECT r, line, core, length(regexp_replace(core, '[^\\x20\\x09-\\x0D]+', '', 'g')) + 1 AS n FROM cores WHERE core <> ''
),
judged AS (
  SELECT r, line, length(core) AS chars,
    NOT regexp_matches(core, {_text(ENDINGS)})
    OR length(regexp_replace(core, '(!!|\\?\\?)|[^!?]|[!?]', '\\1', 'g')) >= n
    OR length(regexp_replace(core, '[^|»›•·]+', '', 'g')) >= 2
    OR regexp_matches(lower(core), {_text(BOILERPLATE)})
    OR length(regexp_replace(core, {_text(SYMBOLS)}, '', 'g')) > n AS fails
  FROM parts
),
by_doc AS (
  SELECT r, count(*) - count(DISTINCT line) AS dups, sum(chars) AS chars, coalesce(sum(chars) FILTER (WHERE NOT fails), 0) AS kept_chars
  FROM judged GROUP BY r
),
counts AS (
  SELECT rows_.r, doc_id, len(w) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, {_text(SYMBOLS)}, '', 'g')) AS n_symbols, coalesce(dups, 0) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(chars, 0) AS chars, coalesce(kept_chars, 0) AS kept_chars
  FROM rows_ JOIN words ON rows_.r = words.r LEFT JOIN covered ON rows_.r = covered.r LEFT JOIN by_doc ON rows_.r = by_doc.r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND kept_chars >= (1 - {MAX_LOSS}) * chars AS kept
FROM counts
"""

TERMS = f"regexp_extract_all(translate(text, {UPPER_LOWER}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

RANKED = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS terms FROM documents WHERE text IS NOT NULL),
totals AS (SELECT count(*) AS docs_n, sum(len(terms)) AS terms_n FROM docs WHERE len(terms) > 0),
wanted AS (SELECT DISTINCT i, item_id, unnest(terms) AS term FROM (SELECT row_number() OVER () AS i, item_id, {TERMS} AS terms FROM benchmark)),
counted AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM wanted) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs_n + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), totals
),
lengths AS (SELECT r, doc_id, CAST(50 + (50 * len(terms) * docs_n) // terms_n AS BIGINT) AS m FROM docs, totals),
scored AS (
  SELECT i, item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN counted USING (term) JOIN lengths USING (r) GROUP BY i, item_id, doc_id, r
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS place FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
"""
