"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .line_dedup import MIN_CHARS
from .quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS

_SPACE = r"\x20\x09-\x0D"

_VERDICT = {
    "word_length": "word_chars / n_words",
    "symbol_words": "n_symbols / n_words",
    "stop_words": "n_stop_words",
    "letter_words": "n_letter_words / n_words",
    "dup_lines": "n_dup_lines / n_word_lines",
    "bullet_lines": "n_bullet_lines / n_word_lines",
    "ellipsis_lines": "n_ellipsis_lines / n_word_lines",
}


def _rules() -> str:
    parts = []
    for r in RULES:
        value = _VERDICT[r.name]
        parts += [f"{value} >= {r.low}"] * (r.low is not None) + [f"{value} <= {r.high}"] * (r.high is not None)
    return " AND ".join(f"coalesce({p}, true)" for p in parts)


QUALITY_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^{_SPACE}]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) AS ls
  FROM d
), g AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), r AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM g) WHERE n >= 2
), c AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY rid
), m AS (
  SELECT w.rid, doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(ls) AS n_word_lines,
         len(list_filter(ls, lambda x: regexp_matches(ltrim(x, ' '), '^[-*•]'))) AS n_bullet_lines,
         len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[{_SPACE}]*$'))) AS n_ellipsis_lines,
         len(list_intersect(list_distinct(regexp_extract_all(lower(t), '\p{{L}}+')),
             [{", ".join(f"'{s}'" for s in STOP_WORDS)}])) AS n_stop_words,
         len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words
  FROM w LEFT JOIN c ON w.rid = c.rid
), b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND ({_rules()}) AS kept
FROM b
"""

LINE_DEDUP = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS o, coalesce(text, '') AS t
  FROM documents
), l AS (
  SELECT rid, o, doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS pos FROM d
), k AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[{_SPACE}]+', ''), '[{_SPACE}]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), f AS (
  SELECT key, min(o) AS first FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT o) > 1
), j AS (
  SELECT k.*, f.first IS NOT NULL AND k.o > f.first AS gone FROM k LEFT JOIN f ON k.key = f.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY rid, doc_id
"""

LEXICAL_SEARCH = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper_case, 'abcdefghijklmnopqrstuvwxyz' AS lower_case),
d AS (
  SELECT doc_id, regexp_extract_all(translate(text, upper_case, lower_case), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents, letters
),
totals AS (SELECT count(*) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_words FROM d WHERE len(words) > 0),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, upper_case, lower_case), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark, letters
),
p AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY ALL
),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), totals
),
s AS (
  SELECT item_id, doc_id,
    CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_words)))) AS BIGINT) AS score
  FROM i JOIN p USING (term) JOIN w USING (term), totals GROUP BY item_id, doc_id
),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM r WHERE place <= 50
"""

SQL = {"op3_quality_rules": QUALITY_RULES, "op7_line_dedup": LINE_DEDUP, "op12_lexical_search": LEXICAL_SEARCH}
