"""Query op2 over all documents, with its SQL."""

from .line_rules import quality_rules
from .queries import query, table

SQL = r"""
WITH d AS (SELECT doc_id, source, text, row_number() OVER () AS r,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM d),
grams AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS n FROM win),
rep AS (SELECT r, count(*) AS n_repeat_words FROM (SELECT DISTINCT r, unnest(range(i, i + 5)) AS p FROM grams WHERE n > 1) GROUP BY r),
raw AS (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
norm AS (SELECT r, regexp_replace(trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')), '[0-9]', '0', 'g') AS line FROM raw),
told AS (SELECT n.r, d.source, md5(d.text) AS t, n.line, len(string_split(n.line, ' ')) AS k FROM norm n JOIN d USING (r) WHERE n.line <> '' AND d.text IS NOT NULL),
hosts AS (SELECT source, count(DISTINCT md5(text)) AS docs FROM d WHERE text IS NOT NULL GROUP BY source),
freq AS (SELECT a.source, a.line FROM (SELECT source, line, count(DISTINCT t) AS n FROM told GROUP BY source, line) a
    JOIN hosts h ON a.source IS NOT DISTINCT FROM h.source WHERE n > 20 AND (n > 0.05 * docs OR n > 500)),
lost AS (SELECT told.r, sum(k)::BIGINT AS n_removed_words, count(DISTINCT told.line) AS n_frequent_lines FROM told
    JOIN freq f ON told.source IS NOT DISTINCT FROM f.source AND told.line = f.line GROUP BY told.r),
s AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
    (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_removed_words, 0) AS n_removed_words, coalesce(n_frequent_lines, 0) AS n_frequent_lines
  FROM d LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN lost USING (r)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    n_removed_words > 0 AND (n_words - n_removed_words < 1 OR n_words - n_removed_words < 0.3 * n_words) AS depleted FROM s)
SELECT *, NOT base_failed AND NOT depleted AS kept FROM v
"""


@query("op2_line_quality", SQL)
def op2(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_removed_words", "n_frequent_lines", "base_failed", "depleted", "kept",
    )
