"""Query op11 over all documents, with its SQL."""

from .collocations import collocations
from .queries import query, table

SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
spans AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p FROM spans, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, p, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT lang, k, p, a, string_split(p, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT lang, k, p, a, w, unnest(range(1, k)) AS c FROM candidates),
scores AS (SELECT x.lang, x.k, x.p, x.a, x.c, l.a AS l, r.a AS r, CAST((CAST(2000000 AS HUGEINT) * x.a) // (l.a + r.a) AS BIGINT) AS score
  FROM cuts x JOIN f l ON l.lang = x.lang AND l.p = array_to_string(x.w[1:x.c], ' ') JOIN f r ON r.lang = x.lang AND r.p = array_to_string(x.w[x.c + 1:], ' ')),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
inner_parts AS (SELECT DISTINCT lang, a, array_to_string(w[s:s + m - 1], ' ') AS p FROM candidates, (SELECT unnest([1, 2, 3]) AS s), (SELECT unnest([2, 3]) AS m) WHERE m < k AND s + m - 1 <= k),
kept AS (SELECT * FROM lowest x WHERE NOT EXISTS (SELECT 1 FROM inner_parts y WHERE y.lang = x.lang AND y.p = x.p AND 100 * y.a >= 80 * x.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(p)) AS rank FROM kept)
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op11_collocations", SQL)
def op11(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))
