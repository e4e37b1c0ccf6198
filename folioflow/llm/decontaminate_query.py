"""Query op5 over all documents and benchmark items, with its SQL."""

from .decontaminate import contaminated
from .queries import query, table


def shingle_sql(name: str, id_col: str, source: str) -> str:
    """Named tables of the distinct five-word shingles of a table's texts."""
    return f"""
{name}_words AS (SELECT {id_col} AS id, row_number() OVER () AS r, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM {source} WHERE text IS NOT NULL),
{name} AS (SELECT DISTINCT id, r, s FROM (
  SELECT id, r, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] END) AS s FROM {name}_words))"""


SQL = f"""
WITH {shingle_sql("d", "doc_id", "documents")},
{shingle_sql("b", "item_id", "benchmark")},
sizes AS (SELECT r, count(*) AS n FROM b GROUP BY r),
shared AS (SELECT d.id AS doc_id, b.id AS item_id, d.r AS dr, b.r AS br, count(*) AS n_shared FROM d JOIN b USING (s) GROUP BY ALL),
short AS (SELECT id, array_to_string(w, ' ') AS s FROM b_words WHERE len(w) BETWEEN 1 AND 4),
held AS (SELECT doc_id, item_id, n_shared, n AS n_shingles FROM shared JOIN sizes ON br = sizes.r WHERE n_shared >= ceil(0.8 * n - 1e-9)
  UNION ALL SELECT d_words.id, short.id, 1, 1 FROM d_words JOIN short ON contains(' ' || array_to_string(w, ' ') || ' ', ' ' || s || ' '))
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_shared DESC, n_shingles DESC) AS k FROM held) WHERE k = 1
"""


@query("op5_decontamination", SQL)
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(docs, table(spark, sf_dir, "benchmark"))
