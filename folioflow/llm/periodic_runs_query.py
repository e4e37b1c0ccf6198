"""Query op13 over all documents, with its SQL. A tenth of the documents is made periodic first."""

import zlib

from pyspark.sql import functions as F

from .periodic_runs import periodic_runs, split_words
from .queries import query, table


def made_periodic(key: int | None, text: bytes) -> list[bytes]:
    """The words; where the key's checksum ends in 0, those from some place on repeat with some period."""
    words = split_words(key, text)
    mark = None if key is None else zlib.crc32(str(key).encode())
    if not words or mark is None or mark % 10:
        return words
    rest, n = mark // 10, len(words)
    a = rest % n
    period = 1 + (n - a) // (3 + rest % 8)
    return words[:a] + (words[a : a + period] * ((n - a) // period + 1))[: n - a]


# Equal stretches of eight words give every stretch with period q of at least q + 8 words, longer periods included.
# A run has 24 words and three periods at least, so it is among them; it is no run if a shorter period covers it.
SQL = r"""
WITH steps AS (SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
raw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM documents, steps),
parts AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS e FROM raw),
texts AS (SELECT r, doc_id, CASE WHEN a IS NULL THEN w ELSE
  list_concat(w[1:a], list_transform(range(a, len(w)), lambda i: w[a + (i - a) % (1 + (len(w) - a) // e) + 1])) END AS w FROM parts),
words AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM texts),
grams AS (SELECT r, i, word, row_number() OVER (PARTITION BY r ORDER BY i) AS k,
  hash(word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o, lead(word, 5) OVER o, lead(word, 6) OVER o, lead(word, 7) OVER o) AS g,
  lead(word, 7) OVER o AS last FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
pairs AS (SELECT x.r, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.r = y.r AND x.g = y.g AND x.i < y.i WHERE x.last IS NOT NULL AND y.last IS NOT NULL),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS isle FROM pairs),
stretches AS (SELECT r, q, min(i) AS s, count(*) + q + 7 AS n FROM islands GROUP BY r, q, isle HAVING count(*) + q + 7 >= greatest(24, 3 * q)),
runs AS (SELECT * FROM stretches x WHERE NOT EXISTS (SELECT 1 FROM stretches y WHERE y.r = x.r AND y.q < x.q AND y.s <= x.s AND y.s + y.n >= x.s + x.n)),
told AS (SELECT r, count(*) AS n_runs, sha256(string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q)) AS h FROM runs GROUP BY r),
best AS (SELECT * FROM runs x WHERE NOT EXISTS (SELECT 1 FROM runs y WHERE y.r = x.r AND
  (y.n * x.q > x.n * y.q OR y.n * x.q = x.n * y.q AND (y.s < x.s OR y.s = x.s AND y.q < x.q)))),
kept AS (SELECT r, sha256(string_agg(word, ' ' ORDER BY i)) AS h FROM words t
  WHERE NOT EXISTS (SELECT 1 FROM runs u WHERE u.r = t.r AND t.i >= u.s + u.q AND t.i < u.s + u.n) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, n AS length, q AS period, 1000 * n // q AS exponent_milli,
  coalesce(told.h, sha256('')) AS runs_sha256, coalesce(kept.h, sha256('')) AS collapsed_sha256
FROM texts LEFT JOIN told USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""


def most_repeated(runs):
    """The run with the greatest length over period; the first of equals."""
    nothing = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(runs, nothing, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


@query("op13_periodic_runs", SQL)
def op13(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs, words_of=made_periodic)
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    told = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), most_repeated(F.col("runs")).alias("best"),
                        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.expr("1000 * best.length div best.period")
    return told.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
