"""Tables that stay in place: merging by month, storing by content, incremental runs."""

from pyspark.sql import Observation, functions as F

from folioflow import sources as src
from folioflow.operators import stats
from folioflow.operators.filters import filter_by_date
from folioflow.operators.links import listing_rows, paginate
from folioflow.plans import landing as landing_plan
from folioflow.plans import transform
from folioflow.plans.workflow import Paths, run_workflow
from folioflow.session import scratch_path

from .pages import _DAY
from .registry import query
from .runs import _VIEWS, END, MONTHLY, START, _items
from .versioning import tnew, tprev, upserted_sql
from .views import META_SQL, OLD_TS, RUN_TS, SITE, blobs, case_pages, cases, cleaned_html, ctes, html_content, landing, landing_meta, landing_prev, listing_pages, table

FIRST, LAST = "2021-01", "2021-06"


@query(
    "landing_months",
    ctes("docs", "landing", "landing_prev")
    + f""", batch AS (SELECT * FROM landing WHERE partition_date BETWEEN '{FIRST}' AND '{LAST}'),
    days AS (SELECT identifier, CASE doc_id % 5 WHEN 1 THEN CAST(d AS TIMESTAMP) + INTERVAL 10 HOUR WHEN 4 THEN NULL ELSE CAST(d AS TIMESTAMP) END AS doc_date FROM landing),
    merged AS ({upserted_sql().replace("FROM landing l", "FROM batch l")}
      UNION ALL SELECT {META_SQL}, version, created_at, updated_at FROM landing_prev WHERE identifier NOT IN (SELECT identifier FROM batch))
    SELECT merged.*, doc_date FROM merged JOIN days USING (identifier)""",
)
def landing_months(spark, sf):
    """Captures of half a year merged into a stored table: the other months are neither read nor written."""
    path = scratch_path(spark, "landing")
    src.write_landing(landing_prev(spark, sf), path)
    src.merge_months(spark, path, landing_meta(spark, sf).where(F.col("partition_date").between(FIRST, LAST)), RUN_TS)
    return src.read_landing(spark, path)


@query("find_stored_identifier", ctes("docs", "landing", "landing_prev") + "SELECT identifier, version, file_hash FROM landing_prev WHERE identifier = 'DOC-16'")
def find_stored_identifier(spark, sf):
    """A point lookup that skips row groups by their bloom filters."""
    path = scratch_path(spark, "landing")
    src.write_landing(landing_prev(spark, sf), path)
    return src.find_by_identifier(src.read_landing(spark, path), "DOC-16").select("identifier", "version", "file_hash")


@query("find_stored_days", ctes("docs", "landing", "landing_prev") + """SELECT identifier, date FROM landing_prev JOIN (SELECT doc_id, identifier, d FROM landing) USING (identifier)
    WHERE doc_id % 5 <> 4 AND d BETWEEN DATE '2021-02-10' AND DATE '2021-03-20'""")
def find_stored_days(spark, sf):
    """A date range over dates in any format, by the stored ``doc_date``."""
    path = scratch_path(spark, "landing")
    src.write_landing(landing_prev(spark, sf), path)
    return filter_by_date(src.read_landing(spark, path), "2021-02-10", "2021-03-20").select("identifier", "date")


@query(
    "landing_rerun",
    """SELECT 'DOC-' || doc_id AS identifier, sha256(CASE WHEN doc_id % 4 = 0 THEN text || ' changed' ELSE text END) AS file_hash,
         CAST(CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 1 END AS INTEGER) AS version, CAST(CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_captures,
         CASE WHEN doc_id % 4 = 0 THEN 'run-3' ELSE 'run-1' END AS stored_by
       FROM documents""",
)
def landing_rerun(spark, sf):
    """The same items twice, then some with new content: bytes are stored once per content."""
    root = scratch_path(spark, "rerun")
    table, store = f"{root}/landing", f"{root}/store"
    changed = F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit(" changed"))).otherwise(F.col("text"))
    waves = [("run-1", _items(spark, sf)), ("run-2", _items(spark, sf)), ("run-3", _items(spark, sf, changed))]
    for run_ts, items in waves:
        landing_plan.land(items, table, store, run_ts, MONTHLY)
    captures = src.stored_captures(spark, store).groupBy(F.col("object_path").alias("file_path")).agg(F.count("*").alias("n_captures"), F.max("run_ts").alias("stored_by"))
    return src.read_landing(spark, table).join(captures, "file_path").select("identifier", "file_hash", "version", "n_captures", "stored_by")


@query(
    "landing_from_pages",
    ctes("cases", "case_pages")
    + f""", made AS (SELECT *, '<html><body><div id="main">' || CASE WHEN conv_id % 2 = 0 THEN '<p>Dated 05/02/2024</p>' ELSE '' END || '<p>' || regexp_replace(text, '[^A-Za-z ]', '', 'g') || '</p>' ||
        CASE turn % 4 WHEN 1 THEN '<a href="/files/adj-' || conv_id || '-' || turn || '.pdf">Download</a>' WHEN 3 THEN '<a href="/files/adj-' || conv_id || '-' || turn || '.DOCX">Download</a>' ELSE '' END ||
        '</div></body></html>' AS html,
        CASE body_id WHEN '1' THEN 'Employment Appeals Tribunal' WHEN '2' THEN 'Equality Tribunal' WHEN '3' THEN 'Labour Court' WHEN '15376' THEN 'Workplace Relations Commission' ELSE 'Workplace Relations' END AS body,
        strftime({_DAY}, '%Y-%m') AS partition_date FROM case_pages WHERE turn % 5 <> 4),
      held AS (SELECT *, CASE WHEN doc_type IS NULL THEN html WHEN turn % 4 = 1 OR conv_id % 3 > 0 THEN 'file of ' || doc_url END AS content FROM made)
      SELECT identifier, body, partition_date, coalesce(doc_type, 'html') AS document_type, sha256(content) AS file_hash, CAST(strlen(content) AS BIGINT) AS n_bytes,
        replace(body, ' ', '_') || '/' || partition_date || '/' || identifier || '.' || coalesce(doc_type, 'html') AS file_path, CAST(1 AS INTEGER) AS version
      FROM held WHERE content IS NOT NULL""",
)
def landing_from_pages(spark, sf):
    """From search results, pages and files to the landing table, with the bytes read back; failed downloads do not land."""
    listing = listing_rows(listing_pages(spark, sf), keep=["body_id"]).withColumn("partition", F.lit("2024-01"))
    turn, stem = F.col("turn"), F.concat(F.lit(f"{SITE}/files/adj-"), "conv_id", F.lit("-"), "turn")
    url = F.when(turn % 4 == 1, F.concat(stem, F.lit(".pdf"))).when((turn % 4 == 3) & (F.col("conv_id") % 3 > 0), F.concat(stem, F.lit(".DOCX")))
    files = cases(spark, sf).select(url.alias("url")).where("url IS NOT NULL").withColumn("content", F.concat(F.lit("file of "), "url"))
    items = landing_plan.items_from_pages(listing, case_pages(spark, sf), files, src.bodies(spark), RUN_TS)
    root = scratch_path(spark, "pages")
    landing_plan.land(items, f"{root}/landing", f"{root}/store", RUN_TS)
    table = src.attach_content(src.read_landing(spark, f"{root}/landing"), src.read_blobs(spark, f"{root}/store"))
    return table.select("identifier", "body", "partition_date", "document_type", "file_hash", F.octet_length("content").cast("long").alias("n_bytes"), "file_path", "version")


@query(
    "transform_rerun",
    _VIEWS
    + """SELECT 'run-1' AS run_ts, count(*) AS total, count(*) AS transformed, CAST(0 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS failed FROM selected
         UNION ALL SELECT 'run-2', count(*), count(*) FILTER (is_copy), count(*) FILTER (NOT is_copy), 0 FROM selected
         UNION ALL SELECT 'run-3', count(*), count(*) FILTER (is_copy OR doc_id % 4 = 0 AND t <> ''), count(*) FILTER (NOT is_copy AND (doc_id % 4 <> 0 OR t = '')), 0 FROM selected JOIN (SELECT doc_id, t FROM docs) USING (doc_id)""",
)
def transform_rerun(spark, sf):
    """Three runs over tables in place; cleaned documents whose bytes did not change are not read again."""
    root = scratch_path(spark, "in-place")
    old, new = F.concat(F.lit(">"), "t", F.lit("<")), F.concat(F.lit(">"), "t", F.lit(" and more words<"))
    changed = F.when((F.col("doc_id") % 4 == 0) & (F.col("t") != ""), F.replace(html_content(), old, new)).otherwise(html_content())
    contents = [html_content(), html_content(), changed]
    before = None
    for n, content in enumerate(contents, 1):
        after = f"{root}/transformed-{n}"
        paths = Paths(f"{root}/store", None, "", f"{root}/results-{n}", before, after, MONTHLY, stats=f"{root}/stats", landing=f"{root}/landing")
        run_workflow(spark, _items(spark, sf, content), paths, START, END, f"run-{n}")
        before = after
    return spark.read.parquet(f"{root}/stats/transform").select("run_ts", "total", "transformed", "skipped", "failed")


@query(
    "transform_failures",
    _VIEWS
    + """SELECT count(*) AS total, count(*) FILTER (status = 'transformed') AS transformed, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed
         FROM (SELECT CASE WHEN s.doc_id % 11 = 0 THEN 'skipped' WHEN s.doc_id % 7 <> 3 AND NOT s.is_copy AND p.new_hash = s.new_hash THEN 'skipped'
                WHEN s.doc_id % 7 = 3 THEN 'failed' ELSE 'transformed' END AS status FROM selected s LEFT JOIN tprev p ON s.identifier = p.identifier)""",
)
def transform_failures(spark, sf):
    """Statistics taken while the results are written; documents without an identifier fail."""
    rows = landing(spark, sf, html_content())
    output = F.when(F.col("document_type") == "pdf", F.col("content")).otherwise(cleaned_html())
    existing = tprev(tnew(rows, F.sha2(output, 256)))
    named = rows.withColumn("identifier", F.when(F.col("doc_id") % 7 != 3, F.col("identifier")))
    stored = named.drop("doc_id", "d", "t", "content").withColumns({"version": F.lit(1), "created_at": F.lit(OLD_TS), "updated_at": F.lit(None).cast("string")})
    results = transform.transform_results(stored, blobs(spark, sf, html_content()), existing, START, END, RUN_TS)
    seen = Observation()
    src.write_partitioned(results, scratch_path(spark, "results"), MONTHLY, seen=seen, counts=stats.transform_counts())
    return stats.observed(spark, seen, ["total", "transformed", "skipped", "failed"])


@query(
    "event_log_roundtrip",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS event, count(*) AS n, count(*) FILTER (event_id % 10 = 3) AS n_broken, sum(CASE WHEN event_id % 10 <> 3 THEN user_id ELSE 0 END)::BIGINT AS users
       FROM events GROUP BY 1, 2""",
)
def event_log_roundtrip(spark, sf):
    """Events written by day, some lines cut short, then read as typed events and as broken lines."""
    path, schema = scratch_path(spark, "event-log"), "timestamp string, event string, event_id long, user_id long"
    events = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.col("event_type").alias("event"), "event_id", "user_id")
    src.write_event_log(events.where("event_id % 10 <> 3"), path)
    cut = src.to_event_json(events.where("event_id % 10 = 3"), keep=[F.substring("timestamp", 1, 10).alias("day")])
    cut.withColumn("value", F.expr("left(value, length(value) - 1)")).write.mode("append").partitionBy("day").text(path)
    good = src.read_event_log(spark, path, schema).groupBy(F.substring("timestamp", 1, 10).alias("day"), "event").agg(F.count("*").alias("n_good"), F.sum("user_id").alias("users"))
    named = F.regexp_extract("value", '"event":"([^"]*)"', 1).alias("event")
    bad = src.broken_lines(spark, path, schema).groupBy("day", named).agg(F.count("*").alias("n_broken"))
    both = good.join(bad, ["day", "event"], "full").na.fill(0, ["n_good", "n_broken", "users"])
    return both.select("day", "event", (F.col("n_good") + F.col("n_broken")).alias("n"), "n_broken", "users")


@query(
    "paginate_edges",
    """WITH RECURSIVE e AS (SELECT DISTINCT least(o_orderkey, 30000) % 997 AS a, o_custkey % 997 AS b FROM orders WHERE o_orderkey % 5 = 0
         UNION SELECT x, x + 1 FROM (SELECT unnest(range(2000, 2300)) AS x) UNION SELECT 17, 2000),
       walk AS (SELECT CAST(1 AS BIGINT) AS page, CAST(0 AS BIGINT) AS depth UNION SELECT 2100, 0
         UNION SELECT e.b, depth + 1 FROM walk JOIN e ON a = page WHERE depth < 330)
       SELECT page, min(depth) AS depth FROM walk GROUP BY page""",
)
def paginate_edges(spark, sf):
    """Pages that branch and form cycles, with a long chain behind them."""
    orders = table(spark, sf, "orders").where("o_orderkey % 5 = 0")
    edges = orders.select((F.least("o_orderkey", F.lit(30000)) % 997).alias("src"), (F.col("o_custkey") % 997).alias("dst"))
    chain = spark.range(2000, 2300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    more = spark.createDataFrame([(17, 2000)], "src long, dst long")
    seeds = spark.createDataFrame([(1,), (2100,)], "page long")
    return paginate(seeds, edges.unionByName(chain).unionByName(more))
