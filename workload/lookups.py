"""Sources, sinks, filters, joins and reports."""

from pyspark.sql import functions as F

from folioflow import functions as fn
from folioflow import sources as src
from folioflow.operators import classify, filters, lookup, merge, stats
from folioflow.plans import transform
from folioflow.session import scratch_path

from .registry import query
from .views import (
    CTE,
    META_SQL,
    RUN_TS,
    SEARCH,
    blobs,
    ctes,
    fetches,
    landing,
    landing_meta,
    table,
)


@query("landing_count", "SELECT count(*) AS n_rows FROM documents")
def landing_count(spark, sf):
    return src.table_count(landing_meta(spark, sf))


@query(
    "content_join",
    ctes("docs", "landing", "blobs")
    + """SELECT identifier, strlen(blobs.content) AS length, sha256(blobs.content) AS content_hash
         FROM landing LEFT JOIN blobs ON file_path = object_path""",
)
def content_join(spark, sf):
    joined = src.attach_content(landing_meta(spark, sf), blobs(spark, sf))
    return joined.select(
        "identifier", fn.content_length("content").alias("length"), F.sha2("content", 256).alias("content_hash")
    )


@query("blob_exists", ctes("docs", "landing", "blobs") + "SELECT identifier FROM landing WHERE file_path IN (SELECT object_path FROM blobs)")
def blob_exists(spark, sf):
    return src.with_existing_blob(landing_meta(spark, sf), blobs(spark, sf)).select("identifier")


@query("blob_missing", ctes("docs", "landing") + "SELECT identifier FROM landing WHERE doc_id % 11 = 0")
def blob_missing(spark, sf):
    return src.with_missing_blob(landing_meta(spark, sf), blobs(spark, sf)).select("identifier")


@query(
    "blob_roundtrip",
    ctes("docs", "landing")
    + """SELECT body, partition_date, file_path AS object_path, CAST(strlen(content) AS BIGINT) AS length,
           CASE document_type WHEN 'pdf' THEN 'application/pdf' ELSE 'text/html' END AS content_type, file_hash AS content_hash
         FROM landing WHERE content <> ''""",
)
def blob_roundtrip(spark, sf):
    path = scratch_path(spark, "blobs")
    src.write_blobs(src.blob_rows(landing(spark, sf), content="content"), path)
    return src.read_blobs(spark, path).select(
        "body",
        "partition_date",
        "object_path",
        "length",
        "content_type",
        fn.content_hash("content").alias("content_hash"),
    )


@query("find_by_identifier", ctes("docs", "landing") + f"SELECT {META_SQL} FROM landing WHERE identifier = 'DOC-17'")
def find_by_identifier(spark, sf):
    return src.find_by_identifier(landing_meta(spark, sf), "DOC-17")


@query(
    "find_by_date_range",
    ctes("docs", "landing") + f"SELECT {META_SQL} FROM landing WHERE date BETWEEN '2021-01-01' AND '2021-12-31'",
)
def find_by_date_range(spark, sf):
    return src.find_by_date_range(landing_meta(spark, sf), "2021-01-01", "2021-12-31")


@query("find_by_partition", ctes("docs", "landing") + f"SELECT {META_SQL} FROM landing WHERE partition_date = '2021-03'")
def find_by_partition(spark, sf):
    """Reads one directory of the month layout."""
    path = scratch_path(spark, "landing")
    src.write_partitioned(landing_meta(spark, sf), path, by=("partition_date",))
    return src.find_by_partition(src.read_blobs(spark, path), "2021-03")


CTE["ranges"] = """ranges AS (
  SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day,
         o_custkey % 50 = 0 AS broken
  FROM orders GROUP BY o_custkey)"""
CTE["parts"] = """parts AS (
  SELECT o_custkey, CAST(p AS DATE) AS p_start,
         least(CAST(p + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE), e) AS p_end, strftime(p, '%Y-%m') AS partition
  FROM (SELECT o_custkey, e, unnest(generate_series(date_trunc('month', s), CAST(e AS TIMESTAMP), INTERVAL 3 MONTH)) AS p
        FROM (SELECT o_custkey, CASE WHEN broken THEN DATE '2024-05-16' ELSE first_day END AS s,
                     CASE WHEN broken THEN DATE '2024-06-15' ELSE last_day END AS e FROM ranges)))"""


def _parts(spark, sf):
    ranges = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
        .select(
            "o_custkey",
            F.date_format("a", "yyyy-MM-dd").alias("start_date"),
            F.when(F.col("o_custkey") % 50 == 0, "n/a").otherwise(F.date_format("b", "yyyy-MM-dd")).alias("end_date"),
        )
    )
    return src.date_partitions(ranges, months=3, now="2024-06-15").select("o_custkey", "p_start", "p_end", "partition")


@query("date_partitions", ctes("ranges", "parts") + "SELECT o_custkey, p_start, p_end, partition FROM parts")
def date_partitions(spark, sf):
    return _parts(spark, sf)


def _day(c):
    return f"replace(strftime({c}, '%d/%m/%Y'), '/', '%2F')"


_QUERY = f"'{SEARCH}?decisions=1&from=' || {_day('p_start')} || '&to=' || {_day('p_end')}"


@query(
    "search_requests",
    ctes("ranges", "parts")
    + f"""SELECT o_custkey, partition, '1,2,3,15376' AS body_id,
            {_QUERY} || '&body=1&body=2&body=3&body=15376' AS url FROM parts""",
)
def search_requests(spark, sf):
    requests = src.search_requests(_parts(spark, sf), src.body_ids("all"), SEARCH)
    return requests.select("o_custkey", "partition", "body_id", "url")


@query(
    "search_requests_per_body",
    ctes("ranges", "parts")
    + f"SELECT o_custkey, partition, b AS body_id, {_QUERY} || '&body=' || b AS url FROM parts, (VALUES ('3'), ('15376')) v(b)",
)
def search_requests_per_body(spark, sf):
    requests = src.search_requests(_parts(spark, sf), src.body_ids("3, 15376"), SEARCH, per_body=True)
    return requests.select("o_custkey", "partition", "body_id", "url")


@query(
    "event_json",
    """SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, event_type AS event, event_id, user_id, value,
         CASE WHEN event_id % 3 <> 0 THEN props END AS props FROM events""",
)
def event_json(spark, sf):
    """Events written as JSON and parsed again; null fields survive."""
    events = table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("event_type").alias("event"),
        "event_id",
        "user_id",
        "value",
        F.when(F.col("event_id") % 3 != 0, F.col("props")).alias("props"),
    )
    parsed = F.from_json("value", "timestamp string, event string, event_id long, user_id long, value double, props string")
    return src.to_event_json(events).select(parsed.alias("e")).select("e.*")


_SUMMARY = """SELECT user_id, count(*) FILTER (event_type = 'view') AS found,
  count(*) FILTER (event_type = 'purchase') AS scraped, count(*) FILTER (event_type = 'click') AS pages FROM events GROUP BY user_id"""


def _summary(spark, sf):
    return stats.crawl_summary(
        table(spark, sf, "events"), by=["user_id"], event="event_type", found="view", scraped="purchase", pages="click"
    )


@query("crawl_summary", _SUMMARY)
def crawl_summary(spark, sf):
    return _summary(spark, sf)


@query(
    "crawl_summary_json",
    f"""SELECT '{{"found":' || found || ',"scraped":' || scraped || ',"pages":' || pages || ',"reason":"finished","user_id":' || user_id || '}}' AS summary
        FROM ({_SUMMARY})""",
)
def crawl_summary_json(spark, sf):
    finished = _summary(spark, sf).select("found", "scraped", "pages", F.lit("finished").alias("reason"), "user_id")
    return src.run_summary_json(finished)


@query("metadata_only", ctes("docs", "landing") + f"SELECT {META_SQL} FROM landing")
def metadata_only(spark, sf):
    return filters.metadata_only(landing(spark, sf).drop("doc_id", "d", "t"), "content")


_TRANSFORMED = f"""identifier, title, description, date, body, link_to_doc AS original_link, file_path AS original_file_path,
  file_hash AS original_hash, body || '/' || partition_date || '/' || identifier || '.' || {{ext}} AS transformed_file_path,
  sha256(content) AS new_hash, document_type, partition_date, '{RUN_TS}' AS transformed_at"""


@query(
    "transformed_rows",
    ctes("docs", "landing")
    + f"""SELECT {_TRANSFORMED.format(ext="'html'")}, CAST(1 + doc_id % 3 AS INTEGER) AS version, false AS is_copy
          FROM landing WHERE document_type <> 'pdf'""",
)
def transformed_rows(spark, sf):
    html, _ = filters.split_by_type(landing(spark, sf))
    known = html.withColumns(
        {
            "new_hash": F.sha2("content", 256),
            "known": F.col("doc_id") % 3 > 0,
            "old_version": (F.col("doc_id") % 3).cast("int"),
        }
    )
    return transform.transformed_rows(known, RUN_TS).drop("cleaner_version")


@query(
    "copied_rows",
    ctes("docs", "landing")
    + f"""SELECT {_TRANSFORMED.format(ext="document_type")}, CAST(NULL AS INTEGER) AS version, true AS is_copy
          FROM landing WHERE document_type = 'pdf'""",
)
def copied_rows(spark, sf):
    _, other = filters.split_by_type(landing(spark, sf))
    return transform.copied_rows(other.withColumn("content", F.col("content").cast("binary")), RUN_TS).drop("cleaner_version")


_IN_RANGE = "doc_id % 5 <> 4 AND d BETWEEN DATE '2021-03-01' AND DATE '2023-06-30'"
_CANDIDATE = """((date >= '2021-03-01' AND date <= '2023-06-30T23:59:59') OR regexp_matches(date, '(2021|2023|2022)$'))"""


@query("filter_by_date", ctes("docs", "landing") + f"SELECT identifier, date FROM landing WHERE {_IN_RANGE}")
def filter_by_date(spark, sf):
    return filters.filter_by_date(landing(spark, sf), "2021-03-01", "2023-06-30").select("identifier", "date")


@query("candidate_filter", ctes("docs", "landing") + f"SELECT identifier, date FROM landing WHERE {_CANDIDATE}")
def candidate_filter(spark, sf):
    return filters.candidate_filter(landing(spark, sf), "2021-03-01", "2023-06-30").select("identifier", "date")


@query(
    "filter_by_date_compat",
    ctes("docs", "landing")
    + """SELECT identifier, date FROM landing WHERE doc_id % 5 <> 4 AND d BETWEEN DATE '2020-03-01' AND DATE '2023-12-31'
         AND ((date >= '2020-03-01' AND date <= '2023-12-31T23:59:59') OR regexp_matches(date, '(2020|2023|2021)$'))""",
)
def filter_by_date_compat(spark, sf):
    """Day-first dates of 2022 are lost to the coarse filter, as they are where it comes from."""
    return filters.filter_by_date_compat(landing(spark, sf), "2020-03-01", "2023-12-31").select("identifier", "date")


@query(
    "route_by_type",
    ctes("docs", "landing") + "SELECT identifier, CASE WHEN document_type = 'pdf' THEN 'copy' ELSE 'clean' END AS route FROM landing",
)
def route_by_type(spark, sf):
    html, other = filters.split_by_type(landing_meta(spark, sf))
    return html.select("identifier", F.lit("clean").alias("route")).unionByName(
        other.select("identifier", F.lit("copy").alias("route"))
    )


@query("with_content", ctes("docs", "landing") + "SELECT identifier FROM landing WHERE doc_id % 11 <> 0 AND content <> ''")
def with_content(spark, sf):
    joined = src.attach_content(landing_meta(spark, sf), blobs(spark, sf))
    return filters.with_content(joined).select("identifier")


@query(
    "within_domains",
    r"""SELECT page_id, url FROM pages
        WHERE regexp_matches(lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]*)', 1)), '(^|\.)(example\.com|example\.net)$')""",
)
def within_domains(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.where(fn.within_domains("url", ["example.com", "example.net"])).select("page_id", "url")


_BODY_ID = "CASE o_custkey % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '15376' ELSE '1,2' END"


def _with_body_id(spark, sf):
    ids = F.array(*[F.lit(i) for i in ["1", "2", "3", "15376", "1,2"]])
    return table(spark, sf, "orders").select(
        "o_orderkey", F.element_at(ids, (F.col("o_custkey") % 5 + 1).cast("int")).alias("body_id")
    )


@query(
    "body_lookup",
    f"""SELECT o_orderkey, body_id, coalesce(name, 'Workplace Relations') AS body_name
        FROM (SELECT o_orderkey, {_BODY_ID} AS body_id FROM orders)
        LEFT JOIN (VALUES ('1', 'Employment Appeals Tribunal'), ('2', 'Equality Tribunal'), ('3', 'Labour Court'),
                          ('15376', 'Workplace Relations Commission')) v(id, name) ON body_id = id""",
)
def body_lookup(spark, sf):
    return lookup.with_body_name(_with_body_id(spark, sf), src.bodies(spark))


@query("unknown_bodies", f"SELECT o_orderkey, {_BODY_ID} AS body_id FROM orders WHERE o_custkey % 5 = 4")
def unknown_bodies(spark, sf):
    return lookup.unknown_bodies(_with_body_id(spark, sf), src.bodies(spark)).select("o_orderkey", "body_id")


def _classified(text):
    markers = ["cf-browser-verification", "cf_chl_opt", "checking your browser", "cf-challenge-running", "_cf_chl_tk",
               "just a moment", "attention required", "cloudflare"]
    hit = " OR ".join(f"contains(lower({text}), '{m}')" for m in markers)
    return f"""SELECT page_id, status, CASE WHEN status = 429 THEN 'rate_limited'
        WHEN status IN (403, 503) AND ({hit}) THEN 'challenge' WHEN status BETWEEN 520 AND 524 THEN 'edge_error'
        WHEN status BETWEEN 200 AND 299 THEN 'other' ELSE 'http_error' END AS fetch_class,
        CASE WHEN status = 429 THEN coalesce(TRY_CAST(retry_after AS INTEGER), 30) END AS retry_after_seconds FROM fetches"""


@query("classify_fetch", ctes("fetches") + _classified("body"))
def classify_fetch(spark, sf):
    """Markers count anywhere in the body."""
    return classify.classify_fetch(fetches(spark, sf)).drop("body", "retry_after")


@query("classify_fetch_whole", ctes("fetches") + _classified("body"))
def classify_fetch_whole(spark, sf):
    return classify.classify_fetch(fetches(spark, sf), window=None).drop("body", "retry_after")


@query("usable_pages", ctes("fetches") + f"SELECT page_id, status FROM ({_classified('body')}) WHERE fetch_class = 'other'")
def usable_pages(spark, sf):
    """Pages kept for the corpus."""
    return classify.usable_pages(fetches(spark, sf)).select("page_id", "status")


@query("duplicate_keys", "SELECT source AS body, lang, count(*) AS n_rows FROM documents GROUP BY source, lang HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return stats.duplicate_keys(table(spark, sf, "documents").withColumnRenamed("source", "body"), ["body", "lang"])


@query(
    "duplicate_content",
    """SELECT sha256(text) AS content_hash, count(*) AS n_docs, min(doc_id) AS first_identifier,
         CAST(sum(strlen(text)) AS BIGINT) AS total_length
       FROM documents WHERE text <> '' GROUP BY 1 HAVING count(*) > 1""",
)
def duplicate_content(spark, sf):
    return stats.duplicate_content(table(spark, sf, "documents"), content="text", key="doc_id")


@query(
    "path_collisions",
    r"""WITH p AS (SELECT regexp_replace(source || '/' || lang, '[^\p{L}\p{N}_-]', '', 'g') AS object_path, text AS identifier
                  FROM documents)
       SELECT object_path, count(DISTINCT identifier) AS n_identifiers, min(identifier) AS first_identifier,
              max(identifier) AS last_identifier, count(*) AS n_rows
       FROM p GROUP BY object_path HAVING count(DISTINCT identifier) > 1""",
)
def path_collisions(spark, sf):
    name = F.concat("source", F.lit("/"), "lang")
    docs = table(spark, sf, "documents").select(fn.safe_id(name).alias("object_path"), F.col("text").alias("identifier"))
    return merge.path_collisions(docs)
