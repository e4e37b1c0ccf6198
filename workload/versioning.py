"""Versioning, merge and dedupe."""

from pyspark.sql import functions as F

from folioflow.operators import history, merge, stats

from .registry import query
from .views import (
    CTE,
    META,
    META_SQL,
    OLD_TS,
    RUN_TS,
    ctes,
    landing,
    landing_meta,
    landing_prev,
    observations,
    table,
)

_STATUS = """SELECT l.identifier, CASE WHEN p.identifier IS NULL THEN 'insert' WHEN p.file_hash = l.file_hash THEN 'unchanged'
    ELSE 'update' END AS action,
  CAST(CASE WHEN p.identifier IS NULL THEN 1 WHEN p.file_hash = l.file_hash THEN p.version ELSE p.version + 1 END AS INTEGER) AS new_version
  FROM landing l LEFT JOIN landing_prev p USING (identifier)"""


def _status(spark, sf):
    return merge.change_status(landing_meta(spark, sf), landing_prev(spark, sf))


@query("change_status", ctes("docs", "landing", "landing_prev") + _STATUS)
def change_status(spark, sf):
    return _status(spark, sf).select("identifier", "action", "new_version")


@query(
    "upsert_counts",
    ctes("docs", "landing", "landing_prev")
    + f"""SELECT count(*) FILTER (action = 'insert') AS upserted, count(*) FILTER (action = 'update') AS modified,
            count(*) FILTER (action = 'unchanged') AS unchanged, count(*) FILTER (action <> 'unchanged') AS total_ops
          FROM ({_STATUS})""",
)
def upsert_counts(spark, sf):
    return stats.upsert_counts(_status(spark, sf))


@query(
    "changed_only",
    ctes("docs", "landing", "landing_prev")
    + """SELECT l.identifier, l.file_hash FROM landing l LEFT JOIN landing_prev p USING (identifier)
         WHERE p.file_hash IS DISTINCT FROM l.file_hash""",
)
def changed_only(spark, sf):
    return merge.changed_only(landing_meta(spark, sf), landing_prev(spark, sf)).select("identifier", "file_hash")


def upserted_sql(version="p.version"):
    picked = ", ".join(
        "l.identifier" if c == "identifier" else f"CASE WHEN p.file_hash = l.file_hash THEN p.{c} ELSE l.{c} END AS {c}"
        for c in META
    )
    return f"""SELECT {picked},
      CAST(CASE WHEN p.identifier IS NULL THEN 1 WHEN p.file_hash = l.file_hash THEN {version} ELSE {version} + 1 END AS INTEGER) AS version,
      CASE WHEN p.identifier IS NULL THEN '{RUN_TS}' ELSE p.created_at END AS created_at,
      CASE WHEN p.identifier IS NOT NULL AND p.file_hash <> l.file_hash THEN '{RUN_TS}' ELSE p.updated_at END AS updated_at
      FROM landing l LEFT JOIN landing_prev p ON l.identifier = p.identifier"""


@query("landing_upsert", ctes("docs", "landing", "landing_prev") + upserted_sql())
def landing_upsert(spark, sf):
    return merge.landing_upsert(landing_prev(spark, sf), landing_meta(spark, sf), RUN_TS)


TRANSFORMED_SQL = """identifier, title, description, date, body, original_link, original_file_path, original_hash,
  transformed_file_path, new_hash, document_type, partition_date, transformed_at, version, is_copy"""


def tnew_cte(source: str, output: str, content: str) -> str:
    """Rows the transform would write for every document."""
    return f"""tnew AS (
  SELECT doc_id, identifier, title, description, date, body, link_to_doc AS original_link, file_path AS original_file_path,
         sha256({content}) AS original_hash,
         body || '/' || partition_date || '/' || identifier || CASE WHEN document_type = 'pdf' THEN '.pdf' ELSE '.html' END AS transformed_file_path,
         sha256({output}) AS new_hash, document_type, partition_date, '{RUN_TS}' AS transformed_at, document_type = 'pdf' AS is_copy
  FROM {source})"""


CTE["tnew_text"] = tnew_cte("landing", "content", "content")
CTE["tprev"] = f"""tprev AS (
  SELECT doc_id, identifier, title, description, date, body, original_link, original_file_path, original_hash, transformed_file_path,
         CASE WHEN doc_id % 3 = 0 THEN new_hash ELSE sha256('old' || new_hash) END AS new_hash,
         document_type, partition_date, '{OLD_TS}' AS transformed_at, CAST(1 + doc_id % 4 AS INTEGER) AS version, is_copy
  FROM tnew WHERE doc_id % 3 < 2)"""


def tnew(landing_rows, new_hash):
    """Spark side of ``tnew``; keeps ``doc_id``."""
    pdf = F.col("document_type") == "pdf"
    folder = F.concat("body", F.lit("/"), "partition_date", F.lit("/"), "identifier")
    return landing_rows.select(
        "doc_id",
        "identifier",
        "title",
        "description",
        "date",
        "body",
        F.col("link_to_doc").alias("original_link"),
        F.col("file_path").alias("original_file_path"),
        F.col("file_hash").alias("original_hash"),
        F.concat(folder, F.when(pdf, ".pdf").otherwise(".html")).alias("transformed_file_path"),
        new_hash.alias("new_hash"),
        "document_type",
        "partition_date",
        F.lit(RUN_TS).alias("transformed_at"),
        F.lit(None).cast("int").alias("version"),
        pdf.alias("is_copy"),
    )


def tprev(rows):
    """The table as an earlier run left it: two thirds of the documents, half of them changed since."""
    old = F.sha2(F.concat(F.lit("old"), "new_hash"), 256)
    return rows.where(F.col("doc_id") % 3 < 2).withColumns(
        {
            "new_hash": F.when(F.col("doc_id") % 3 == 0, F.col("new_hash")).otherwise(old),
            "transformed_at": F.lit(OLD_TS),
            "version": (F.lit(1) + F.col("doc_id") % 4).cast("int"),
        }
    ).drop("doc_id")


def _tnew_text(spark, sf):
    return tnew(landing(spark, sf), F.sha2("content", 256))


_NEW_COLS = ["title", "description", "date", "body", "original_link", "original_file_path", "original_hash",
             "transformed_file_path", "new_hash", "document_type", "partition_date", "transformed_at", "is_copy"]


def merged_sql(source: str, writes: str, version: str) -> str:
    """``tprev`` merged with the rows of ``source``; ``writes`` tells which of them are written."""
    picked = ", ".join(f"CASE WHEN {writes} THEN n.{c} ELSE p.{c} END AS {c}" for c in _NEW_COLS)
    return f"""SELECT coalesce(n.identifier, p.identifier) AS identifier, {picked}, CAST({version} AS INTEGER) AS version
      FROM tprev p FULL JOIN {source} n ON p.identifier = n.identifier"""


VERSIONED = "CASE WHEN p.identifier IS NULL THEN 1 WHEN n.identifier IS NULL OR n.new_hash = p.new_hash THEN p.version ELSE p.version + 1 END"
CHANGED = "n.identifier IS NOT NULL AND n.new_hash IS DISTINCT FROM p.new_hash"


@query(
    "transformed_upsert",
    ctes("docs", "landing", "tnew_text", "tprev") + merged_sql("(SELECT * FROM tnew WHERE NOT is_copy)", CHANGED, VERSIONED),
)
def transformed_upsert(spark, sf):
    rows = _tnew_text(spark, sf)
    return merge.transformed_upsert(tprev(rows), rows.where(~F.col("is_copy")).drop("doc_id"))


@query(
    "copy_upsert",
    ctes("docs", "landing", "tnew_text", "tprev")
    + merged_sql("(SELECT * FROM tnew WHERE is_copy)", "n.identifier IS NOT NULL", "p.version"),
)
def copy_upsert(spark, sf):
    rows = _tnew_text(spark, sf)
    return merge.copy_upsert(tprev(rows), rows.where("is_copy").drop("doc_id"))


CTE["captures"] = """captures AS (
  SELECT CAST(user_id AS VARCHAR) AS identifier, strftime(ts, '%Y-%m-%dT%H') AS scraped_at, sha256(event_type) AS file_hash,
         event_type AS title FROM events)"""
CTE["stored"] = "stored AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS identifier FROM events WHERE user_id % 3 = 0)"


def _captures(spark, sf):
    """Many captures per identifier, with ties in time and equal rows."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("identifier"),
        F.date_format("ts", "yyyy-MM-dd'T'HH").alias("scraped_at"),
        F.sha2("event_type", 256).alias("file_hash"),
        F.col("event_type").alias("title"),
    )


_RANKED = """SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY scraped_at {0}, file_hash {0}) AS rn FROM captures"""


@query(
    "dedupe_latest",
    ctes("captures") + f"SELECT identifier, scraped_at, file_hash, title FROM ({_RANKED.format('DESC')}) WHERE rn = 1",
)
def dedupe_latest(spark, sf):
    return merge.dedupe_latest(_captures(spark, sf))


def _insert_new(spark, sf):
    captures = _captures(spark, sf)
    stored = captures.where(F.col("identifier").cast("int") % 3 == 0).select("identifier").distinct()
    return merge.insert_new(stored, captures)


@query(
    "insert_new",
    ctes("captures", "stored")
    + f"""SELECT identifier, scraped_at, file_hash, title FROM ({_RANKED.format('ASC')})
          WHERE rn = 1 AND identifier NOT IN (SELECT identifier FROM stored)""",
)
def insert_new(spark, sf):
    return _insert_new(spark, sf)[0]


@query(
    "insert_rejected",
    ctes("captures", "stored")
    + f"""SELECT identifier, scraped_at, file_hash, title, count(*) AS copies FROM ({_RANKED.format('ASC')})
          WHERE rn > 1 OR identifier IN (SELECT identifier FROM stored) GROUP BY ALL""",
)
def insert_rejected(spark, sf):
    return _insert_new(spark, sf)[1]


@query(
    "update_existing",
    ctes("docs", "landing", "landing_prev")
    + f"""SELECT p.identifier, l.title, p.description, CASE WHEN doc_id % 2 = 0 THEN l.date END AS date, p.body, p.link_to_doc,
            p.partition_date, p.file_path, l.file_hash, p.source_url, p.scraped_at, p.document_type, p.version, p.created_at, p.updated_at,
            doc_id % 2 = 1 OR p.file_hash <> l.file_hash AS changed
          FROM landing_prev p JOIN landing l USING (identifier)""",
)
def update_existing(spark, sf):
    rows = landing(spark, sf).withColumn("date", F.when(F.col("doc_id") % 2 == 0, F.col("date")))
    return merge.update_existing(landing_prev(spark, sf), rows, ["title", "date", "file_hash"])


_HISTORY = ctes("observations", "history") + "SELECT identifier, seen_at, event_id, file_hash, version FROM history"


@query("version_history", _HISTORY)
def version_history(spark, sf):
    return history.version_history(observations(spark, sf))


@query("version_history_segmented", _HISTORY)
def version_history_segmented(spark, sf):
    """The same, cut into many segments of time."""
    return history.version_history(observations(spark, sf), segment_rows=200)


@query(
    "history_summary",
    ctes("observations", "history")
    + """SELECT identifier, arg_min(file_hash, (seen_at, event_id)) AS first_hash, arg_max(file_hash, (seen_at, event_id)) AS last_hash,
           CAST(max(version) - 1 AS INTEGER) AS changes FROM history GROUP BY identifier""",
)
def history_summary(spark, sf):
    return history.history_summary(observations(spark, sf))
