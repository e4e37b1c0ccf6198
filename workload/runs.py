"""End-to-end runs, batch and streaming."""

from pyspark.sql import functions as F

from folioflow.operators import stats
from folioflow.plans import landing as landing_plan
from folioflow.plans import transform
from folioflow.plans.stages import run_stages
from folioflow.plans.workflow import Paths, run_workflow
from folioflow.session import scratch_path
from folioflow.streaming import upsert, versions

from .registry import query
from .versioning import CHANGED, merged_sql, tnew, tnew_cte, tprev, upserted_sql
from .views import CTE, META, OLD_TS, RUN_TS, blobs, cleaned_html, ctes, html_content, landing, landing_prev, observations

# These tables have many bodies with few documents each: month directories are enough.
MONTHLY = ("partition_date",)
START, END = "2020-03-01", "2023-06-30"


def _items(spark, sf, content=None):
    """Landing rows as captured items, with their bytes and before they are hashed and placed."""
    rows = landing(spark, sf, content)
    return rows.drop("doc_id", "d", "t", "file_hash", "file_path").withColumn(
        "document_content", F.col("content").cast("binary")
    ).drop("content")


@query("landing_run", ctes("docs", "landing", "landing_prev") + upserted_sql())
def landing_run(spark, sf):
    """Hash, store and upsert whole captures; returns the landing table."""
    merged, _ = landing_plan.landing_run(_items(spark, sf), landing_prev(spark, sf), scratch_path(spark, "store"), RUN_TS, MONTHLY)
    return merged.drop("action")


@query(
    "landing_rejects",
    """SELECT CASE WHEN doc_id % 7 <> 3 THEN 'DOC-' || doc_id END AS identifier, CASE WHEN doc_id % 5 = 2 THEN 'hash' ELSE 'store' END AS stage,
         CASE WHEN doc_id % 5 = 2 THEN 'no document content' ELSE 'no identifier' END AS reason
       FROM documents WHERE doc_id % 5 = 2 OR doc_id % 7 = 3""",
)
def landing_rejects(spark, sf):
    """Items that do not land: failed downloads and items without an identifier."""
    n = landing(spark, sf).select("identifier", "doc_id")
    failed = F.when(F.col("doc_id") % 5 != 2, F.col("document_content"))
    named = F.when(F.col("doc_id") % 7 != 3, F.col("identifier"))
    items = _items(spark, sf).join(n, "identifier").withColumns({"document_content": failed, "identifier": named}).drop("doc_id")
    _, rejects = run_stages(items, landing_plan.LANDING_STAGES)
    return rejects


CTE["landing_html"] = "landing_html AS (SELECT landing.*, c.content AS html, output FROM landing JOIN doc_content c USING (doc_id))"
CTE["tnew_html"] = tnew_cte("landing_html", "output", "html")
_SELECTED = "doc_id % 5 <> 4 AND d BETWEEN DATE '2020-03-01' AND DATE '2023-06-30'"
CTE["selected"] = f"selected AS (SELECT tnew.* FROM tnew JOIN docs USING (doc_id) WHERE {_SELECTED})"
_VIEWS = ctes("docs", "landing", "wrapped", "cleaned", "doc_content", "landing_html", "tnew_html", "tprev", "selected")


def _results(spark, sf):
    rows = landing(spark, sf, html_content())
    output = F.when(F.col("document_type") == "pdf", F.col("content")).otherwise(cleaned_html())
    existing = tprev(tnew(rows, F.sha2(output, 256)))
    stored = rows.drop("doc_id", "d", "t", "content").withColumns(
        {"version": F.lit(1), "created_at": F.lit(OLD_TS), "updated_at": F.lit(None).cast("string")}
    )
    contents = blobs(spark, sf, html_content())
    return existing, transform.transform_results(stored, contents, existing, START, END, RUN_TS)


@query(
    "transform_run",
    _VIEWS
    + merged_sql(
        "(SELECT * FROM selected WHERE doc_id % 11 <> 0)",
        f"CASE WHEN n.is_copy THEN true ELSE {CHANGED} END",
        """CASE WHEN n.is_copy THEN p.version WHEN p.identifier IS NULL THEN 1
             WHEN n.identifier IS NULL OR n.new_hash = p.new_hash THEN p.version ELSE p.version + 1 END""",
    ),
)
def transform_run(spark, sf):
    """Select by date, fetch bytes, clean or copy, compare hashes, merge."""
    existing, results = _results(spark, sf)
    return transform.apply_results(existing, results)


_STATS = """SELECT count(*) AS total,
  count(*) FILTER (s.doc_id % 11 <> 0 AND (s.is_copy OR p.new_hash IS DISTINCT FROM s.new_hash)) AS transformed,
  count(*) FILTER (s.doc_id % 11 = 0 OR (NOT s.is_copy AND p.new_hash IS NOT DISTINCT FROM s.new_hash)) AS skipped,
  CAST(0 AS BIGINT) AS failed FROM selected s LEFT JOIN tprev p ON s.identifier = p.identifier"""


@query("transform_stats", _VIEWS + _STATS)
def transform_stats(spark, sf):
    return stats.transform_stats(_results(spark, sf)[1])


@query("run_status", _VIEWS + f"SELECT CASE WHEN failed > 0 THEN 'Failed' ELSE 'Success' END AS status, CAST(failed > 0 AS INTEGER) AS failed FROM ({_STATS})")
def run_status(spark, sf):
    return stats.run_status(stats.transform_stats(_results(spark, sf)[1]))


@query(
    "run_workflow",
    _VIEWS
    + """SELECT identifier, original_file_path, original_hash, transformed_file_path, new_hash,
           CASE WHEN is_copy THEN NULL ELSE 1 END::INTEGER AS version, is_copy, 'Success' AS status, CAST(0 AS INTEGER) AS failed
         FROM selected""",
)
def run_workflow_query(spark, sf):
    """Both phases from captured items to the transformed table, with the status of the run."""
    root = scratch_path(spark, "workflow")
    paths = Paths(f"{root}/store", None, f"{root}/landing", f"{root}/results", None, f"{root}/transformed", MONTHLY)
    items = _items(spark, sf, html_content())
    summary = run_workflow(spark, items, paths, START, END, RUN_TS).first()
    table = spark.read.parquet(paths.transformed_out)
    return table.select(
        "identifier",
        "original_file_path",
        "original_hash",
        "transformed_file_path",
        "new_hash",
        "version",
        "is_copy",
        F.lit(summary["status"]).alias("status"),
        F.lit(summary["failed"]).alias("failed"),
    )


@query("stream_upsert", ctes("docs", "landing", "landing_prev") + upserted_sql("1"))
def stream_upsert(spark, sf):
    """Two waves of captures through the streaming upsert, one run each."""
    root = scratch_path(spark, "stream-upsert")
    waves = [(landing_prev(spark, sf).select(*META), OLD_TS), (landing(spark, sf).select(*META), RUN_TS)]
    for rows, run_ts in waves:
        rows.write.mode("append").parquet(f"{root}/source")
        upsert.upsert_stream(spark, f"{root}/source", rows.schema, f"{root}/table", f"{root}/checkpoint", run_ts)
    return upsert.current_table(spark, f"{root}/table").drop("doc_date")


@query("stream_rerun", ctes("docs", "landing", "landing_prev") + upserted_sql("1"))
def stream_rerun(spark, sf):
    """The same, and then all files once more, by the old and by a new checkpoint: nothing changes."""
    root = scratch_path(spark, "stream-rerun")
    waves = [(landing_prev(spark, sf).select(*META), OLD_TS), (landing(spark, sf).select(*META), RUN_TS)]
    for i, (rows, run_ts) in enumerate(waves):
        rows.write.parquet(f"{root}/source-{i}")
        for checkpoint in ("one", "one", "two"):
            upsert.upsert_stream(spark, f"{root}/source-{i}", rows.schema, f"{root}/table", f"{root}/{checkpoint}-{i}", run_ts)
    return upsert.current_table(spark, f"{root}/table").drop("doc_date")


@query(
    "stream_versions",
    ctes("observations", "history")
    + """SELECT identifier, CAST(max(version) AS INTEGER) AS version, arg_max(file_hash, (seen_at, event_id)) AS file_hash
         FROM history GROUP BY identifier""",
)
def stream_versions(spark, sf):
    """Observations arrive in three parts; versions carry on from one run to the next."""
    root = scratch_path(spark, "stream-versions")
    rows = observations(spark, sf)
    day = F.dayofmonth("seen_at")
    for part in (day <= 10, (day > 10) & (day <= 20), day > 20):
        rows.where(part).write.mode("append").parquet(f"{root}/source")
        versions.versions_stream(spark, f"{root}/source", rows.schema, root)
    return versions.latest_versions(spark, root)
