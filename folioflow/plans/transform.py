"""Transform: landing rows in a date range -> cleaned or copied documents -> versioned metadata."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import content_type, next_version, transformed_path
from ..operators.clean import with_cleaned
from ..operators.filters import filter_by_date, is_html
from ..operators.merge import TRANSFORMED_COLS, _action, _latest_transformed, _merge, _version_of, with_current
from ..schemas import TRANSFORMED
from ..sources.blobs import attach_content, in_months_of

_COLUMNS = [f.name for f in TRANSFORMED]
#: Raise it when the rules of cleaning change, so that stored documents are cleaned again.
CLEANER_VERSION = 1


def _project(df: DataFrame, ext, new_hash: Column, version: Column, is_copy: Column, run_ts: str) -> dict:
    """Transformed-table columns by name."""
    return {
        "identifier": F.col("identifier"),
        "title": F.col("title"),
        "description": F.col("description"),
        "date": F.col("date"),
        "body": F.col("body"),
        "original_link": F.col("link_to_doc"),
        "original_file_path": F.col("file_path"),
        "original_hash": F.col("file_hash"),
        "transformed_file_path": transformed_path("body", "partition_date", "identifier", ext),
        "new_hash": new_hash,
        "document_type": F.coalesce("document_type", F.lit("html")),
        "partition_date": F.coalesce("partition_date", F.lit("unknown")),
        "transformed_at": F.lit(run_ts),
        "version": version.cast("int"),
        "is_copy": is_copy,
        "cleaner_version": F.when(~is_copy, F.lit(CLEANER_VERSION)),
    }


def _select(df: DataFrame, columns: dict, *more) -> DataFrame:
    return df.select(*[c.alias(name) for name, c in columns.items()], *more)


def transformed_rows(df: DataFrame, run_ts: str, new_hash="new_hash", known="known", old_version="old_version") -> DataFrame:
    """Transformed-table rows of cleaned documents."""
    version = next_version(F.col(known), old_version)
    return _select(df, _project(df, F.lit("html"), F.col(new_hash), version, F.lit(False), run_ts))


def copied_rows(df: DataFrame, run_ts: str, content="content") -> DataFrame:
    """Transformed-table rows of documents copied as they are: flagged, no version of their own."""
    return _select(
        df, _project(df, F.col("document_type"), F.sha2(content, 256), F.lit(None), F.lit(True), run_ts)
    )


def select_documents(landing, existing, start, end) -> DataFrame:
    """Narrow rows of the documents in a date range, with what is stored of each.

    ``settled`` documents need no bytes: cleaned by the present rules already, from the same bytes.
    Copies are always written anew.
    """
    selected = filter_by_date(landing, start, end).drop("version", "created_at", "updated_at", "doc_date")
    if "cleaner_version" not in existing.columns:
        return with_current(selected, existing, "new_hash").withColumn("settled", F.lit(False))
    narrow = with_current(selected, existing, "new_hash", more=("original_hash", "cleaner_version"))
    same = F.col("known") & (F.col("old_original_hash") == F.col("file_hash")) & (F.col("old_cleaner_version") == CLEANER_VERSION)
    settled = F.coalesce(is_html() & same & F.col("old_hash").isNotNull(), F.lit(False))
    return narrow.withColumn("settled", settled).drop("old_original_hash", "old_cleaner_version")


def transform_results(landing, blobs, existing, start, end, run_ts: str) -> DataFrame:
    """One row per selected document: transformed columns, status and, if it is to be stored, its bytes.

    The stored hash and version are joined to the narrow rows first; bytes are joined last and
    cross one shuffle. Cleaning runs in place on the rows that need it, so that html and other
    documents are read once and no union is needed.
    """
    return results_of(select_documents(landing, existing, start, end), blobs, run_ts)


def results_of(narrow: DataFrame, blobs: DataFrame, run_ts: str) -> DataFrame:
    """Results for the rows of ``select_documents``. Write these first if the months they name should be found once."""
    needed = narrow.where(~F.col("settled"))
    wanted = narrow.withColumn("_wanted", F.when(~F.col("settled"), F.col("file_path")))
    full = attach_content(wanted, in_months_of(blobs, needed), "_wanted")
    html = is_html()
    cleaned = with_cleaned(full, F.when(html & (F.octet_length("content") > 0), F.col("content")))
    output = F.when(html, F.col("cleaned").cast("binary")).otherwise(F.col("content"))
    ready = cleaned.withColumn("_output", output).withColumn("_new_hash", F.sha2("_output", 256))
    status = (
        F.when(F.col("content").isNull() | (F.octet_length("content") == 0), "skipped")
        .when(F.col("clean_error").isNotNull(), "failed")
        .when(html & F.col("known") & F.col("old_hash").eqNullSafe(F.col("_new_hash")), "skipped")
        .when(F.col("identifier").isNull(), "failed")
        .otherwise("transformed")
    )
    version = F.when(html, next_version(F.col("known"), "old_version"))
    ext = F.when(html, "html").otherwise(F.col("document_type"))
    columns = _project(ready, ext, F.col("_new_hash"), version, ~html, run_ts)
    return _select(
        ready.withColumn("_status", status),
        columns,
        F.col("_status").alias("status"),
        F.when(html, "text/html").otherwise(content_type("document_type")).alias("content_type"),
        F.when(F.col("_status") == "transformed", F.col("_output")).alias("content"),
    )


def apply_results(existing: DataFrame, results: DataFrame) -> DataFrame:
    """Merge transformed rows into the table in one join.

    Cleaned documents are versioned by hash; copies are always written and keep their version.
    """

    def action(old, new):
        return (
            F.when(new.isNull(), "kept")
            .when(new["is_copy"], "copy")
            .otherwise(_action(old.isNotNull(), old["new_hash"], new["new_hash"]))
        )

    def version(stored, writes, act):
        return F.when(act == "copy", stored).otherwise(_version_of(stored, writes, act))

    rows = _latest_transformed(results.where(F.col("status") == "transformed").select(*_COLUMNS))
    return _merge(existing, rows, "identifier", TRANSFORMED_COLS, action, {"version": version}).drop("action")


def transform_run(landing, blobs, existing, start, end, run_ts: str) -> tuple[DataFrame, DataFrame]:
    """(transformed table, results with status). Write the results once and read both off that."""
    results = transform_results(landing, blobs, existing, start, end, run_ts)
    return apply_results(existing, results), results
