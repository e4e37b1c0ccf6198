"""Landing: listing rows and fetched pages -> items -> stored bytes -> versioned metadata."""

from pyspark.sql import DataFrame, functions as F

from ..functions import (
    content_hash,
    identifier_or_url,
    object_path,
    partition_month,
    regex_date,
    resolve_found_date,
)
from ..operators.links import attachments
from ..operators.lookup import with_body_name
from ..operators.merge import landing_merge
from ..schemas import CAPTURE_COLS
from ..session import discard, scratch_path, stored
from ..sources.blobs import LAYOUT, blob_rows, read_blobs, write_blobs, write_new_blobs
from ..sources.tables import merge_months
from .stages import Stage, run_stages


def link_join(listing: DataFrame, pages: DataFrame, link="link", url="url") -> DataFrame:
    """Listing rows with the page their link leads to; links that were not fetched drop out."""
    return listing.join(pages, F.col(link) == F.col(url))


def page_facts(pages: DataFrame, key="page_id", url="url", html="html", window=None) -> DataFrame:
    """What an item needs from its page, so that the markup itself takes no part in joins.

    ``window`` limits the search for a date to that many leading characters.
    """
    found = pages.select(key, url, regex_date(html, window).alias("page_date"))
    return found.join(attachments(pages, key, url, html), key, "left").drop(key)


def build_items(listing: DataFrame, pages: DataFrame, bodies: DataFrame, run_ts: str, key="page_id", window=None) -> DataFrame:
    """Item metadata from listing rows (``link, identifier_text, date_text, body_id, partition``)."""
    joined = with_body_name(link_join(listing, page_facts(pages, key, window=window)), bodies)
    day = resolve_found_date("date_text", "page_date", "url")
    identifier = identifier_or_url("identifier_text", "url")
    return joined.select(
        identifier.alias("identifier"),
        identifier.alias("title"),
        F.lit(None).cast("string").alias("description"),
        F.date_format(day, "yyyy-MM-dd").alias("date"),
        F.col("body_name").alias("body"),
        F.coalesce("doc_url", "url").alias("link_to_doc"),
        partition_month(day, "partition").alias("partition_date"),
        F.col("url").alias("source_url"),
        F.lit(run_ts).alias("scraped_at"),
        F.coalesce("doc_type", F.lit("html")).alias("document_type"),
    )


def with_item_content(items: DataFrame, fetched: DataFrame) -> DataFrame:
    """Adds ``document_content`` from fetched ``(url, content)`` by the document link.

    An attachment that could not be fetched leaves an item of type html without content.
    """
    bodies = fetched.select(F.col("url").alias("link_to_doc"), F.col("content").alias("document_content"))
    joined = items.join(bodies, "link_to_doc", "left")
    return joined.withColumn(
        "document_type", F.when(F.col("document_content").isNull(), "html").otherwise(F.col("document_type"))
    )


def items_from_pages(listing: DataFrame, pages: DataFrame, files: DataFrame, bodies: DataFrame, run_ts: str, key="page_id") -> DataFrame:
    """Captured items, ready to land, from listing rows, fetched pages and fetched files ``(url, content)``.

    An item without an attachment has the bytes of its page. Markup and files take part in one join, by
    their address; metadata is made from narrow facts of the pages.
    """
    fetched = pages.select("url", F.col("html").cast("binary").alias("content")).unionByName(files.select("url", F.col("content").cast("binary").alias("content")))
    return with_item_content(build_items(listing, pages, bodies, run_ts, key), fetched)


def _hashed(items: DataFrame) -> DataFrame:
    return items.withColumn("file_hash", content_hash("document_content"))


def _located(items: DataFrame) -> DataFrame:
    return items.withColumn("file_path", object_path("body", "partition_date", "identifier", "document_type"))


LANDING_STAGES = [
    Stage("hash", _hashed, "file_hash IS NULL", "no document content"),
    Stage("store", _located, "identifier IS NULL", "no identifier"),
]
#: The same for items that were stored with their hashes.
_STORED_STAGES = [LANDING_STAGES[0]._replace(apply=lambda items: items), *LANDING_STAGES[1:]]


def store_items(items: DataFrame, store: str, run_ts: str, by=LAYOUT) -> DataFrame:
    """Hash and store items; returns the rejects.

    ``by`` is the directory layout: body and month suit few bodies with many documents each.
    The stored rows carry the item metadata along with the bytes, so that content is read and
    shuffled once and the metadata step reads narrow columns back.
    """
    passed, rejects = run_stages(items, LANDING_STAGES)
    keep = [c for c in passed.columns if c in CAPTURE_COLS and c not in ("body", "partition_date", "file_path")]
    # Partition values of a directory layout cannot be null or empty.
    named = passed.withColumns(
        {
            "body": F.coalesce("body", F.lit("unknown")),
            "partition_date": F.coalesce("partition_date", F.lit("unknown")),
            "run_ts": F.lit(run_ts),
        }
    )
    write_blobs(blob_rows(named, keep=["identifier", *keep, "run_ts"]), store, by=by)
    return rejects


def land(items: DataFrame, table: str, store: str, run_ts: str, by=LAYOUT) -> tuple[DataFrame, DataFrame]:
    """Lands items in a table and a store that stay in place; (``identifier, action``, rejected items).

    Items are made once: written with their hashes as they come, unshuffled, and removed when they have
    landed. Off narrow columns of these rows, captures that the store has already are found by path and
    hash, so that only new bytes are shuffled and stored, and the table is merged in the months that
    the items touch. Neither step reads what other runs stored. An item that comes back to earlier
    content finds it where it was.
    """
    spark, folder = items.sparkSession, scratch_path(items.sparkSession, "captured")
    hashed = _hashed(items)
    hashed.write.parquet(folder)
    # Stages and their conditions would work out the bytes again for each test on rows that are not stored.
    passed, rejects = run_stages(spark.read.schema(hashed.schema).parquet(folder), _STORED_STAGES)
    rejects, _, _ = stored(rejects, "rejects")
    named = passed.withColumns({"body": F.coalesce("body", F.lit("unknown")), "partition_date": F.coalesce("partition_date", F.lit("unknown"))})
    captured = named.drop("document_content")
    keys = captured.select(F.col("file_path").alias("object_path"), "file_hash")
    keep = [c for c in passed.columns if c in CAPTURE_COLS and c not in ("body", "partition_date", "file_path")]
    write_new_blobs(blob_rows(named, keep=["identifier", *keep]), keys, store, run_ts, by)
    actions = merge_months(spark, table, captured, run_ts)
    discard(spark, folder)
    return actions, rejects


def landing_run(
    items: DataFrame, existing: DataFrame, store: str, run_ts: str, by=LAYOUT
) -> tuple[DataFrame, DataFrame]:
    """(landing table with an ``action`` column, rejected items)."""
    rejects = store_items(items, store, run_ts, by)
    captured = (
        read_blobs(items.sparkSession, store)
        .where(F.col("run_ts") == run_ts)
        .withColumnRenamed("object_path", "file_path")
        .drop("content", "content_type", "length", "capture_id", "run_ts")
    )
    return landing_merge(existing, captured, run_ts), rejects
