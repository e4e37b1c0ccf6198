"""Document bytes as a table keyed by object path."""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions import content_length, content_type
from ..schemas import BLOBS
from ..session import path_exists, scratch_path


#: Default directory layout of stored documents.
LAYOUT = ("body", "partition_date")
#: Directory columns that stay text.
_NAMES = (*LAYOUT, "run_ts")
#: Folder of a store that lists its captures without their bytes; readers of the store pass over it.
_INDEX = "_captures"


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """A stored table with its directory columns as text, whatever their values look like."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name in _NAMES else f for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def in_months_of(blobs: DataFrame, meta: DataFrame) -> DataFrame:
    """Blobs in the month directories that ``meta`` names; the other directories are not read.

    A join on the directory column, so that Spark prunes directories while the job runs. There is one
    month per directory of the store at most, which bounds what is broadcast. A null month in
    ``meta`` stands for ``unknown``, as in the layout.
    """
    if "partition_date" not in blobs.columns:
        return blobs
    months = meta.select(F.coalesce("partition_date", F.lit("unknown")).alias("partition_date"))
    # No directory has an empty name; Spark prunes by a side that has a condition.
    return blobs.join(F.broadcast(months.where("partition_date > ''").distinct()), "partition_date", "left_semi")


def read_binary_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Loose files below ``root`` as a blob table; the object path is relative to it."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    relative = F.substring_index(F.col("path"), root.rstrip("/") + "/", -1)
    return files.select(
        relative.alias("object_path"),
        "content",
        content_type(F.regexp_extract(relative, r"\.([^./]+)$", 1)).alias("content_type"),
        "length",
    )


def blob_rows(df: DataFrame, path="file_path", content="document_content", ext="document_type", keep=()) -> DataFrame:
    """Rows to store: those with content, plus their content type and length."""
    body = F.col(content).cast("binary")
    return df.where(F.octet_length(body) > 0).select(
        "body",
        "partition_date",
        F.col(path).alias("object_path"),
        body.alias("content"),
        content_type(ext).alias("content_type"),
        content_length(body).alias("length"),
        *keep,
    )


def write_partitioned(df: DataFrame, path: str, by=LAYOUT, mode="append", seen: Observation | None = None, counts=()) -> None:
    """Write by body and month.

    The rebalance hint gives one shuffle in which small months share a task and a body
    that holds a large share of all rows is split over many. ``counts`` are taken by ``seen`` in the
    tasks that write, so that a repeated shuffle task does not count twice.
    """
    rows = df.hint("rebalance", *by)
    if seen is not None:
        rows = rows.observe(seen, *counts)
    rows.write.mode(mode).partitionBy(*by).parquet(path)


def write_blobs(df: DataFrame, path: str, by=LAYOUT, mode="append") -> None:
    """Store captures. A capture never removes what is stored already; readers take the latest."""
    write_partitioned(df.withColumn("capture_id", F.uuid()), path, by, mode)


def stored_captures(spark: SparkSession, store: str) -> DataFrame:
    """``(object_path, file_hash, run_ts)`` of what a store holds, read without the bytes."""
    index = f"{store.rstrip('/')}/{_INDEX}"
    if path_exists(spark, index):
        return spark.read.schema("object_path string, file_hash string, run_ts string").parquet(index)
    return spark.createDataFrame([], "object_path string, file_hash string, run_ts string")


def write_new_blobs(rows: DataFrame, keys: DataFrame, store: str, run_ts: str, by=LAYOUT) -> DataFrame:
    """Stores the captures that the store lacks, below a directory of their run; returns their keys.

    ``rows`` are blob rows with ``file_hash``, ``keys`` their paths and hashes without the bytes. What is
    new is settled among the keys; bytes stored already drop out before anything is shuffled
    where the new keys are few, and take part in one join otherwise.
    """
    spark, index = rows.sparkSession, f"{store.rstrip('/')}/{_INDEX}"
    known = stored_captures(spark, store).select("object_path", "file_hash")
    fresh = keys.select("object_path", "file_hash").distinct().join(known, ["object_path", "file_hash"], "left_anti")
    folder = f"{index}/run_ts={run_ts}"
    pending = scratch_path(spark, "new-captures")
    fresh.write.parquet(pending)
    fresh = spark.read.schema("object_path string, file_hash string").parquet(pending)
    new = rows.join(fresh, ["object_path", "file_hash"], "left_semi").withColumn("run_ts", F.lit(run_ts))
    write_blobs(new, store, ("run_ts", *by))
    # Listed once the bytes are there: a run that broke off before stores them again.
    fresh.write.mode("append").parquet(folder)
    return fresh


def latest_captures(store: DataFrame, order=("scraped_at", "file_hash")) -> DataFrame:
    """(object_path, capture_id) of the last capture of each path, from narrow columns only."""
    last = store.groupBy("object_path").agg(F.max(F.struct(*order, "capture_id")).alias("_last"))
    return last.select("object_path", F.col("_last.capture_id").alias("capture_id"))


def hashed_captures(store: DataFrame) -> DataFrame:
    """(object_path, file_hash, capture_id) of one capture of each path with each hash."""
    return store.groupBy("object_path", "file_hash").agg(F.max("capture_id").alias("capture_id"))


def latest_blobs(store: DataFrame, order=("scraped_at", "file_hash")) -> DataFrame:
    return store.join(latest_captures(store, order).select("capture_id"), "capture_id", "left_semi")


def attach_content(meta: DataFrame, blobs: DataFrame, path: str = "file_path") -> DataFrame:
    """Left join of metadata to bytes; a missing object gives null content.

    ``blobs`` is a table with one row per path or a store of captures. Of a store, a capture is found
    among narrow rows first, so that the bytes take part in one join only: one with the hash that the
    metadata names, or, where they name none, the latest of the path.
    Rows without an object get a key of their own, so that failed downloads do not all meet
    in one task.
    """
    spread = F.concat(F.lit("\u0000"), F.coalesce("identifier", F.lit("")))
    wanted, stored = meta.withColumn("_key", F.coalesce(F.col(path), spread)), "object_path"
    if "capture_id" in blobs.columns:
        by_hash = "file_hash" in meta.columns and "file_hash" in blobs.columns
        captures = (hashed_captures(blobs) if by_hash else latest_captures(blobs)).withColumnRenamed("object_path", "_key")
        located = wanted.join(captures, ["_key", "file_hash"] if by_hash else "_key", "left")
        wanted, stored = located.withColumn("_key", F.coalesce("capture_id", spread)), "capture_id"
    bodies = blobs.select(F.col(stored).alias("_key"), "content")
    if stored == "capture_id":
        # Captures that nobody asked for drop out before the bytes are dealt.
        asked = wanted.where(F.col("capture_id").isNotNull()).select(F.col("capture_id").alias("_key"))
        bodies = bodies.join(asked, "_key", "left_semi")
    return wanted.join(bodies, "_key", "left").select(*meta.columns, "content")


def with_existing_blob(df: DataFrame, blobs: DataFrame, path: str = "file_path") -> DataFrame:
    return df.join(blobs.select(F.col("object_path").alias(path)), path, "left_semi")


def with_missing_blob(df: DataFrame, blobs: DataFrame, path: str = "file_path") -> DataFrame:
    return df.join(blobs.select(F.col("object_path").alias(path)), path, "left_anti")


def empty_blobs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BLOBS)
