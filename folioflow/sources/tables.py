"""The landing table: how it is stored, looked up and merged into.

Rows lie in a directory per month, sorted by document date within files, so that a date range skips
row groups by their statistics; a bloom filter per row group does the same for an identifier.
Document dates are kept as captured, in whatever format, and parsed once, into ``doc_date``.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import parse_doc_date
from ..operators.merge import dedupe_latest, landing_merge
from ..schemas import LANDING
from ..session import discard, path_exists, scratch_path

MONTH = "partition_date"
UNKNOWN = "unknown"


def with_doc_date(df: DataFrame) -> DataFrame:
    """Adds or renews ``doc_date``."""
    return df.withColumn("doc_date", parse_doc_date("date"))


def in_named_month(df: DataFrame) -> DataFrame:
    """Directories cannot have a null name."""
    return df.withColumn(MONTH, F.coalesce(MONTH, F.lit(UNKNOWN)))


def write_landing(df: DataFrame, path: str, mode="overwrite", row_group_bytes=None) -> None:
    """Stores rows by month. With ``overwrite``, only the months that the rows name are replaced."""
    rows = with_doc_date(in_named_month(df)).hint("rebalance", MONTH).sortWithinPartitions(MONTH, "doc_date", "identifier")
    writer = rows.write.mode(mode).partitionBy(MONTH).option("partitionOverwriteMode", "dynamic")
    writer = writer.option("parquet.bloom.filter.enabled#identifier", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def read_landing(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The stored table in the order of ``LANDING``; a table without ``doc_date`` gets it on the way."""
    found = spark.read.parquet(path).schema
    # Directory names stay text, whatever they look like.
    df = spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) if f.name == MONTH else f for f in found])).parquet(path)
    if "doc_date" not in df.columns:
        df = with_doc_date(df)
    df = df.select(*[f.name for f in LANDING if f.name in df.columns])
    return df if where is None else df.where(where)


def months_touched(table: DataFrame, batch: DataFrame) -> list[str]:
    """The months that a batch names and those where its identifiers are stored now.

    One value per directory, of which the driver holds the listing anyway. Of the table, only
    identifiers are read.
    """
    stored = table.select("identifier", MONTH).join(batch.select("identifier"), "identifier", "left_semi")
    return sorted(r[0] for r in stored.select(MONTH).union(batch.select(MONTH)).distinct().collect())


def merge_months(spark: SparkSession, path: str, batch: DataFrame, run_ts: str) -> DataFrame:
    """Merges a batch into the stored table in place and returns ``identifier, action`` of the rows it read.

    Only the months that the batch touches are read and replaced. The merged rows are written to
    the shared folder first: if replacing the months breaks off, merging again gives the same table.
    A row whose month changes leaves its old directory, which goes if nothing is left in it.
    """
    rows = dedupe_latest(in_named_month(batch.where(F.col("identifier").isNotNull() & F.col("file_hash").isNotNull())))
    if not path_exists(spark, path):
        existing, months = spark.createDataFrame([], LANDING), []
    else:
        table = read_landing(spark, path)
        months = months_touched(table, rows)
        existing = table.where(F.col(MONTH).isin(months))
    folder = scratch_path(spark, "merged")
    merged = landing_merge(existing, rows, run_ts)
    merged.write.parquet(folder)
    merged = spark.read.schema(merged.schema).parquet(folder)
    write_landing(merged.drop("action"), path)
    left = {r[0] for r in merged.select(MONTH).distinct().collect()}
    for month in set(months) - left:
        discard(spark, f"{path.rstrip('/')}/{MONTH}={month}")
    return merged.select("identifier", "action")


def table_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def find_by_identifier(df: DataFrame, identifier: str) -> DataFrame:
    return df.where(F.col("identifier") == identifier)


def find_by_date_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """Inclusive comparison of date *strings*, as stored."""
    return df.where(F.col("date").between(start, end))


def find_by_partition(df: DataFrame, month: str) -> DataFrame:
    return df.where(F.col(MONTH) == month)
