"""Run statistics and data-quality reports. All are aggregates that combine on the map side."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions import content_hash, content_length


def transform_counts(status="status") -> list[Column]:
    """total / transformed / skipped / failed."""
    def n(value):
        return F.count_if(F.col(status) == value).alias(value)

    return [F.count(F.lit(1)).alias("total"), n("transformed"), n("skipped"), n("failed")]


def transform_stats(results: DataFrame, status="status") -> DataFrame:
    """total / transformed / skipped / failed; an empty selection gives zeros."""
    return results.agg(*transform_counts(status))


def observed(spark: SparkSession, seen: Observation, names: list[str]) -> DataFrame:
    """One row of counts that were taken while a table was written; zeros if there was nothing to write."""
    values = seen.get
    return spark.range(1).select(*[F.lit(int(values.get(n) or 0)).cast("long").alias(n) for n in names])


def crawl_summary(events: DataFrame, by=(), event="event", found="link", scraped="record", pages="page") -> DataFrame:
    """found / scraped / pages per run."""
    def n(value):
        return F.count_if(F.col(event) == value)

    return events.groupBy(*by).agg(
        n(found).alias("found"), n(scraped).alias("scraped"), n(pages).alias("pages")
    )


def upsert_columns(action="action") -> list[Column]:
    """upserted / modified / unchanged / total operations."""
    inserted = F.count_if(F.col(action) == "insert")
    updated = F.count_if(F.col(action) == "update")
    return [
        inserted.alias("upserted"),
        updated.alias("modified"),
        F.count_if(F.col(action) == "unchanged").alias("unchanged"),
        (inserted + updated).alias("total_ops"),
    ]


def upsert_counts(actions: DataFrame, action="action") -> DataFrame:
    """upserted / modified / unchanged / total operations of one merge."""
    return actions.agg(*upsert_columns(action))


def run_status(stats: DataFrame, failed="failed") -> DataFrame:
    """Success or Failed with a 0/1 flag."""
    bad = F.coalesce(F.col(failed), F.lit(0)) > 0
    return stats.select(
        F.when(bad, "Failed").otherwise("Success").alias("status"), bad.cast("int").alias("failed")
    )


def duplicate_keys(df: DataFrame, cols=("identifier",)) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def duplicate_content(df: DataFrame, content="content", key="identifier") -> DataFrame:
    """Groups of documents with equal bytes. Only the hash is shuffled, never the content."""
    hashed = df.select(content_hash(content).alias("content_hash"), key, content_length(content).alias("length"))
    return (
        hashed.where(F.col("content_hash").isNotNull())
        .groupBy("content_hash")
        .agg(
            F.count("*").alias("n_docs"),
            F.min(key).alias("first_identifier"),
            F.sum("length").alias("total_length"),
        )
        .where(F.col("n_docs") > 1)
    )
