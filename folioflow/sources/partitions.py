"""Month partitions of date ranges and the search requests made for them."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import parse_iso_date


def date_partitions(ranges: DataFrame, start="start_date", end="end_date", months=1, now=None) -> DataFrame:
    """One row per chunk of ``months`` months for every range in the table.

    Chunks begin on day 1 of the start month and the last one ends on the end date. A range
    with a missing or unreadable bound becomes the 30 days before ``now``.
    """
    months = int(months or 1)
    if months < 1:
        raise ValueError("months must be at least 1")
    today = F.to_date(F.lit(now)) if now else F.current_date()
    first, last = parse_iso_date(start), parse_iso_date(end)
    usable = first.isNotNull() & last.isNotNull()
    bounded = ranges.withColumn("_from", F.trunc(F.when(usable, first).otherwise(F.date_sub(today, 30)), "MM")).withColumn(
        "_to", F.when(usable, last).otherwise(today)
    )
    step = F.make_interval(months=F.lit(months))
    starts = F.when(F.col("_from") <= F.col("_to"), F.sequence("_from", "_to", step))
    return (
        bounded.withColumn("p_start", F.explode(starts))
        .withColumn("p_end", F.least(F.date_sub(F.add_months("p_start", months), 1), F.col("_to")))
        .withColumn("partition", F.date_format("p_start", "yyyy-MM"))
        .drop("_from", "_to")
    )


def date_range(spark: SparkSession, start, end) -> DataFrame:
    """A one-row range table for ``date_partitions``."""
    return spark.range(1).select(F.lit(start).alias("start_date"), F.lit(end).alias("end_date"))


def search_requests(parts: DataFrame, body_ids: list[str], search_base: str, per_body: bool = False) -> DataFrame:
    """Search URL for each partition, with one ``body`` parameter per id.

    ``per_body`` gives one request per partition and body instead, so that every result
    row knows the body it came from. The id list is an array literal: no join is needed.
    """
    all_ids = F.array(*[F.lit(b) for b in body_ids])
    if per_body:
        rows = parts.withColumn("body_id", F.explode(all_ids))
        bodies = F.concat(F.lit("body="), F.url_encode("body_id"))
    else:
        rows = parts.withColumn("body_id", F.lit(",".join(body_ids)))
        bodies = F.array_join(F.transform(all_ids, lambda b: F.concat(F.lit("body="), F.url_encode(b))), "&")

    def day(c):
        return F.url_encode(F.date_format(c, "dd/MM/yyyy"))

    query = F.concat_ws(
        "&",
        F.lit("decisions=1"),
        F.concat(F.lit("from="), day("p_start")),
        F.concat(F.lit("to="), day("p_end")),
        bodies,
    )
    return rows.withColumn("url", F.concat(F.lit(search_base + "?"), query))
