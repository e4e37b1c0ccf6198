"""Dimension lookups."""

from pyspark.sql import DataFrame, functions as F

from ..constants import DEFAULT_BODY_NAME


def with_body_name(df: DataFrame, bodies: DataFrame, default=DEFAULT_BODY_NAME) -> DataFrame:
    """Body name by exact id, or the default. Spark broadcasts the dimension by its size."""
    return df.join(bodies.select("body_id", "body_name"), "body_id", "left").withColumn(
        "body_name", F.coalesce("body_name", F.lit(default))
    )


def unknown_bodies(df: DataFrame, bodies: DataFrame) -> DataFrame:
    return df.join(bodies.select("body_id"), "body_id", "left_anti")
