"""Structured JSON events and run summaries.

An event log has a directory per day of its events and one JSON object per line. Lines that are no
such object, or whose fields have other types than the schema says, are kept apart when it is read.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import parse_iso_date

_KEEP_NULLS = {"ignoreNullFields": "false"}
_BROKEN = "_broken"


def to_event_json(df: DataFrame, timestamp="timestamp", event="event", data=None, keep=()) -> DataFrame:
    """One JSON object per row: timestamp, event name, then the data fields."""
    data = [c for c in df.columns if c not in (timestamp, event)] if data is None else data
    record = F.struct(F.col(timestamp).alias("timestamp"), F.col(event).alias("event"), *data)
    return df.select(F.to_json(record, _KEEP_NULLS).alias("value"), *keep)


def write_event_log(df: DataFrame, path: str, mode="append", timestamp="timestamp", **names) -> None:
    """Adds events to the directories of their days; ``unknown`` holds those whose timestamp names no day."""
    day = F.coalesce(parse_iso_date(F.substring(F.col(timestamp).cast("string"), 1, 10)).cast("string"), F.lit("unknown"))
    lines = to_event_json(df, timestamp, keep=[day.alias("day")], **names)
    lines.hint("rebalance", "day").write.mode(mode).partitionBy("day").text(path)


def _lines(spark: SparkSession, path: str, schema: str, days) -> DataFrame:
    """``day``, ``value`` and the parsed ``e`` of every line that is not blank."""
    lines = spark.read.schema("value string, day string").text(path)
    if days is not None:
        lines = lines.where(F.col("day").between(*days))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    return lines.where("trim(value) <> ''").withColumn("e", F.from_json("value", f"{schema}, {_BROKEN} string", options))


def _is_broken():
    return F.col("e").isNull() | F.col("e")[_BROKEN].isNotNull()


def read_event_log(spark: SparkSession, path: str, schema: str, days: tuple[str, str] | None = None) -> DataFrame:
    """The events of a log; ``days`` (first and last, inclusive) are the only directories read."""
    good = _lines(spark, path, schema, days).where(~_is_broken())
    return good.select("e.*").drop(_BROKEN)


def broken_lines(spark: SparkSession, path: str, schema: str, days: tuple[str, str] | None = None) -> DataFrame:
    """``(day, value)`` of the lines that ``read_event_log`` leaves out."""
    return _lines(spark, path, schema, days).where(_is_broken()).select("day", "value")


def run_summary_json(stats: DataFrame) -> DataFrame:
    return stats.select(F.to_json(F.struct(*stats.columns), _KEEP_NULLS).alias("summary"))
