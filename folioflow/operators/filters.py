"""Row filters and routing."""

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import HTML_TYPES
from ..functions import parse_doc_date, year_bounds


def metadata_only(df: DataFrame, content="document_content") -> DataFrame:
    return df.drop(content)


def in_date_range(parsed: Column, start: str | None, end: str | None) -> Column:
    """Half-open test ``start <= parsed < end + 1 day``; a null date passes no bound.

    Kept to plain comparisons, so that on a stored column both reach the parquet scan.
    """
    test = F.lit(True)
    if start:
        test = test & (parsed >= F.lit(dt.datetime.fromisoformat(start)).cast("timestamp_ntz"))
    if end:
        stop = dt.datetime.fromisoformat(end) + dt.timedelta(days=1)
        test = test & (parsed < F.lit(stop).cast("timestamp_ntz"))
    return test


def filter_by_date(df: DataFrame, start=None, end=None, date="date") -> DataFrame:
    """Rows whose date, in whatever format, lies in the range.

    A stored ``doc_date`` column is used when there is one, so that the test reaches
    the parquet scan; otherwise the date string is parsed.
    """
    parsed = F.col("doc_date") if "doc_date" in df.columns else parse_doc_date(date)
    return df.where(in_date_range(parsed, start, end))


def candidate_filter(df: DataFrame, start=None, end=None, date="date") -> DataFrame:
    """Coarse candidates: ISO strings in range, or a string that ends in one of three years.

    Loses day-first dates of other years; ``filter_by_date`` alone is complete.
    """
    if not start and not end:
        return df
    years = "|".join(year_bounds(start, end))
    in_range = F.lit(False)
    if start:
        in_range = (F.col(date) >= start) & (F.col(date) <= f"{end}T23:59:59")
    return df.where(in_range | F.col(date).rlike(f"({years})$"))


def filter_by_date_compat(df: DataFrame, start=None, end=None, date="date") -> DataFrame:
    return filter_by_date(candidate_filter(df, start, end, date), start, end, date)


def is_html(document_type="document_type") -> Column:
    return F.coalesce(F.col(document_type), F.lit("html")).isin(HTML_TYPES)


def split_by_type(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to clean, rows to copy); a missing type counts as html."""
    return df.where(is_html()), df.where(~is_html())


def with_content(df: DataFrame, content="content") -> DataFrame:
    return df.where(F.octet_length(content) > 0)


def with_hash(df: DataFrame, hash_col="file_hash") -> DataFrame:
    return df.where(F.col(hash_col).isNotNull())
