"""Labels for fetched pages, to keep interstitials out of the corpus."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import (
    CHALLENGE_MARKERS,
    CHALLENGE_STATUSES,
    DEFAULT_RETRY_AFTER,
    EDGE_ERROR_STATUSES,
    RATE_LIMIT_STATUS,
    SUCCESS_STATUSES,
)


def has_marker(body, window: int | None = None) -> Column:
    """Any challenge marker, in any case, in the whole body or in its leading ``window`` bytes."""
    raw = F.col(body).cast("binary") if isinstance(body, str) else body.cast("binary")
    # Byte-for-byte view of the page: every marker is ASCII.
    text = F.lower(F.decode(raw if window is None else F.substring(raw, 1, window), "ISO-8859-1"))
    return reduce(Column.__or__, [text.contains(m.lower()) for m in CHALLENGE_MARKERS])


def retry_after(header) -> Column:
    header = F.col(header) if isinstance(header, str) else header
    return F.coalesce(F.trim(header).try_cast("int"), F.lit(DEFAULT_RETRY_AFTER))


def classify_fetch(df: DataFrame, status="status", body="body", header="retry_after", window=None) -> DataFrame:
    """Adds ``fetch_class`` and, for rate-limited rows, ``retry_after_seconds``.

    Answers outside 200 to 299 that nothing else explains are ``http_error``, and so is a missing
    status. ``window=CHALLENGE_WINDOW`` looks for markers in the leading bytes only.
    """
    code = F.col(status)
    first, last = EDGE_ERROR_STATUSES
    label = (
        F.when(code == RATE_LIMIT_STATUS, "rate_limited")
        .when(code.isin(CHALLENGE_STATUSES) & F.coalesce(has_marker(body, window), F.lit(False)), "challenge")
        .when(code.between(first, last), "edge_error")
        .when(code.between(*SUCCESS_STATUSES), "other")
        .otherwise("http_error")
    )
    wait = retry_after(header) if header in df.columns else F.lit(DEFAULT_RETRY_AFTER)
    return df.withColumn("fetch_class", label).withColumn(
        "retry_after_seconds", F.when(code == RATE_LIMIT_STATUS, wait)
    )


def usable_pages(df: DataFrame, **names) -> DataFrame:
    """Only the pages that were answered with success and are no interstitials."""
    return classify_fetch(df, **names).where(F.col("fetch_class") == "other")
