"""Mixed-format dates. Every form either parses or gives null; nothing raises under ANSI."""

from itertools import chain

from pyspark.sql import Column, functions as F

from ..constants import (
    FIRST_YEAR,
    LAST_YEAR,
    MONTHS,
    TEXT_DATE_PATTERNS,
    URL_DATE_PATTERN,
)
from .text import _col, blank_to_null, strip

_ISO_DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"
_ISO_DAY_OR_TIME = r"^\d{4}-\d{1,2}-\d{1,2}(T\d{1,2}:\d{1,2}:\d{1,2})?$"
_DAY_FIRST = r"^(\d{1,2})([/-])(\d{1,2})\2(\d{4})$"
_NAMED_MONTH = r"^(\d{1,2})\s+(\p{Alpha}+)\s+(\d{4})$"


def _day_first_to_iso(c: Column) -> Column:
    return F.regexp_replace(c, _DAY_FIRST, "$4-$3-$1")


def _month_number(name: Column) -> Column:
    numbers = F.create_map(*[F.lit(x) for x in chain.from_iterable((m, i + 1) for i, m in enumerate(MONTHS))])
    return F.try_element_at(numbers, F.lower(name))


def parse_iso_date(text) -> Column:
    """Strict ``yyyy-MM-dd``."""
    text = _col(text)
    return F.when(text.rlike(_ISO_DAY), text.try_cast("date"))


def parse_doc_date(text) -> Column:
    """Stored document date -> timestamp without zone.

    Takes the first 19 characters in one of: ISO day, ISO second, day/month/year,
    day-month-year. One rewrite and one cast instead of four parse attempts.
    """
    iso = _day_first_to_iso(F.substring(_col(text), 1, 19))
    return F.when(iso.rlike(_ISO_DAY_OR_TIME), iso.try_cast("timestamp_ntz"))


def parse_listing_date(text) -> Column:
    """Date as printed in a listing: day/month/year, day Month year, day-month-year, ISO day."""
    text = strip(text)
    iso = _day_first_to_iso(text)
    month = _month_number(F.regexp_extract(text, _NAMED_MONTH, 2))
    named = F.concat_ws(
        "-",
        F.regexp_extract(text, _NAMED_MONTH, 3),
        month.cast("string"),
        F.regexp_extract(text, _NAMED_MONTH, 1),
    )
    return F.when(iso.rlike(_ISO_DAY), iso.try_cast("date")).when(
        month.isNotNull(), named.try_cast("date")
    )


def regex_date(text, window=None) -> Column:
    """First date-like string inside running text, numeric form before named months.

    ``window`` limits the search to that many leading characters.
    """
    text = _col(text)
    if window is not None:
        text = F.substring(text, 1, window)
    found = [blank_to_null(F.regexp_extract(text, "(?i)" + p, 1)) for p in TEXT_DATE_PATTERNS]
    return F.coalesce(*found)


def url_date(url) -> Column:
    """First of the month named in a case URL; an unknown month name counts as January."""
    url = _col(url)
    year = blank_to_null(F.regexp_extract(url, URL_DATE_PATTERN, 1))
    month = F.coalesce(_month_number(F.regexp_extract(url, URL_DATE_PATTERN, 2)), F.lit(1))
    return F.concat(year, F.lit("-"), month.cast("string"), F.lit("-1")).try_cast("date")


def resolve_date(date_text, html, url, window=None) -> Column:
    """Listing text if there is any, else a date from the page; if that does not parse, the URL."""
    return resolve_found_date(date_text, regex_date(html, window), url)


def resolve_found_date(date_text, page_date, url) -> Column:
    """``resolve_date`` when the date inside the page was looked for earlier."""
    text = F.coalesce(blank_to_null(date_text), _col(page_date))
    return F.coalesce(parse_listing_date(text), url_date(url))


def partition_month(date, label) -> Column:
    return F.coalesce(F.date_format(_col(date), "yyyy-MM"), _col(label))


def year_bounds(start: str | None, end: str | None) -> tuple[str, str, str]:
    """Start, end and middle year of a range given as ISO days."""
    first = start[:4] if start else FIRST_YEAR
    last = end[:4] if end else LAST_YEAR
    return first, last, str((int(first) + int(last)) // 2)
