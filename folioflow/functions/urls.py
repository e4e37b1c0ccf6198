"""URL expressions: identifiers, resolution of links, domain tests."""

from functools import reduce

from pyspark.sql import Column, functions as F

from .text import _col, blank_to_null, strip

_PARTS = r"^(\p{Alpha}[\p{Alnum}+.-]*):(?://([^/?#]*))?([^?#]*)(\?[^#]*)?"


def url_identifier(url) -> Column:
    """Last path segment in upper case, trailing slashes ignored."""
    return F.upper(F.substring_index(F.regexp_replace(_col(url), "/+$", ""), "/", -1))


def identifier_or_url(text, url) -> Column:
    return F.coalesce(blank_to_null(strip(text)), url_identifier(url))


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of a path that starts with a slash."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(s))),
    )
    ends_in_dots = F.element_at(parts, -1).isin(".", "..")
    joined = F.concat(F.array_join(kept, "/"), F.when(ends_in_dots, "/").otherwise(""))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), joined).otherwise(path)


def url_join(base, href) -> Column:
    """Absolute form of ``href`` as found on the page ``base``."""
    base, href = _col(base), _col(href)
    scheme = F.regexp_extract(base, _PARTS, 1)
    origin = F.concat(scheme, F.lit("://"), F.regexp_extract(base, _PARTS, 2))
    base_path = F.regexp_extract(base, _PARTS, 3)
    base_query = F.regexp_extract(base, _PARTS, 4)
    tail = F.regexp_extract(href, r"[?#].*$", 0)
    path = F.regexp_extract(href, r"^[^?#]*", 0)
    folder = F.when(base_path == "", "/").otherwise(F.regexp_extract(base_path, r"^.*/", 0))
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^\p{Alpha}[\p{Alnum}+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("#"), F.concat(origin, base_path, base_query, href))
        .when(href.startswith("?"), F.concat(origin, base_path, href))
        .when(href.startswith("/"), F.concat(origin, _without_dots(path), tail))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, path)), tail))
    )


def host(url) -> Column:
    return F.lower(F.try_parse_url(_col(url), F.lit("HOST")))


def within_domains(url, domains: list[str]) -> Column:
    """True when the link's host is one of the domains or below one."""
    name = host(url)
    tests = [(name == d.lower()) | name.endswith("." + d.lower()) for d in domains]
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False))
