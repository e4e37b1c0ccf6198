"""Hashes, identifiers, object paths and content types as column expressions."""

from itertools import chain

from pyspark.sql import Column, functions as F

from ..constants import CONTENT_TYPES, DEFAULT_CONTENT_TYPE


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove whitespace of every kind from both ends (``trim`` only takes spaces)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def blank_to_null(c) -> Column:
    c = _col(c)
    return F.when(c != "", c)


def content_length(content) -> Column:
    return F.octet_length(_col(content)).cast("long")


def content_hash(content) -> Column:
    """SHA-256 hex of the bytes; null for missing or empty content."""
    content = _col(content)
    return F.when(F.octet_length(content) > 0, F.sha2(content, 256))


def safe_id(identifier) -> Column:
    return F.regexp_replace(_col(identifier), r"[^\p{L}\p{N}_-]", "")


def safe_body(body) -> Column:
    kept = F.regexp_replace(_col(body), r"[^\p{L}\p{N}_ -]", "")
    return F.translate(F.trim(kept), " ", "_")


def object_path(body, month, identifier, ext) -> Column:
    """Landing layout: ``sanitised body / month / safe id . ext``."""
    return _path(safe_body(F.coalesce(_col(body), F.lit("unknown"))), month, identifier, ext)


def transformed_path(body, month, identifier, ext) -> Column:
    """Transformed layout: the body name is used as it is."""
    return _path(F.coalesce(_col(body), F.lit("unknown")), month, identifier, ext)


def _path(folder, month, identifier, ext) -> Column:
    return F.concat(
        folder,
        F.lit("/"),
        F.coalesce(_col(month), F.lit("unknown")),
        F.lit("/"),
        safe_id(identifier),
        F.lit("."),
        F.coalesce(_col(ext), F.lit("html")),
    )


def content_type(ext) -> Column:
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(CONTENT_TYPES.items())])
    return F.coalesce(F.try_element_at(known, F.lower(_col(ext))), F.lit(DEFAULT_CONTENT_TYPE))


def next_version(is_known, version) -> Column:
    """1 for a new key, otherwise one more than the stored version."""
    return F.when(is_known, F.coalesce(_col(version), F.lit(0)) + 1).otherwise(F.lit(1)).cast("int")
