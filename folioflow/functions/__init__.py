from .dates import (
    parse_doc_date,
    parse_iso_date,
    parse_listing_date,
    partition_month,
    regex_date,
    resolve_date,
    resolve_found_date,
    url_date,
    year_bounds,
)
from .text import (
    blank_to_null,
    content_hash,
    content_length,
    content_type,
    next_version,
    object_path,
    safe_body,
    safe_id,
    strip,
    transformed_path,
)
from .urls import host, identifier_or_url, url_identifier, url_join, within_domains
