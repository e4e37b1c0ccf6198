from .blobs import (
    attach_content,
    blob_rows,
    in_months_of,
    latest_blobs,
    read_binary_files,
    read_blobs,
    stored_captures,
    with_existing_blob,
    with_missing_blob,
    write_blobs,
    write_new_blobs,
    write_partitioned,
)
from .bodies import bodies, body_ids
from .eventlog import broken_lines, read_event_log, run_summary_json, to_event_json, write_event_log
from .partitions import date_partitions, date_range, search_requests
from .tables import find_by_date_range, find_by_identifier, find_by_partition, merge_months, read_landing, table_count, write_landing
