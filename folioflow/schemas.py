"""Table schemas. Dates stay strings as captured; parsed dates are derived columns."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S = T.StringType()

ITEM = _struct(
    ("identifier", _S),
    ("title", _S),
    ("description", _S),
    ("date", _S),
    ("body", _S),
    ("link_to_doc", _S),
    ("partition_date", _S),
    ("file_path", _S),
    ("file_hash", _S),
    ("source_url", _S),
    ("scraped_at", _S),
    ("document_type", _S),
    ("document_content", T.BinaryType()),
)

LANDING = T.StructType(
    [f for f in ITEM if f.name != "document_content"]
    + [
        T.StructField("version", T.IntegerType(), True),
        T.StructField("created_at", _S, True),
        T.StructField("updated_at", _S, True),
        # The document date, parsed once; ``date`` keeps what was captured.
        T.StructField("doc_date", T.TimestampNTZType(), True),
    ]
)

TRANSFORMED = _struct(
    ("identifier", _S),
    ("title", _S),
    ("description", _S),
    ("date", _S),
    ("body", _S),
    ("original_link", _S),
    ("original_file_path", _S),
    ("original_hash", _S),
    ("transformed_file_path", _S),
    ("new_hash", _S),
    ("document_type", _S),
    ("partition_date", _S),
    ("transformed_at", _S),
    ("version", T.IntegerType()),
    ("is_copy", T.BooleanType()),
    # Of the rules that cleaned the document; null for copies.
    ("cleaner_version", T.IntegerType()),
)

BLOBS = _struct(
    ("object_path", _S),
    ("content", T.BinaryType()),
    ("content_type", _S),
    ("length", T.LongType()),
)

BODY = _struct(("body_id", _S), ("body_name", _S))

#: Metadata columns an incoming capture sets on an existing landing row.
CAPTURE_COLS = [f.name for f in ITEM if f.name not in ("identifier", "document_content")]
