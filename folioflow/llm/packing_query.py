"""Query op8 over all documents; no SQL expresses it, tests hold it to a plain version."""

from .packing import pack_documents
from .queries import query, table


@query("op8_packing")
def op8(spark, sf_dir):
    packed = pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
