"""Query op12 over all documents; no SQL expresses its tokens, tests hold it to a plain version."""

from .best_fit import pack_documents
from .queries import query, table


@query("op12_best_fit")
def op12(spark, sf_dir):
    packed = pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
