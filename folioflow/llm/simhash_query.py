"""Query op3 over all documents; no SQL expresses it, tests hold it to a plain version."""

from .queries import query, table
from .simhash_pivots import near_duplicates


@query("op3_simhash_pivots")
def op3(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
