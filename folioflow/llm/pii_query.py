"""Query op4 over all documents; no SQL expresses it, tests hold it to a plain version."""

from pyspark.sql import functions as F

from .pii_feistel import pseudonymize
from .queries import query, table

# Stands for a secret that a deployment keeps elsewhere; pseudonyms of one key are linked.
KEY = "replace this key"


@query("op4_pii_feistel")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, KEY).select("doc_id", "text", F.size("pii_kinds").cast("long").alias("n_pii"), "pii_kinds")
