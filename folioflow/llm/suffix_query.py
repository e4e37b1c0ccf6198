"""Query op6 over all documents; no SQL expresses it, tests hold it to a plain version."""

from pyspark.sql import functions as F

from .queries import query, table
from .suffix_dedup import remove_repeats


@query("op6_suffix_dedup")
def op6(spark, sf_dir):
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
