"""Query op7 over all documents; no SQL expresses it, tests measure it on held-out labels."""

from pyspark.sql import functions as F

from .queries import query, table
from .toxicity_chain import fit, flag_toxic

CATEGORIES = ["low_quality", "toxic"]


@query("op7_toxicity_chain")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    told = flag_toxic(docs, fit(docs, labels, CATEGORIES))
    # One flag only: low quality is a step of the chain, not a finding of this query.
    return told.select("doc_id", "p_low_quality", F.col("p_toxic").alias("score"), "toxic")
