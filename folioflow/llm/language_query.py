"""Query op10 over all documents; no SQL expresses it, tests hold it to a plain version."""

from .language_ppm import fit, held_out, identify_documents
from .queries import query, table


@query("op10_language_ppm")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    told = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify_documents(told, model).select("doc_id", "held_out", "lang_pred", "score")
