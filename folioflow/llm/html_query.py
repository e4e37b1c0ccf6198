"""Query op1 over all pages; no SQL expresses it, tests hold it to pages whose main text is known."""

from .html_blocks import extract_pages
from .queries import query, table


@query("op1_html_blocks")
def op1(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_pages(pages).select("page_id", "url", "text", "n_chars", "n_blocks", "n_kept")
