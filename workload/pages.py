"""Pages: element tables, cleaning, links and pagination."""

from pyspark.sql import functions as F

from folioflow import sources as src
from folioflow.operators import clean, links, nodes
from folioflow.plans import landing as landing_plan

from .registry import query
from .views import RUN_TS, SEARCH, SITE, case_pages, cases, ctes, detail_pages, listing_pages, spread, table, wrapped


def _site(spark, sf):
    return spread(table(spark, sf, "pages"), "page_id")


@query(
    "tag_counts",
    "SELECT tag, count(*) AS n_elements FROM (SELECT unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM pages) GROUP BY tag",
)
def tag_counts(spark, sf):
    return nodes.tag_counts(nodes.dom_nodes(_site(spark, sf)))


_SELECTORS = "('script'), ('style'), ('noscript'), ('meta'), ('link'), ('nav'), ('header'), ('footer'), ('aside')"


@query(
    "noise_stats",
    f"""SELECT selector, CAST(sum(n) AS BIGINT) AS n_elements, CAST(sum(n) AS BIGINT) AS n_outermost, count(*) AS n_pages
        FROM (SELECT selector, len(regexp_extract_all(html, '<' || selector || '[ >]')) AS n FROM pages, (VALUES {_SELECTORS}) v(selector))
        WHERE n > 0 GROUP BY selector""",
)
def noise_stats(spark, sf):
    return nodes.noise_stats(nodes.dom_nodes(_site(spark, sf)))


@query(
    "link_edges",
    """SELECT page_id, url AS src, regexp_extract(url, '^[a-z]+://[^/?#]*') || href AS dst
       FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)""",
)
def link_edges(spark, sf):
    return links.link_edges(_site(spark, sf)).drop("pre")


@query("text_len", ctes("docs", "wrapped") + "SELECT doc_id AS page_id, n AS text_len FROM wrapped")
def text_len(spark, sf):
    scored = nodes.scored_nodes(nodes.dom_nodes(wrapped(spark, sf)))
    return scored.where(F.col("tag") == "body").select("page_id", "text_len")


@query("main_div", ctes("docs", "wrapped") + "SELECT doc_id AS page_id, n AS text_len FROM wrapped WHERE w IN (2, 3) AND n > 300")
def main_div(spark, sf):
    return nodes.main_div(nodes.dom_nodes(wrapped(spark, sf))).select("page_id", "text_len")


@query("main_content", ctes("docs", "wrapped", "cleaned") + "SELECT doc_id AS page_id, tier, tag, text_len FROM cleaned")
def main_content(spark, sf):
    return nodes.main_content(nodes.dom_nodes(wrapped(spark, sf)))


@query(
    "clean_pages",
    ctes("docs", "wrapped", "cleaned")
    + "SELECT doc_id AS page_id, cleaned, tier, tag, text_len, CAST(NULL AS VARCHAR) AS error FROM cleaned",
)
def clean_pages(spark, sf):
    return clean.clean_pages(wrapped(spark, sf))


@query(
    "clean_pages_by_nodes",
    ctes("docs", "wrapped", "cleaned") + "SELECT doc_id AS page_id, cleaned, tier, tag, text_len FROM cleaned",
)
def clean_pages_by_nodes(spark, sf):
    return clean.clean_pages_by_nodes(wrapped(spark, sf))


# The fetched pages have one article each, whose bold paragraphs are never closed: their end tags
# come where the article ends. Line breaks and empty paragraphs go, quotes need no entity.
_SITE_CLEANED = r"""WITH raw AS (
  SELECT page_id, len(regexp_extract_all(html, '<b>')) AS n_bold,
         regexp_replace(regexp_replace(regexp_extract(html, '<body>(.*)$', 1, 's'), '</body>.*$', '', 's'),
                        '<nav>.*</nav>|<footer>.*</footer>', '', 'gs') AS body
  FROM pages),
written AS (
  SELECT page_id, replace(regexp_replace(replace(regexp_replace(replace(replace(body, '<br>', ''), '&quot;', '"'),
           '&amp;?', '&', 'g'), '&', '&amp;'), '<p>\s*</p>', '', 'g'),
         '</article>', repeat('</b></p>', n_bold) || '</article>') AS body
  FROM raw),
parts AS (SELECT page_id, body, '<article>' || regexp_extract(body, '<article>(.*)</article>', 1, 's') || '</article>' AS article FROM written),
lengths AS (
  SELECT *, list_sum(list_transform(regexp_split_to_array(article, '<[^>]*>'), lambda x: length(trim(replace(x, '&amp;', '&'), e' \n\t\r')))) AS in_article,
         list_sum(list_transform(regexp_split_to_array(body, '<[^>]*>'), lambda x: length(trim(replace(x, '&amp;', '&'), e' \n\t\r')))) AS in_body
  FROM parts)
SELECT page_id, url, CASE WHEN in_article > 200 THEN article
         ELSE '<body>' || regexp_replace(body, '<div class="ad">([^<]{0,9})</div>', '\1') || '</body>' END AS cleaned,
       CASE WHEN in_article > 200 THEN 'selector' ELSE 'body' END AS tier, CASE WHEN in_article > 200 THEN 'article' ELSE 'body' END AS tag,
       CAST(CASE WHEN in_article > 200 THEN in_article ELSE in_body END AS INTEGER) AS text_len, CAST(NULL AS VARCHAR) AS error
FROM lengths JOIN pages USING (page_id)"""


@query("clean_site_pages", _SITE_CLEANED)
def clean_site_pages(spark, sf):
    """The fetched pages themselves, malformed as they are."""
    return clean.clean_pages(_site(spark, sf))


@query("clean_site_pages_by_nodes", _SITE_CLEANED.replace("SELECT page_id, url, ", "SELECT page_id, ").replace(", CAST(NULL AS VARCHAR) AS error", ""))
def clean_site_pages_by_nodes(spark, sf):
    return clean.clean_pages_by_nodes(_site(spark, sf))


@query("first_match", ctes("cases") + "SELECT conv_id AS page_id, 'span' AS tag, date_text AS first_text FROM cases WHERE turn = 0")
def first_match(spark, sf):
    dates = nodes.dom_nodes(listing_pages(spark, sf), tags=["span"])
    return nodes.first_match(dates, "span.date").select("page_id", "tag", "first_text")


@query(
    "listing_rows",
    ctes("cases")
    + """SELECT conv_id AS page_id, listing_url, href, url AS link, identifier AS identifier_text, date_text
         FROM cases WHERE turn % 5 <> 4""",
)
def listing_rows(spark, sf):
    return links.listing_rows(listing_pages(spark, sf)).drop("row_pre")


@query(
    "next_links",
    f"""SELECT DISTINCT conv_id AS page_id, '{SEARCH}?pageNumber=' || conv_id AS src, '{SEARCH}?pageNumber=' || (conv_id + 1) AS dst
        FROM conversations WHERE conv_id % 10 <> 9""",
)
def next_links(spark, sf):
    return links.next_links(listing_pages(spark, sf))


@query(
    "attachments",
    f"""SELECT doc_id AS page_id, CASE WHEN doc_id % 4 = 0 THEN '{SITE}/decoy.pdf' ELSE '{SITE}/en/cases/' || doc_id || '/a.' ||
             CASE doc_id % 6 WHEN 1 THEN 'pdf' WHEN 2 THEN 'PDF' WHEN 3 THEN 'doc' WHEN 4 THEN 'pdf' ELSE 'doc' END END AS doc_url,
           CASE WHEN doc_id % 4 <> 0 AND doc_id % 6 IN (3, 5) THEN 'doc' ELSE 'pdf' END AS doc_type
        FROM documents WHERE doc_id % 4 = 0 OR doc_id % 6 > 0""",
)
def attachments(spark, sf):
    return links.attachments(detail_pages(spark, sf))


def _listing(spark, sf):
    rows = links.listing_rows(listing_pages(spark, sf), keep=["body_id"])
    return rows.withColumn("partition", F.lit("2024-01"))


@query(
    "link_join",
    ctes("cases", "case_pages") + "SELECT conv_id * 1000 + turn AS page_id, identifier AS identifier_text, url FROM case_pages WHERE turn % 5 <> 4",
)
def link_join(spark, sf):
    listing = _listing(spark, sf).select("link", "identifier_text")
    pages = case_pages(spark, sf).select("page_id", "url")
    return landing_plan.link_join(listing, pages).select("page_id", "identifier_text", "url")


_DAY = """CASE WHEN date_text <> '' THEN try_strptime(date_text, '%d/%m/%Y') WHEN page_date IS NOT NULL THEN TIMESTAMP '2024-02-05'
          ELSE TIMESTAMP '2024-03-01' END"""


@query(
    "build_items",
    ctes("cases", "case_pages")
    + f"""SELECT identifier, identifier AS title, CAST(NULL AS VARCHAR) AS description, strftime({_DAY}, '%Y-%m-%d') AS date,
            CASE body_id WHEN '1' THEN 'Employment Appeals Tribunal' WHEN '2' THEN 'Equality Tribunal' WHEN '3' THEN 'Labour Court'
                 WHEN '15376' THEN 'Workplace Relations Commission' ELSE 'Workplace Relations' END AS body,
            coalesce(doc_url, url) AS link_to_doc, strftime({_DAY}, '%Y-%m') AS partition_date, url AS source_url,
            '{RUN_TS}' AS scraped_at, coalesce(doc_type, 'html') AS document_type
          FROM case_pages WHERE turn % 5 <> 4""",
)
def build_items(spark, sf):
    return landing_plan.build_items(_listing(spark, sf), case_pages(spark, sf), src.bodies(spark), RUN_TS)


@query(
    "paginate",
    """WITH RECURSIVE reached AS (
         SELECT conv_id, turn, CAST(0 AS BIGINT) AS depth FROM conversations WHERE turn = 0
         UNION ALL
         SELECT c.conv_id, c.turn, depth + 1 FROM reached r JOIN conversations c ON c.conv_id = r.conv_id AND c.turn = r.turn + 1)
       SELECT conv_id || '-' || turn AS page, depth FROM reached""",
)
def paginate(spark, sf):
    turns = table(spark, sf, "conversations")

    def page(turn):
        return F.concat(F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))

    seeds = turns.where(F.col("turn") == 0).select(page(F.col("turn")).alias("page"))
    edges = turns.where(F.col("turn") > 0).select(page(F.col("turn") - 1).alias("src"), page(F.col("turn")).alias("dst"))
    return links.paginate(seeds, edges)


@query(
    "paginate_listing",
    f"""SELECT DISTINCT '{SEARCH}?pageNumber=' || conv_id AS page, CAST(conv_id % 10 AS BIGINT) AS depth FROM conversations""",
)
def paginate_listing(spark, sf):
    """Every result page from the first pages of the chains, over the links in the pages."""
    pages = listing_pages(spark, sf)
    seeds = pages.where(F.col("page_id") % 10 == 0).select(F.col("url").alias("page"))
    return links.paginate(seeds, links.next_links(pages))
