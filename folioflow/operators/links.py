"""Links in pages: listing rows, next pages, attachments, edges and pagination chains."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import ATTACHMENT_TYPES
from ..functions import strip, url_join
from ..session import discard, stored
from .nodes import dom_nodes, enclosed_until, matches

_ROW, _TITLE, _MAIN = "li.each-item", "h2.title", "#main"


def _href() -> Column:
    return F.try_element_at("attrs", F.lit("href"))


def link_edges(pages: DataFrame, key="page_id", url="url", html="html") -> DataFrame:
    """Every link of every page as ``(key, pre, src, dst)``."""
    anchors = dom_nodes(pages, key, html, keep=[url], tags=["a"])
    return anchors.where(_href().isNotNull()).select(
        key, "pre", F.col(url).alias("src"), url_join(url, _href()).alias("dst")
    )


def next_links(pages: DataFrame, key="page_id", url="url", html="html") -> DataFrame:
    """The first next-page link of each page."""
    anchors = dom_nodes(pages, key, html, keep=[url], tags=["a"])
    hits = anchors.where(matches("a.next") & _href().isNotNull())
    first = hits.groupBy(key, url).agg(F.min(F.struct("pre", _href().alias("href"))).alias("_hit"))
    return first.where(F.col("_hit.href") != "").select(
        key, F.col(url).alias("src"), url_join(url, "_hit.href").alias("dst")
    )


def listing_rows(pages: DataFrame, key="page_id", url="url", html="html", keep=()) -> DataFrame:
    """Case rows of listing pages: link, identifier text, date text. Rows without a link drop out.

    What belongs to an element is the nearest thing that follows it and opens no later than
    the element's last descendant. Two passes over each page from its end find these: anchors
    for titles, then titles, buttons and dates for rows. Rows nested in each other stay linear.
    """
    nodes = dom_nodes(pages, key, html, keep=[url, *keep], tags=["a", "span"], selectors=[_ROW, _TITLE])
    after = Window.partitionBy(key).orderBy(F.col("pre").desc()).rowsBetween(Window.unboundedPreceding, -1)

    def following(value, when):
        return F.last(F.when(when & value.isNotNull(), F.struct("pre", value.alias("value"))), ignorenulls=True).over(after)

    def inside(name):
        return F.when(F.col(name)["pre"] <= F.col("last"), F.col(name)["value"])

    text, anchor = F.col("first_text"), F.col("tag") == "a"
    parts = nodes.select(key, url, *keep, "pre", "last", "tag", "classes", "first_text", _href().alias("href"))
    near = parts.withColumns(
        {
            "_button": following(F.col("href"), matches("a.btn-primary")),
            "_date": following(text, matches("span.date")),
            "_href": following(F.col("href"), anchor),
            "_text": following(text, anchor),
        }
    ).withColumns({"_title_href": F.when(matches(_TITLE), inside("_href")), "_title_text": F.when(matches(_TITLE), inside("_text"))})
    titled = near.withColumns(
        {
            "_link": following(F.col("_title_href"), F.lit(True)),
            "_name": following(F.col("_title_text"), F.lit(True)),
        }
    )
    button = inside("_button")
    return (
        titled.where(matches(_ROW))
        .withColumn("href", F.coalesce(F.when(button != "", button), inside("_link")))
        .where(F.col("href") != "")
        .select(
            key,
            F.col(url).alias("listing_url"),
            *keep,
            F.col("pre").alias("row_pre"),
            "href",
            url_join(url, "href").alias("link"),
            strip(F.coalesce(inside("_name"), F.lit(""))).alias("identifier_text"),
            strip(F.coalesce(inside("_date"), F.lit(""))).alias("date_text"),
        )
    )


def attachments(pages: DataFrame, key="page_id", url="url", html="html") -> DataFrame:
    """The document link of each page that has one: ``(key, doc_url, doc_type)``.

    Links are looked for inside ``#main`` when the page has it. Extensions are tried in order,
    in lower or upper case; only the first link per extension counts, and a cookie notice in
    that place rules the extension out.
    """
    nodes = dom_nodes(pages, key, html, keep=[url], tags=["a"], selectors=[_MAIN])
    is_main = F.col("is_main")
    anchors = nodes.select(
        key, url, "pre", "last", F.when(F.col("tag") == "a", _href()).alias("href"), matches(_MAIN).alias("is_main")
    ).withColumn("in_main", is_main | F.coalesce(enclosed_until(is_main, key) >= F.col("pre"), F.lit(False)))
    aggregates = [F.max("is_main").alias("has_main")]
    for ext in ATTACHMENT_TYPES:
        fits = F.col("href").endswith("." + ext) | F.col("href").endswith("." + ext.upper())
        hit = F.struct("pre", "href")
        aggregates.append(F.min(F.when(fits, hit)).alias(f"any_{ext}"))
        aggregates.append(F.min(F.when(fits & F.col("in_main"), hit)).alias(f"main_{ext}"))
    per_page = anchors.groupBy(key, url).agg(*aggregates)
    picks = []
    for ext in ATTACHMENT_TYPES:
        hit = F.when(F.col("has_main"), F.col(f"main_{ext}")).otherwise(F.col(f"any_{ext}"))
        good = hit.isNotNull() & ~F.contains(F.lower(hit["href"]), F.lit("cookie"))
        picks.append(F.when(good, F.struct(hit["href"].alias("href"), F.lit(ext).alias("doc_type"))))
    return (
        per_page.withColumn("_pick", F.coalesce(*picks))
        .where(F.col("_pick").isNotNull())
        .select(key, url_join(url, "_pick.href").alias("doc_url"), F.col("_pick.doc_type").alias("doc_type"))
    )


def paginate(seeds: DataFrame, links: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Pages reached from the seeds over any links: ``(page, depth)`` with the least number of links.

    ``seeds`` has a ``page`` column, ``links`` has ``src`` and ``dst``; pages may have any number of links,
    and links may form cycles. A round starts from the frontier alone, the pages whose depth fell in the
    round before, and adds what lies behind them unless it was reached at least as soon; the search
    ends with an empty frontier. Pages with a single link form chains, and these are followed in jumps
    that double each round: the frontier of a chain is the second half of what is reached, from which jumps of all
    lengths reach as much again, so a chain of n pages takes about log2(n) rounds.
    """
    spark, made = seeds.sparkSession, []

    def kept(df: DataFrame, name: str) -> tuple[DataFrame, int]:
        table, path, n = stored(df, name)
        made.append(path)
        return table, n

    steps, _ = kept(links.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct().withColumn("length", F.lit(1).cast("long")), "steps")
    single = steps.groupBy("src").agg(F.count("*").alias("n"), F.min("dst").alias("dst")).where("n = 1").select("src", "dst")
    (chain, links_left), length = kept(single, "chain"), 1
    frontier, fell = kept(seeds.select("page").distinct().select("page", F.lit(0).cast("long").alias("depth")), "frontier")
    reached = frontier
    while fell:
        ahead = frontier.join(steps, F.col("page") == F.col("src")).select(F.col("dst").alias("page"), (F.col("depth") + F.col("length")).alias("depth"))
        if max_depth is not None:
            ahead = ahead.where(F.col("depth") <= max_depth)
        nearest = ahead.groupBy("page").agg(F.min("depth").alias("depth")).alias("n")
        sooner = (F.col("n.page") == F.col("r.page")) & (F.col("r.depth") <= F.col("n.depth"))
        frontier, fell = kept(nearest.join(reached.alias("r"), sooner, "left_anti"), "frontier")
        reached = reached.unionByName(frontier)
        if fell and links_left:
            length *= 2
            onward = chain.select(F.col("src").alias("_mid"), F.col("dst").alias("_end"))
            chain, links_left = kept(chain.join(onward, F.col("dst") == F.col("_mid")).select("src", F.col("_end").alias("dst")), "chain")
            steps = steps.unionByName(chain.select("src", "dst", F.lit(length).cast("long").alias("length")))
    found, _, _ = stored(reached.groupBy("page").agg(F.min("depth").alias("depth")), "reached")
    for path in made:
        discard(spark, path)
    return found
