"""Element tables of pages, and selection, noise removal and scoring over them.

``dom_nodes`` runs the parser once per page; the rest is windows and grouping by page. A page
is one row of the source table, so a window over a page is as large as that page at most.
Containment uses the document-order interval ``[pre, last]`` of each element together with
running maxima and sums, so no pairs of elements are formed.
"""

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..constants import (
    CONTENT_SELECTORS,
    MIN_DIV_TEXT,
    MIN_SELECTED_TEXT,
    MIN_WRAPPER_TEXT,
    NAVIGATION_SELECTORS,
    STRIPPED_TAGS,
    UNWRAPPED_TAGS,
)
from . import markup

_PAGES_PER_BATCH = 64
_PIECE = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("html", T.StringType())])

_FIELDS = [
    T.StructField("pre", T.IntegerType()),
    T.StructField("last", T.IntegerType()),
    T.StructField("parent", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("elem_id", T.StringType()),
    T.StructField("classes", T.ArrayType(T.StringType())),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("own_len", T.IntegerType()),
    T.StructField("first_text", T.StringType()),
    T.StructField("open_pos", T.IntegerType()),
    T.StructField("close_pos", T.IntegerType()),
]
_MARKUP_FIELDS = [
    T.StructField("open_html", T.StringType()),
    T.StructField("close_html", T.StringType()),
    T.StructField("pieces", T.ArrayType(_PIECE)),
]


def dom_nodes(
    pages: DataFrame, key="page_id", html="html", keep=(), tags=None, selectors=(), with_markup=False
) -> DataFrame:
    """One row per element, element 0 being the document.

    ``tags`` limits the rows to elements with these tags or matching ``selectors``, so that
    only what a query needs crosses back from Python. ``keep`` names page columns to repeat.
    """
    kept = [key, *keep]
    fields = _FIELDS + (_MARKUP_FIELDS if with_markup else [])
    schema = T.StructType([pages.schema[c] for c in kept] + fields)
    wanted = None if tags is None else frozenset(tags)
    extra = list(selectors)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out_schema = to_arrow_schema(schema)
        also = markup.Selectors(extra)
        for batch in batches:
            for at in range(0, batch.num_rows, _PAGES_PER_BATCH):
                part = batch.slice(at, _PAGES_PER_BATCH).to_pydict()
                rows = [
                    head + row
                    for *head, text in zip(*[part[c] for c in kept], part[html])
                    for row in _page_rows(text, wanted, also, with_markup)
                ]
                columns = list(zip(*rows)) if rows else [[]] * len(out_schema)
                arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, out_schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out_schema)

    return pages.select(*kept, html).mapInArrow(run, schema)


def _page_rows(text, wanted, also, with_markup):
    page = markup.parse("" if text is None else text)
    pieces = {}
    if with_markup:
        for pos, (kind, pre, payload) in enumerate(page.events):
            if kind in (markup.TEXT, markup.OTHER):
                shown = markup.escape(payload) if kind == markup.TEXT else payload
                pieces.setdefault(pre, []).append({"pos": pos, "html": shown})
    found = []
    for e in page.elements:
        if wanted is None or e.tag in wanted or also.ranks(e):
            row = [e.pre, e.last, e.parent, e.depth, e.tag, e.elem_id, e.classes, list(e.attrs.items()),
                   e.own_len, e.first_text, e.open_at, e.close_at]
            if with_markup:
                row += [e.open_html() if e.pre else "", e.close_html() if e.pre else "", pieces.get(e.pre, [])]
            found.append(row)
    return found


def matches(selector: str) -> Column:
    """Test of one ``tag``, ``tag.class``, ``.class`` or ``#id`` selector."""
    if selector.startswith("#"):
        return F.coalesce(F.col("elem_id") == selector[1:], F.lit(False))
    tag, _, cls = selector.partition(".")
    tests = [F.col("tag") == tag] if tag else []
    if cls:
        tests.append(F.array_contains("classes", cls))
    return reduce(Column.__and__, tests)


def is_noise() -> Column:
    """Stripped tags and navigation selectors, as three set tests."""
    ids = [s[1:] for s in NAVIGATION_SELECTORS if s.startswith("#")]
    classes = [s[1:] for s in NAVIGATION_SELECTORS if s.startswith(".")]
    tags = STRIPPED_TAGS + [s for s in NAVIGATION_SELECTORS if s[0] not in ".#"]
    return (
        F.col("tag").isin(tags)
        | F.arrays_overlap("classes", F.array(*[F.lit(c) for c in classes]))
        | F.coalesce(F.col("elem_id").isin(ids), F.lit(False))
    )


def first_match(nodes: DataFrame, selector: str, key="page_id") -> DataFrame:
    """First element in document order that matches, per page."""
    hit = F.min(F.struct("pre", "tag", "elem_id", "own_len", "first_text")).alias("_hit")
    return nodes.where(matches(selector)).groupBy(key).agg(hit).select(key, "_hit.*")


def tag_counts(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("pre") > 0).groupBy("tag").agg(F.count("*").alias("n_elements"))


def noise_stats(nodes: DataFrame, key="page_id") -> DataFrame:
    """Elements removed per selector; an element counts for the first selector it matches."""
    inside = enclosed_until(F.col("_noise"), key) >= F.col("pre")
    names = [
        F.when(matches(s), F.lit(s)) for s in STRIPPED_TAGS + NAVIGATION_SELECTORS
    ]
    marked = (
        nodes.select(key, "pre", "last", "tag", "elem_id", "classes")
        .withColumn("_noise", is_noise())
        .withColumn("_inner", F.coalesce(inside, F.lit(False)))
        .where("_noise")
    )
    per_page = (
        marked.withColumn("selector", F.coalesce(*names))
        .groupBy("selector", key)
        .agg(F.count("*").alias("_n"), F.count_if(~F.col("_inner")).alias("_outer"))
    )
    return per_page.groupBy("selector").agg(
        F.sum("_n").alias("n_elements"), F.sum("_outer").alias("n_outermost"), F.count("*").alias("n_pages")
    )


def enclosed_until(flag: Column, key) -> Column:
    """Greatest ``last`` of the flagged elements that open before this one.

    An element lies inside a flagged one just when this is not below its own ``pre``.
    """
    before = Window.partitionBy(key).orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
    return F.max(F.when(flag, F.col("last"))).over(before)


def without_noise(nodes: DataFrame, key="page_id") -> DataFrame:
    """Drop noise elements and everything inside them."""
    inside = F.coalesce(enclosed_until(F.col("_noise"), key) >= F.col("pre"), F.lit(False))
    return (
        nodes.withColumn("_noise", is_noise())
        .withColumn("_inside", inside)
        .where(~F.col("_noise") & ~F.col("_inside"))
        .drop("_noise", "_inside")
    )


def with_text_len(nodes: DataFrame, key="page_id") -> DataFrame:
    """Adds ``text_len``: the stripped text of an element and all below it.

    A running sum of own lengths is taken over open and close positions; an element's text
    is the sum at its close less the sum before its open.
    """
    order = Window.partitionBy(key).orderBy("pre").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_open = F.sum("own_len").over(order) - F.col("own_len")
    rest = [c for c in nodes.columns if c != key]
    opened = nodes.withColumn("_before", at_open).select(
        key,
        F.explode(
            F.array(
                F.struct(
                    F.col("open_pos").alias("pos"),
                    F.col("own_len").alias("add"),
                    F.lit(None).cast(nodes.select(F.struct(*rest)).schema[0].dataType).alias("node"),
                    F.lit(None).cast("long").alias("before"),
                ),
                F.struct(
                    F.col("close_pos").alias("pos"),
                    F.lit(0).alias("add"),
                    F.struct(*rest).alias("node"),
                    F.col("_before").alias("before"),
                ),
            )
        ).alias("_at"),
    ).select(key, "_at.*")
    by_position = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = F.sum("add").over(by_position)
    closed = opened.withColumn("_sum", running).where(F.col("before").isNotNull())
    return closed.select(key, "node.*", (F.col("_sum") - F.col("before")).cast("int").alias("text_len"))


def scored_nodes(nodes: DataFrame, key="page_id") -> DataFrame:
    """Elements left after noise removal, with their text length."""
    return with_text_len(without_noise(nodes, key), key)


def main_div(nodes: DataFrame, key="page_id") -> DataFrame:
    """The div with the longest text above the threshold; the earlier one wins ties."""
    best = F.max(F.struct(F.col("text_len"), (-F.col("pre")).alias("back"))).alias("_best")
    divs = scored_nodes(nodes, key).where((F.col("tag") == "div") & (F.col("text_len") > MIN_DIV_TEXT))
    return divs.groupBy(key).agg(best).select(
        key, (-F.col("_best.back")).alias("pre"), F.col("_best.text_len").alias("text_len")
    )


def with_main(scored: DataFrame, key="page_id") -> DataFrame:
    """Adds ``main``: (tier, pre, last, tag, text_len) of the page's main content.

    Selectors in order, first match each and only if long enough; else the longest div;
    else the body; else tier ``none``.
    """
    page = Window.partitionBy(key)
    firsts = {
        f"_first_{i}": F.min(F.when(matches(s), F.col("pre"))).over(page) for i, s in enumerate(CONTENT_SELECTORS)
    }
    first_body = F.min(F.when(F.col("tag") == "body", F.col("pre"))).over(page)
    chosen = [
        F.when((F.col(name) == F.col("pre")) & (F.col("text_len") > MIN_SELECTED_TEXT), F.lit(i))
        for i, name in enumerate(firsts)
    ]
    n = len(CONTENT_SELECTORS)
    is_div = (F.col("tag") == "div") & (F.col("text_len") > MIN_DIV_TEXT)
    rank = F.coalesce(
        *chosen,
        F.when(is_div, F.lit(n)),
        F.when(F.col("_first_body") == F.col("pre"), F.lit(n + 1)),
        F.when(F.col("pre") == 0, F.lit(n + 2)),
    )
    tier = (
        F.when(F.col("_rank") < n, "selector").when(F.col("_rank") == n, "div").when(F.col("_rank") == n + 1, "body")
    ).otherwise("none")
    # Within the div tier the longer text wins, then the earlier element.
    longer_first = F.when(F.col("_rank") == n, -F.col("text_len")).otherwise(F.lit(0))
    candidate = F.when(
        F.col("_rank").isNotNull(),
        F.struct(
            F.col("_rank").alias("rank"),
            longer_first.alias("longer_first"),
            "pre",
            "last",
            tier.alias("tier"),
            F.when(F.col("_rank") < n + 2, F.col("tag")).alias("tag"),
            "text_len",
        ),
    )
    return (
        scored.withColumns({**firsts, "_first_body": first_body})
        .withColumn("_rank", rank)
        .withColumn("main", F.min(candidate).over(page))
        .drop(*firsts, "_first_body", "_rank")
    )


def main_content(nodes: DataFrame, key="page_id") -> DataFrame:
    """(page, tier, tag, text_len) of the main content."""
    scored = with_main(scored_nodes(nodes, key), key)
    return scored.where(F.col("pre") == F.col("main.pre")).select(
        key, F.col("main.tier").alias("tier"), F.col("main.tag").alias("tag"), F.col("main.text_len").alias("text_len")
    )


def cleaned_markup(nodes: DataFrame, key="page_id") -> DataFrame:
    """Cleaned page markup put together from the element table (``with_markup=True``).

    Leaves without text are dropped, short leaf spans and divs lose their tags, and the
    remaining pieces are joined in document order.
    """
    scored = with_main(scored_nodes(nodes, key), key)
    order = Window.partitionBy(key).orderBy("pre")
    next_pre = F.lead("pre").over(order)
    inside = scored.withColumn("_leaf", F.coalesce(next_pre > F.col("last"), F.lit(True))).where(
        F.col("pre").between(F.col("main.pre"), F.col("main.last"))
    )
    pruning = (F.col("main.tier") != "none") & (F.col("pre") != F.col("main.pre")) & F.col("_leaf")
    empty = pruning & (F.col("text_len") == 0)
    short = pruning & F.col("tag").isin(UNWRAPPED_TAGS) & (F.col("text_len") < MIN_WRAPPER_TEXT)
    tags = F.array(
        F.struct(F.col("open_pos").alias("pos"), F.col("open_html").alias("html")),
        F.struct(F.col("close_pos").alias("pos"), F.col("close_html").alias("html")),
    )
    pieces = F.when(short, F.col("pieces")).otherwise(F.concat(tags, F.col("pieces")))
    kept = inside.where(~empty).select(key, "main", F.explode(pieces).alias("_piece"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("_piece")), lambda p: p["html"]), "")
    return kept.groupBy(key).agg(joined.alias("cleaned"), F.any_value("main").alias("main")).select(
        key,
        "cleaned",
        F.col("main.tier").alias("tier"),
        F.col("main.tag").alias("tag"),
        F.col("main.text_len").alias("text_len"),
    )
