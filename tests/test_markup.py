import random

import pytest

from folioflow.operators import clean, links, nodes
from folioflow.operators.markup import clean as clean_one
from folioflow.operators.markup import parse


def body_of(inner):
    return f"<html><body>{inner}</body></html>"


def test_short_body():
    assert clean_one("<html><body>Test</body></html>") == ("<body>Test</body>", "body", "body", 4)


def test_content_by_id():
    got = clean_one("<html><body><script>foo</script><div id='content'>" + "C" * 300 + "</div></body></html>")
    assert got.html == '<div id="content">' + "C" * 300 + "</div>"
    assert (got.tier, got.tag, got.text_len) == ("selector", "div", 300)


def test_longest_div():
    got = clean_one(body_of("<div>" + "B" * 400 + "</div><div>" + "A" * 400 + "</div>"))
    assert (got.tier, got.html) == ("div", "<div>" + "B" * 400 + "</div>")  # the earlier of equals


def test_nothing_to_choose():
    assert clean_one("") == ("", "none", None, 0)
    assert clean_one("<p>a &amp; <b></b>b") == ("<p>a &amp; <b></b>b</p>", "none", None, 4)
    assert clean_one("<!DOCTYPE html><!-- c --><i>x</i>").html == "<!DOCTYPE html>\n<!-- c --><i>x</i>"


def test_short_first_match_skips_the_selector():
    long = "L" * 250
    page = body_of(f"<div class='content'>short</div><div class='content'>{long}</div><p id='content'>{long}</p>")
    got = clean_one(page)
    assert (got.tag, got.tier) == ("p", "selector")
    # Of two selectors that fit, the earlier in the list wins, not the earlier in the page.
    assert clean_one(body_of(f"<article>{long}</article><main>{long}</main>")).tag == "main"


def test_noise_goes_before_scoring():
    inner = "<nav>" + "n" * 300 + "</nav><div class='x menu'>m</div><p id='footer'>f</p><header>h</header>ok"
    got = clean_one(body_of(f"<main>{inner}</main>"))
    assert got.html == "<body><main>ok</main></body>"
    assert clean_one(body_of("<p class='Menu'>kept</p>")).html == "<body><p class=\"Menu\">kept</p></body>"


def test_pruning():
    long = "x" * 201
    html = clean_one(body_of(f"<main>{long}<div><span></span></div><br><img src='a'><span>short</span><em>e</em><span>long enough</span></main>")).html
    assert html == f"<main>{long}<div></div>short<em>e</em><span>long enough</span></main>"


def test_parser_rules():
    long = "x" * 201
    html = clean_one(body_of(f"<main>{long}<p>one<p>two</b></p><a href='?a=1&amp;b=\"2\"' class=' a  b ' disabled>&lt;&eacute;&#8364;&nosuch;</a></main>")).html
    assert html == (
        f"<main>{long}<p>one<p>two</p>"
        + "<a href='?a=1&amp;b=\"2\"' class=\"a b\" disabled=\"\">&lt;é€&amp;nosuch</a></p></main>"
    )


def test_whitespace_and_pre():
    long = "x" * 201
    assert clean_one(body_of(f"<main>{long}<b>a</b>   <b>c</b> \n <pre>  \n </pre><pre> k </pre></main>")).html == (
        f"<main>{long}<b>a</b> <b>c</b>\n<pre> k </pre></main>"
    )


def test_void_elements_are_written_short():
    html = clean_one("<p>a<br>b<br/>c<hr></p>").html
    assert html == "<p>a<br/>b<br/>c<hr/></p>"
    assert clean_one("<p>a<br></br>b</p>").html == "<p>a<br/>b</p>"


def test_deep_nesting_is_linear():
    page = "<p>" * 20000 + "x" * 400
    assert clean_one("<body>" + page).text_len == 400
    assert len(parse(page).elements) == 20001


def test_bytes():
    assert clean_one("<body>é</body>".encode()).html == "<body>é</body>"
    assert clean_one(b"<body>\xe9</body>").html == "<body>é</body>"


def test_null_and_errors_stay_rows(spark, monkeypatch):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<body>a</body>")], "page_id int, html string")
    got = {r["page_id"]: r for r in clean.clean_pages(df).collect()}
    assert got[1]["cleaned"] is None and got[1]["error"] is None
    assert got[2]["cleaned"] == "" and got[2]["tier"] == "none"
    assert got[3]["cleaned"] == "<body>a</body>"
    broken = clean.markup.clean
    monkeypatch.setattr(clean.markup, "clean", lambda _: 1 / 0)
    import pandas as pd

    out = clean.clean_markup.func(pd.Series(["<p>", b"<p>\xff"]))
    assert list(out["cleaned"]) == ["<p>", "<p>�"] and out["error"].str.startswith("ZeroDivisionError").all()
    monkeypatch.setattr(clean.markup, "clean", broken)


def test_pages_are_cleaned_in_parts_of_bounded_size(spark):
    import pyarrow as pa

    pages = [None, "", "<body><p>" + "long " * 400_000 + "</p></body>", *[f"<body><p>{i}{'x' * 300}</p></body>" for i in range(9000)], None]
    for kind in (pa.string(), pa.binary()):
        batch = pa.array(pages, kind)
        out = list(clean.clean_in_parts.func(iter([batch, batch.slice(0, 0)])))
        assert len(out) > 3 and max(len(part) * 330 for part in out) < 2 * clean.PART_BYTES
        rows = [row for part in out for row in part.to_pylist()]
        assert [r["cleaned"] for r in rows] == [None if p is None else p for p in pages] and [r["tier"] for r in rows[:2]] == [None, "none"]
    # Pages are cleaned that way, wherever they come from.
    df = spark.createDataFrame([(1, "<p>a</p>")], "page_id int, html string")
    for cleaned in (clean.clean_pages(df), clean.with_cleaned(df, "html")):
        assert "clean_in_parts" in cleaned._jdf.queryExecution().executedPlan().toString()


def random_page(rng):
    tags = ["div", "span", "p", "b", "main", "article", "nav", "br", "script", "body", "ul", "li", "footer", "pre"]
    attrs = ["", "", "", " class='content'", " class='x menu'", " id='content'", " id='nav'", " class='post-content y'", ' title="a&quot;b"']
    out = ["<html>"] if rng.random() < 0.5 else []
    for _ in range(rng.randint(0, 60)):
        pick = rng.random()
        if pick < 0.4:
            out.append(f"<{rng.choice(tags)}{rng.choice(attrs)}>")
        elif pick < 0.65:
            out.append(f"</{rng.choice(tags)}>")
        elif pick < 0.7:
            out.append("<!-- c -->")
        else:
            out.append(rng.choice(["", " ", " \n", "a &amp; b &lt;", "word ", "é" * rng.choice([3, 120, 320])]))
    return "".join(out)


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(11)
    made = [(i, random_page(rng)) for i in range(600)]
    site = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").selectExpr("page_id + 10000 AS page_id", "html")
    return spark.createDataFrame(made, "page_id long, html string").unionByName(site)


def test_both_cleaning_routes_agree(pages):
    columns = ["page_id", "cleaned", "tier", "tag", "text_len"]
    fused = {r["page_id"]: r for r in clean.clean_pages(pages).select(*columns).collect()}
    by_nodes = {r["page_id"]: r for r in clean.clean_pages_by_nodes(pages).select(*columns).collect()}
    assert len(fused) == pages.count()
    assert {r["tier"] for r in fused.values()} == {"selector", "div", "body", "none"}
    assert [(fused[i], by_nodes.get(i)) for i in fused if fused[i] != by_nodes.get(i)] == []


def test_main_content_agrees(pages):
    columns = ["page_id", "tier", "tag", "text_len"]
    chosen = nodes.main_content(nodes.dom_nodes(pages)).select(*columns).collect()
    assert sorted(chosen) == sorted(clean.clean_pages(pages).select(*columns).collect())


def test_node_intervals(spark):
    df = spark.createDataFrame([(1, "<ul><li>a<li>b</ul><p>c")], "page_id long, html string")
    got = {r["pre"]: r for r in nodes.dom_nodes(df).collect()}
    assert [(got[i]["tag"], got[i]["parent"], got[i]["last"], got[i]["depth"]) for i in range(5)] == [
        ("", None, 4, 0), ("ul", 0, 3, 1), ("li", 1, 3, 2), ("li", 2, 3, 3), ("p", 0, 4, 1),
    ]


LISTING = """<ul>
<li class="each-item x"><h2 class="title"> <a href="/t1"> ADJ-1 <b>x</b></a></h2><span class="date"> 01/02/2024
 </span><a class="btn-primary" href="v1">View</a></li>
<li class="each-item"><h2 class="title"><a href="/t2"></a></h2><a class="btn-primary" href="">View</a></li>
<li class="each-item"><h2 class="title"><a>no link</a></h2></li>
<li class="other"><h2 class="title"><a href="/t4">outside</a></h2></li>
</ul><a class="next">dead</a><a class="next" href="?p=2">2</a><a class="next" href="?p=3">3</a>"""


def test_listing_rows(spark):
    df = spark.createDataFrame([(1, "https://s.org/en/search/?p=1", LISTING)], "page_id long, url string, html string")
    rows = links.listing_rows(df).orderBy("row_pre").collect()
    assert [(r["link"], r["identifier_text"], r["date_text"]) for r in rows] == [
        ("https://s.org/en/search/v1", "ADJ-1", "01/02/2024"),
        ("https://s.org/t2", "", ""),
    ]
    assert [(r["dst"]) for r in links.next_links(df).collect()] == ["https://s.org/en/search/?p=2"]


def test_listing_rows_that_were_never_closed(spark):
    """Each row then contains the ones after it and falls back on what they hold."""
    html = "".join(
        f'<li class="each-item"><h2 class="title"><a{" href=" + chr(34) + f"/t{i}" + chr(34) if i % 3 else ""}>{i}</a></h2>' for i in range(200)
    )
    df = spark.createDataFrame([(1, "https://s.org/", html)], "page_id long, url string, html string")
    rows = links.listing_rows(df).orderBy("row_pre").collect()
    want = [(f"https://s.org/t{i if i % 3 else i + 1}", str(i)) for i in range(200)]
    assert [(r["link"], r["identifier_text"]) for r in rows] == want


@pytest.mark.parametrize(
    "inner, want",
    [
        ('<a href="x.pdf">', ("https://s.org/x.pdf", "pdf")),
        ('<a href="x.doc"><a href="y.PDF"><a href="z.pdf">', ("https://s.org/y.PDF", "pdf")),
        ('<a href="Cookie.pdf"><a href="b.pdf"><a href="c.docx">', ("https://s.org/c.docx", "docx")),
        ('<a href="x.Pdf"><a href="x.pdf?y">', None),
        ('<div id="main"><p></p></div><a href="x.pdf">', None),
        ('<a href="x.pdf"><div id="main"><a href="y.doc"></a></div>', ("https://s.org/y.doc", "doc")),
        ('<a href="x.pdf"></a><div id="main"><i></i></div><b id="main"><a href="y.doc"></a></b>', ("https://s.org/y.doc", "doc")),
        ('<a href="x.pdf"></a><a id="main" href="y.docx"></a>', ("https://s.org/y.docx", "docx")),
    ],
)
def test_attachments(spark, inner, want):
    df = spark.createDataFrame([(1, "https://s.org/a", inner)], "page_id long, url string, html string")
    assert [tuple(r)[1:] for r in links.attachments(df).collect()] == ([want] if want else [])


def test_paginate(spark):
    edges = [(f"a{i}", f"a{i + 1}") for i in range(300)] + [("c0", "c1"), ("c1", "c2"), ("c2", "c0"), ("b", "a290"), ("z", "y")]
    seeds = spark.createDataFrame([("a0",), ("b",), ("c1",), ("lonely",)], "page string")
    links_df = spark.createDataFrame(edges, "src string, dst string")
    depth = {r["page"]: r["depth"] for r in links.paginate(seeds, links_df).collect()}
    want = {"lonely": 0, "b": 0, "c1": 0, "c2": 1, "c0": 2}
    for i in range(301):
        want[f"a{i}"] = i if i < 290 else i - 289
    assert depth == want
    near = {r["page"] for r in links.paginate(seeds, links_df, max_depth=2).collect()}
    assert near == {p for p, d in want.items() if d <= 2}


def test_paginate_follows_every_link(spark):
    edges = [("p", "a"), ("p", "b"), ("b", "c"), ("c", "d"), ("d", "p"), ("d", "e"), ("e", "f"), ("f", "g"), ("p", "g"), ("x", "y"), ("a", None)]
    seeds = spark.createDataFrame([("p",), ("p",)], "page string")
    got = links.paginate(seeds, spark.createDataFrame(edges, "src string, dst string")).collect()
    assert {r["page"]: r["depth"] for r in got} == {"p": 0, "a": 1, "b": 1, "g": 1, "c": 2, "d": 3, "e": 4, "f": 5} and len(got) == 8


def test_paginate_against_breadth_first_search(spark):
    import random

    pick = random.Random(2)
    for n, m in ((40, 60), (60, 50), (30, 200)):
        edges = [(str(pick.randrange(n)), str(pick.randrange(n))) for _ in range(m)] + [(f"l{i}", f"l{i + 1}") for i in range(40)] + [(str(pick.randrange(n)), f"l{pick.randrange(40)}") for _ in range(3)]
        seeds = [str(pick.randrange(n)) for _ in range(3)]
        want, now, depth = dict.fromkeys(seeds, 0), set(seeds), 0
        while now:
            depth += 1
            now = {b for a, b in edges if a in now and b not in want}
            want |= dict.fromkeys(now, depth)
        got = links.paginate(spark.createDataFrame([(s,) for s in seeds], "page string"), spark.createDataFrame(edges, "src string, dst string")).collect()
        assert {r["page"]: r["depth"] for r in got} == want and len(got) == len(want)


def test_captures_that_share_a_key_stay_apart(spark):
    texts = ["<body><p>one</p></body>", "<body><div>two</div></body>", "<body><div>two</div></body>"]
    pages = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[0])], "page_id long, html string")
    columns = ["page_id", "cleaned", "tier", "tag", "text_len"]

    def rows(df):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)

    assert rows(clean.clean_pages_by_nodes(pages)) == rows(clean.clean_pages(pages)) and pages.count() == 4
