import datetime as dt
import hashlib
import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from folioflow import functions as fn
from folioflow.constants import CHALLENGE_WINDOW
from folioflow.operators.classify import classify_fetch, usable_pages
from folioflow.operators.filters import candidate_filter, filter_by_date, filter_by_date_compat


def one(values):
    return [(v,) for v in values]


def test_content_hash(column):
    got = column(fn.content_hash("s"), one(["abc", "", None, "é"]), "s string")
    assert got == [hashlib.sha256(b"abc").hexdigest(), None, None, hashlib.sha256("é".encode()).hexdigest()]
    assert column(fn.content_hash("b"), one([b"abc", b"", None]), "b binary") == [got[0], None, None]


def test_safe_id_keeps_what_isalnum_keeps(column):
    words = ["ADJ-0001/é_x ½.²", "a b", "", "日本語!", "x́y", "Ⅷ-9"]
    want = ["".join(c for c in w if c.isalnum() or c in "-_") for w in words]
    assert column(fn.safe_id("s"), one(words), "s string") == want


def test_safe_body(column):
    assert column(fn.safe_body("s"), one([" Labour Court! ", "A&B", "  "]), "s string") == ["Labour_Court", "AB", ""]


def test_object_paths(column):
    rows = [("Labour Court", "2024-01", "AD/1", "pdf"), (None, None, "x", None), ("b", "m", None, "pdf")]
    schema = "b string, m string, i string, e string"
    assert column(fn.object_path("b", "m", "i", "e"), rows, schema) == ["Labour_Court/2024-01/AD1.pdf", "unknown/unknown/x.html", None]
    assert column(fn.transformed_path("b", "m", "i", "e"), rows, schema)[0] == "Labour Court/2024-01/AD1.pdf"


def test_parse_doc_date(column):
    good = {
        "2024-01-05": dt.datetime(2024, 1, 5),
        "2024-1-5": dt.datetime(2024, 1, 5),
        "5/1/2024": dt.datetime(2024, 1, 5),
        "05-01-2024": dt.datetime(2024, 1, 5),
        "2024-01-05T10:00:00": dt.datetime(2024, 1, 5, 10),
        "2024-01-05T10:00:00.123456Z": dt.datetime(2024, 1, 5, 10),
    }
    bad = ["31/02/2024", "2024-01-05 10:00:00", "24-01-05", "05/01/24", "", None, "05/01-2024", "2024-13-01", "2024-01-05T25:00:00", "x2024-01-05"]
    got = column(fn.parse_doc_date("s"), one([*good, *bad]), "s string")
    assert got == [*good.values(), *[None] * len(bad)]


def test_parse_listing_date(column):
    day = dt.date(2024, 3, 5)
    texts = ["5 March 2024", "5  march 2024", " 05/03/2024\n", "5-3-2024", "2024-03-05", "5 Jan 2024", "30 February 2024", "", None]
    assert column(fn.parse_listing_date("s"), one(texts), "s string") == [day] * 5 + [None] * 4


def test_url_date(column):
    urls = ["/cases/2026/march/x", "/cases/2026/foo/x", "/other/x", "https://x/en/cases/2024/December/a.html", None]
    want = [dt.date(2026, 3, 1), dt.date(2026, 1, 1), None, dt.date(2024, 12, 1), None]
    assert column(fn.url_date("s"), one(urls), "s string") == want


def test_regex_date(column):
    texts = ["on 5 Jan 2024 and 01/02/2023", "5\nmarch 2024", "nothing", None, "x" * 30000 + " 01/02/2023"]
    assert column(fn.regex_date("s"), one(texts), "s string") == ["01/02/2023", "5\nmarch 2024", None, None, "01/02/2023"]
    assert column(fn.regex_date("s", 20000), one(texts), "s string")[-1] is None


def test_resolve_date(column):
    url = "https://x/cases/2020/june/a"
    rows = [
        ("05/03/2024", "01/01/2021", url),
        ("", "seen 01/01/2021", url),
        ("", "none", url),
        ("unknown", "01/01/2021", url),  # text that does not parse keeps the page from being searched
        (None, "5 Jan 2021", "/x"),  # found but in a form that does not parse
    ]
    want = [dt.date(2024, 3, 5), dt.date(2021, 1, 1), dt.date(2020, 6, 1), dt.date(2020, 6, 1), None]
    schema = "t string, h string, u string"
    assert column(fn.resolve_date("t", "h", "u"), rows, schema) == want
    months = column(fn.partition_month(fn.resolve_date("t", "h", "u"), F.lit("2019-09")), rows, schema)
    assert months == ["2024-03", "2021-01", "2020-06", "2020-06", "2019-09"]


def test_url_identifier(column):
    urls = ["https://x/en/cases/2026/march/adj-1.html/", "https://x/a?b=c", "x"]
    assert column(fn.url_identifier("s"), one(urls), "s string") == ["ADJ-1.HTML", "A?B=C", "X"]
    rows = [("  ", urls[0]), (" id \n", urls[0]), (None, urls[1])]
    assert column(fn.identifier_or_url("t", "u"), rows, "t string, u string") == ["ADJ-1.HTML", "id", "A?B=C"]


def test_content_type(column):
    got = column(fn.content_type("s"), one(["PDF", "zzz", "htm", None]), "s string")
    assert got == ["application/pdf", "application/octet-stream", "text/html", "application/octet-stream"]


def test_url_join_agrees_with_urllib(column):
    rng = random.Random(7)
    bases = ["https://h.org/a/b/c.html?q=1#f", "http://h.org", "https://h.org/", "https://h.org/a/"]
    hrefs = ["", "#x", "?y=2", "/r/s.html", "//o.org/z", "http://o.org/../q", "mailto:a@b", "../../../../x", "./a/../b/.", "a/..", "..", "."]
    for _ in range(150):
        parts = [rng.choice(["a", "b.html", "..", ".", "c d", "é"]) for _ in range(rng.randint(1, 5))]
        hrefs.append(rng.choice(["", "/"]) + "/".join(parts) + rng.choice(["", "/", "?k=v", "#f"]))
    rows = [(b, h) for b in bases for h in hrefs]
    got = column(fn.url_join("b", "h"), rows, "b string, h string")
    assert [(r, g) for r, g in zip(rows, got) if g != urljoin(*r)] == []


def test_within_domains(column):
    urls = ["https://site.ie/x", "http://www.SITE.ie:80/", "https://notsite.ie", "/relative", None]
    assert column(fn.within_domains("s", ["site.ie"]), one(urls), "s string") == [True, True, False, False, False]


def test_classify_fetch(spark):
    late = "x" * 5000 + "cloudflare"
    rows = [
        (1, 403, "<b>Just A Moment</b>", None),
        (2, 403, "plain", None),
        (3, 429, "", "60"),
        (4, 429, "", "Wed, 21 Oct"),
        (5, 520, "", None),
        (6, 525, "", None),
        (7, 200, "cloudflare", None),
        (8, 503, late, None),
        (9, 503, None, None),
    ]
    df = spark.createDataFrame(rows, "i int, status int, body string, retry_after string")
    got = {r["i"]: (r["fetch_class"], r["retry_after_seconds"]) for r in classify_fetch(df).collect()}
    assert got == {
        1: ("challenge", None), 2: ("http_error", None), 3: ("rate_limited", 60), 4: ("rate_limited", 30), 5: ("edge_error", None),
        6: ("http_error", None), 7: ("other", None), 8: ("challenge", None), 9: ("http_error", None),
    }
    assert classify_fetch(df, window=CHALLENGE_WINDOW).where("i = 8").first()["fetch_class"] == "http_error"
    assert [r["i"] for r in usable_pages(df).collect()] == [7]
    raw = df.withColumn("body", F.concat(F.unhex(F.lit("FFFE")), F.col("body").cast("binary")))
    assert classify_fetch(raw).where("i = 1").first()["fetch_class"] == "challenge"


@pytest.fixture
def dated(spark):
    days = ["2024-01-04", "2024-01-05T23:59:59", "06/01/2024", "05-01-2024", "n/a", None, "2024-01-06", "05/01/2022"]
    return spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, date string")


def ids(df):
    return sorted(r["i"] for r in df.collect())


def test_filter_by_date(dated):
    assert ids(filter_by_date(dated, "2024-01-05", "2024-01-05")) == [1, 3]
    assert ids(filter_by_date(dated, None, "2024-01-04")) == [0, 7]
    assert ids(filter_by_date(dated, "2024-01-06", None)) == [2, 6]
    assert ids(filter_by_date(dated)) == list(range(8))


def test_candidate_filter(dated):
    assert ids(candidate_filter(dated, "2024-01-05", "2024-01-06")) == [1, 2, 3, 6]
    assert ids(candidate_filter(dated, None, "2024-01-05")) == [2, 3]
    # No end: the upper bound is text that sorts above every ISO date.
    assert ids(candidate_filter(dated, "2024-01-05", None)) == [1, 2, 3, 6]
    assert ids(filter_by_date_compat(dated, "2020-01-01", "2026-12-31")) == [0, 1, 6]


def test_stored_doc_date_is_used_and_pushed_down(spark, tmp_path, dated):
    dated.withColumn("doc_date", fn.parse_doc_date("date")).write.parquet(str(tmp_path / "t"))
    hit = filter_by_date(spark.read.parquet(str(tmp_path / "t")), "2024-01-05", "2024-01-05")
    assert ids(hit) == [1, 3]
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_date" in plan
