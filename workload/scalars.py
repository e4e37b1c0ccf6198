"""Scalar functions over whole columns."""

from pyspark.sql import functions as F

from folioflow import functions as fn
from folioflow.constants import TEXT_DATE_WINDOW

from .registry import query
from .views import CTE, SITE, ctes, docs, landing, table


@query("content_hash", "SELECT doc_id, CASE WHEN text <> '' THEN sha256(text) END AS file_hash FROM documents")
def content_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fn.content_hash("text").alias("file_hash"))


@query("safe_id", r"SELECT doc_id, regexp_replace(text, '[^\p{L}\p{N}_-]', '', 'g') AS safe_id FROM documents")
def safe_id(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fn.safe_id("text").alias("safe_id"))


@query(
    "safe_body",
    r"""SELECT doc_id, replace(trim(regexp_replace(' ' || source || ' & (' || lang || ')! ', '[^\p{L}\p{N}_ -]', '', 'g')), ' ', '_')
        AS safe_body FROM documents""",
)
def safe_body(spark, sf):
    name = F.concat(F.lit(" "), "source", F.lit(" & ("), "lang", F.lit(")! "))
    return table(spark, sf, "documents").select("doc_id", fn.safe_body(name).alias("safe_body"))


@query(
    "object_path",
    ctes("docs", "landing")
    + """SELECT identifier,
           replace(body || ' x', ' ', '_') || '/' || partition_date || '/' || identifier || '.' || document_type AS landing_path,
           body || ' x' || '/' || CASE WHEN doc_id % 5 = 4 THEN 'unknown' ELSE partition_date END || '/' || identifier || '.html'
             AS transformed_path
         FROM landing""",
)
def object_path(spark, sf):
    body = F.concat("body", F.lit(" x"))
    month = F.when(F.col("doc_id") % 5 != 4, F.col("partition_date"))
    return landing(spark, sf).select(
        "identifier",
        fn.object_path(body, "partition_date", "identifier", "document_type").alias("landing_path"),
        fn.transformed_path(body, month, "identifier", F.lit(None).cast("string")).alias("transformed_path"),
    )


@query(
    "parse_doc_date",
    ctes("docs", "landing")
    + """SELECT identifier, coalesce(try_strptime(substr(date, 1, 19), '%Y-%m-%dT%H:%M:%S'),
           try_strptime(substr(date, 1, 19), '%Y-%m-%d'), try_strptime(substr(date, 1, 19), '%d/%m/%Y'),
           try_strptime(substr(date, 1, 19), '%d-%m-%Y')) AS doc_date FROM landing""",
)
def parse_doc_date(spark, sf):
    return landing(spark, sf).select("identifier", fn.parse_doc_date("date").alias("doc_date"))


CTE["dated"] = """dated AS (
  SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text || ' Dated ' || strftime(d, '%d/%m/%Y') || '.'
                      WHEN 1 THEN text || ' Dated ' || strftime(d, '%-d') || ' march 2024'
                      WHEN 2 THEN 'On 5 Jan 2024 ' || text || ' and 06/07/2021' ELSE text END AS text
  FROM docs)"""


def dated(spark, sf):
    n = F.col("doc_id") % 4
    text = (
        F.when(n == 0, F.concat("text", F.lit(" Dated "), F.date_format("d", "dd/MM/yyyy"), F.lit(".")))
        .when(n == 1, F.concat("text", F.lit(" Dated "), F.date_format("d", "d"), F.lit(" march 2024")))
        .when(n == 2, F.concat(F.lit("On 5 Jan 2024 "), "text", F.lit(" and 06/07/2021")))
        .otherwise(F.col("text"))
    )
    return docs(spark, sf).select("doc_id", text.alias("text"))


_FOUND = r"""coalesce(nullif(regexp_extract({0}, '(\d{{2}}/\d{{2}}/\d{{4}})', 1), ''),
  nullif(regexp_extract({0}, '(?i)(\d{{1,2}}\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{{4}})', 1), ''))"""


@query("regex_date", ctes("docs", "dated") + f"SELECT doc_id, {_FOUND.format('text')} AS found FROM dated")
def regex_date(spark, sf):
    return dated(spark, sf).select("doc_id", fn.regex_date("text").alias("found"))


@query(
    "regex_date_window",
    ctes("docs", "dated") + f"SELECT doc_id, {_FOUND.format('substr(text, 1, 20000)')} AS found FROM dated",
)
def regex_date_window(spark, sf):
    """The leading window is part of how items get their date."""
    return dated(spark, sf).select("doc_id", fn.regex_date("text", TEXT_DATE_WINDOW).alias("found"))


def _listing_text(d):
    n = F.col("doc_id") % 6
    return (
        F.when(n == 0, F.date_format(d, "d/M/yyyy"))
        .when(n == 1, F.date_format(d, "d MMMM yyyy"))
        .when(n == 2, F.concat(F.lit("  "), F.date_format(d, "dd"), F.lit("  "), F.lower(F.date_format(d, "MMMM")), F.date_format(d, " yyyy ")))
        .when(n == 3, F.date_format(d, "dd-MM-yyyy"))
        .when(n == 4, F.date_format(d, "yyyy-MM-dd"))
        .otherwise(F.date_format(d, "d MMM yyyy."))
    )


@query("parse_listing_date", ctes("docs") + "SELECT doc_id, CASE WHEN doc_id % 6 < 5 THEN d END AS listing_date FROM docs")
def parse_listing_date(spark, sf):
    return docs(spark, sf).select("doc_id", fn.parse_listing_date(_listing_text("d")).alias("listing_date"))


def _case_url():
    month = F.when(F.col("doc_id") % 4 == 3, "foo").otherwise(F.date_format("d", "MMMM"))
    part = F.when(F.col("doc_id") % 5 == 4, "/other/").otherwise("/cases/")
    return F.concat(F.lit(SITE), part, F.date_format("d", "yyyy"), F.lit("/"), month, F.lit("/x.html"))


_URL_DAY = """CASE WHEN doc_id % 5 = 4 THEN NULL WHEN doc_id % 4 = 3 THEN make_date(year(d), 1, 1)
              ELSE make_date(year(d), month(d), 1) END"""


@query("url_date", ctes("docs") + f"SELECT doc_id, {_URL_DAY} AS url_date FROM docs")
def url_date(spark, sf):
    return docs(spark, sf).select("doc_id", fn.url_date(_case_url()).alias("url_date"))


_RESOLVED = f"""CASE doc_id % 3 WHEN 0 THEN d
  WHEN 1 THEN CASE WHEN doc_id % 2 = 0 THEN d ELSE {_URL_DAY} END ELSE {_URL_DAY} END"""


def _resolved():
    """Date text that parses, none at all (then the page may have one), or one that does not parse."""
    text = F.when(F.col("doc_id") % 3 == 0, F.date_format("d", "d MMMM yyyy")).when(F.col("doc_id") % 3 == 1, "").otherwise("n/a")
    words = F.regexp_replace("text", "[0-9/]", "")
    page = F.when(
        F.col("doc_id") % 2 == 0, F.concat(F.date_format("d", "'Dated 'dd/MM/yyyy. "), words)
    ).otherwise(words)
    return fn.resolve_date(text, page, _case_url())


@query("resolve_date", ctes("docs") + f"SELECT doc_id, {_RESOLVED} AS doc_date FROM docs")
def resolve_date(spark, sf):
    return docs(spark, sf).select("doc_id", _resolved().alias("doc_date"))


@query(
    "partition_month",
    ctes("docs") + f"SELECT doc_id, coalesce(strftime({_RESOLVED}, '%Y-%m'), 'label') AS partition_date FROM docs",
)
def partition_month(spark, sf):
    return docs(spark, sf).select("doc_id", fn.partition_month(_resolved(), F.lit("label")).alias("partition_date"))


@query(
    "url_identifier",
    "SELECT page_id, upper(list_extract(string_split(regexp_replace(url || '//', '/+$', ''), '/'), -1)) AS identifier FROM pages",
)
def url_identifier(spark, sf):
    url = F.concat("url", F.lit("//"))
    return table(spark, sf, "pages").select("page_id", fn.url_identifier(url).alias("identifier"))


@query(
    "content_type",
    """SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/msword'
         WHEN 2 THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
         WHEN 3 THEN 'text/html' WHEN 4 THEN 'text/html' ELSE 'application/octet-stream' END AS content_type
       FROM documents""",
)
def content_type(spark, sf):
    names = F.array(*[F.lit(x) for x in ["PDF", "doc", "Docx", "html", "HTM", "zzz"]])
    ext = F.element_at(names, (F.col("doc_id") % 6 + 1).cast("int"))
    return table(spark, sf, "documents").select("doc_id", fn.content_type(ext).alias("content_type"))


@query(
    "url_join",
    f"""SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'http://o.example.org/a' WHEN 1 THEN '{SITE}/root/x.html?y=1'
          WHEN 2 THEN '{SITE}/en/' || lang || '/rel-1.html' WHEN 3 THEN '{SITE}/en/up.html'
          WHEN 4 THEN '{SITE}/en/' || lang || '/p.html?page=2' WHEN 5 THEN '{SITE}/en/' || lang || '/p.html?q=1#frag'
          WHEN 6 THEN 'https://cdn.example.org/x' ELSE '{SITE}/en/' || lang || '/p.html?q=1#top' END AS url
        FROM documents""",
)
def url_join(spark, sf):
    hrefs = ["http://o.example.org/a", "/root/x.html?y=1", "rel-1.html", "../up.html", "?page=2", "#frag", "//cdn.example.org/x", ""]
    href = F.element_at(F.array(*[F.lit(h) for h in hrefs]), (F.col("doc_id") % 8 + 1).cast("int"))
    base = F.concat(F.lit(SITE + "/en/"), "lang", F.lit("/p.html?q=1#top"))
    return table(spark, sf, "documents").select("doc_id", fn.url_join(base, href).alias("url"))
