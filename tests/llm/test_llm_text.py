"""Operators of the subpackage against plain versions on small rows: text operators."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from folioflow.llm import chat, decontaminate, html_blocks, language_ppm, line_rules, pii_feistel, toxicity_chain

DOCS = "doc_id long, text string, source string, n_words string"


def docs(spark, texts, source="a"):
    return spark.createDataFrame([(i, t, source, "clash") for i, t in enumerate(texts)], DOCS)


# ---- chat ---------------------------------------------------------------------------------------

CHAT = "conv_id long, turn long, role string, text string, turns string"


def test_chat_round_trip_of_control_strings(spark):
    texts = ["<|im_end|>", "<\\|im_sep|> [INST] [\\/INST] <\\\\/s>", "<", "|im_start|>", None, "", "</s>[INST] ok [/INST]", "é\n<|im_start|>user"]
    rows = [(1, i, "assistant" if i % 2 else "user", t, "x") for i, t in enumerate(texts)]
    template = chat.ChatTemplate()
    made = chat.format_chats(spark.createDataFrame(rows, CHAT), template)
    row = made.select("*", chat.read_turns(F.col("formatted"), template).alias("back")).first()
    assert [(t["role"], t["text"]) for t in row["back"]] == [(r[2], r[3] or "") for r in rows]
    for control in template.controls:
        for segment in row["segments"][1::3]:
            assert control not in segment["text"]
    loss = "".join(t or "" for t in texts[1::2])
    digest = chat.chat_digests(made, template).first()
    assert digest["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and digest["loss_chars"] == len(loss)
    assert digest["formatted_chars"] == len(row["formatted"]) and digest["valid"]


def test_chat_state_machine_and_edges(spark):
    rows = [
        (1, 0, "system", "s", ""), (1, 1, "user", "u", ""), (1, 2, "assistant", "a", ""),
        (2, 0, "user", "u", ""), (2, 1, "user", "u", ""),
        (3, 0, "system", "only", ""),
        (4, 0, None, "x", ""),
        (None, None, "user", "n", ""), (None, None, "user", "n", ""),
    ]
    out = {r["conv_id"]: r for r in chat.chat_digests(chat.format_chats(spark.createDataFrame(rows, CHAT))).collect()}
    assert [out[k]["valid"] for k in (1, 2, 3, 4)] == [True, False, False, False]
    assert [out[k]["first_error"] for k in (1, 2, 3, 4)] == [None, 1, None, 0]
    assert out[None]["n_turns"] == 2
    assert chat.format_chats(spark.createDataFrame([], CHAT)).count() == 0
    with pytest.raises(ValueError):
        chat.ChatTemplate(open="<<a>")


# ---- line rules ---------------------------------------------------------------------------------


def plain_stats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {p for places in at.values() if len(places) > 1 for i in places for p in range(i, i + 5)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_word_stats_against_plain(spark):
    texts = [
        None, "", "   \n\t", "one", "a b c d e f a b c d e", "x " * 40, "é# ü* <b>\n<b>\n\n \n<b>", "a\x0bb\x0cc d\r\ne",
        "p q r s t u v w x y z\n" * 3, " ".join(f"w{i % 7}" for i in range(300)),
    ]
    got = line_rules.word_stats(docs(spark, texts).drop("n_words")).orderBy("doc_id").collect()
    for text, r in zip(texts, got):
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_stats(text), text


def test_frequent_lines_deplete_and_copies_do_not(spark):
    own = [f"this line is number{chr(97 + i)} own words of text q{chr(97 + i)} and more words still" for i in range(12)]
    shared = "Page 1 of the common header line of this host"
    texts = [f"{shared}\n{o}" for o in own] + [f"{shared}\n{shared.replace('1', '2')}\nbit {chr(97 + i)}" for i in range(3)]
    texts += ["the same text again and again in ten words or more here"] * 30 + [None, ""]
    out = line_rules.quality_rules(docs(spark, texts), min_docs=5, max_share=0.2).orderBy("doc_id").collect()
    assert all(r["kept"] for r in out[:12]) and all(r["n_removed_words"] == 10 for r in out[:12])
    assert all(r["depleted"] and not r["kept"] for r in out[12:15])
    assert all(r["kept"] for r in out[15:45]) and not any(r["kept"] for r in out[45:])
    assert line_rules.quality_rules(docs(spark, [])).count() == 0


def test_a_line_above_the_absolute_limit_goes_on_a_host_of_any_size(spark):
    def texts(n):
        return [("Subscribe to our letter, 30 cents\n" if i < 12 else "") + f"own words of text {chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n)]

    for n in (40, 400):
        table = docs(spark, texts(n))
        told = line_rules.removed_words(table, min_docs=5, max_share=0.2, max_docs=10)
        assert {r["n_removed_words"] for r in told.collect()} == {6} and told.count() == 12
        assert line_rules.removed_words(table, min_docs=5, max_share=0.2, max_docs=12).count() == (12 if n == 40 else 0)
    # The texts without these lines; other lines stay as they are.
    table = docs(spark, [*texts(40), None, "", "SUBSCRIBE  to our letter, 99 cents \n\n kept\tas it is ", texts(40)[0]]).withColumn("_host", F.lit("x"))
    out = line_rules.remove_frequent_lines(table, min_docs=5, max_share=0.2).orderBy("doc_id").collect()
    assert out[0]["cleaned_text"] == out[43]["cleaned_text"] == "own words of text aa" and out[13]["cleaned_text"] == out[13]["text"]
    assert out[40]["cleaned_text"] is None and out[41]["cleaned_text"] == "" and out[42]["cleaned_text"] == "\n kept\tas it is "
    assert all(r["_host"] == "x" and r["n_words"] == "clash" for r in out) and len(out) == 44
    assert line_rules.remove_frequent_lines(table.where("false")).count() == 0


# ---- personal data ------------------------------------------------------------------------------


def test_pseudonyms_are_valid_linked_and_undone_by_nothing_else(spark):
    card, iban = "4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00"
    texts = [
        f"pay {card}, or 4111111111111111 to {iban}. call +1 (017) 555-7713!",
        "mail Jane.Doe7@mail.example.com on 2001-02-03 or 3/2/2001 or 03.02.2001 from 10.0.0.255",
        "ssn 123-45-6789 key 0123456789abcdef0123456789abcdef and 0123456789ABCDEF0123456789ABCDEF",
        "wrong card 4111 1111 1111 1112, wrong day 2001-02-30, version 1.2.3.4.5", None, "", card,
    ]
    one = pii_feistel.pseudonymize(docs(spark, texts), "k").orderBy("doc_id").collect()
    out = [r["text"] for r in one]
    assert out[3] == texts[3] and out[4] is None and out[5] == "" and one[3]["pii_kinds"] == []
    assert one[0]["pii_kinds"] == ["card", "card", "iban", "phone"] and one[1]["pii_kinds"] == ["mail", "date", "date", "date", "ipv4"]
    assert one[2]["pii_kinds"] == ["ssn", "key", "key"]
    cards = re.match(r"pay (\d{4} \d{4} \d{4} \d{4}), or (\d{16}) to ([A-Z]{2}\d\d[\d ]+)\. call (\+1 \(\d{3}\) \d{3}-\d{4})!$", out[0])
    assert cards and cards[1].replace(" ", "") == cards[2] and cards[1] == out[6] and cards[1] != card
    assert sum(int(c) if i % 2 else (2 * int(c) - 9 * (c > "4")) for i, c in enumerate(cards[2])) % 10 == 0
    bare = cards[3].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1
    mail, iso, short, dotted, ip = re.match(r"mail (\S+)@mail\.example\.com on (\S+) or (\S+) or (\S+) from (\S+)$", out[1]).groups()
    assert re.fullmatch(r"[A-Z][a-z]{3}\.[A-Z][a-z]{2}\d", mail) and mail != "Jane.Doe7"
    y, m, d = map(int, iso.split("-"))
    assert [int(x) for x in short.split("/")] == [d, m, y] and dotted == f"{d:02}.{m:02}.{y}" and 1900 <= y <= 2099
    assert all(0 <= int(p) < 256 for p in ip.split("."))
    low, high = out[2].split()[3], out[2].split()[5]
    assert low == high.lower() and high == high.upper()


def test_number_permutation_is_one_to_one(spark):
    radix = (7, 11)
    got = spark.range(77).select(pii_feistel.permute_number(F.col("id"), radix, "k", "t").alias("p")).collect()
    assert sorted(r["p"] for r in got) == list(range(77))
    pairs = spark.range(1000).select(pii_feistel.permute_characters(F.lpad(F.col("id").cast("string"), 3, "0"), "k", "t").alias("p")).distinct()
    assert pairs.count() == 1000


# ---- decontamination ----------------------------------------------------------------------------


def test_contaminated_against_plain(spark):
    import random

    pick = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    items = [" ".join(pick.choices(vocab, k=pick.choice([1, 2, 3, 4, 5, 14, 30, 70]))) for _ in range(25)] + [None, "", "!!", "two plus two four"]
    texts = []
    for i in range(80):
        body = pick.choices(vocab, k=pick.randint(0, 900))
        if i % 2:
            words = (pick.choice(items[:25])).split()
            for _ in range(pick.randint(0, 3)):
                words[pick.randrange(len(words))] = "changed"
            body[3:3] = [w.upper() + pick.choice(["", ",", "!\n"]) for w in words]
        texts.append(" ".join(body))
    texts += [None, "", items[0], texts[1], "they say Two plus two: four, all day", "two plus two"]

    def words_of(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    def runs(text, n):
        words = words_of(text)
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}

    want = {}
    for d, t in enumerate(texts):
        for b, i in enumerate(items):
            n = min(5, len(words_of(i)))
            shared = runs(i, n) & runs(t, n)
            if n and len(shared) >= 0.8 * len(runs(i, n)) - 1e-9:
                want[d, b] = len(shared)
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontaminate.contaminated(docs(spark, texts), table).collect()
    assert {(r["doc_id"], r["item_id"]): r["n_shared"] for r in got} == want and len(got) == len(want) > 10
    assert (len(texts) - 2, len(items) - 1) in want
    left = decontaminate.decontaminate(docs(spark, texts), table)
    assert {r["doc_id"] for r in left.collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert decontaminate.contaminated(docs(spark, []), table).count() == 0


def test_accounts_and_dates_beside_words_and_numbers(spark):
    accounts = ["AT611904300234573201", "ES9121000418450200051332", "AT61 1904 3002 3457 3201", "SE4550000000058398257466", "BE68539007547034", "DE89370400440532013000", "NO9386011117947"]
    dates = ["03/25/1985", "3/25/1985", "25/03/1985", "25-03-1985", "03-25-1985", "1985/03/25", "1985-03-25", "25.03.1985"]
    texts = [f"to {v} {after}" for v in accounts + dates for after in ("BIC", "12 May", "A1", "7")]
    rows = pii_feistel.pseudonymize(docs(spark, [*texts, "NR12 4111 1111 1111 1111"]), "k").orderBy("doc_id").collect()
    for text, r in zip(texts, rows):
        value = next(v for v in accounts + dates if text.startswith(f"to {v} "))
        assert r["pii_kinds"] == ["iban" if value in accounts else "date"], text
        assert value not in r["text"] and r["text"].endswith(text[len(f"to {value}") :]), text
    assert rows[-1]["pii_kinds"] == ["card"]


def test_month_first_dates_stay_apart(spark):
    days = [f"{m:02}/{d:02}/{y}" for y in (1985, 1986) for m in range(1, 13) for d in range(1, 29)]
    out = [r["text"] for r in pii_feistel.pseudonymize(docs(spark, days), "k").collect()]
    assert len(set(out)) == len(days)


# ---- html ---------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header class="top"><h1>Site</h1></header>
<div id="cookie-banner"><p>We use cookies to make this page better for all who come here to read it.</p></div><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<main><article><h1>Title &amp; more</h1><p>First   paragraph <b>with &quot;marks&quot;<br>and a line.<p>Short.</p><script>if (a<b) { "</p>" }</script>
<div class="advert"><p>Buy this now, it is a very good thing for all of you.</p></div><form><label>Mail</label></form><ul><li>item one</li><li>item two</li></ul></article>
<section id="comments"><h2>Comments</h2><div><p>I think that this is a long and thoughtful comment with many words in it.</p></div></section></main>
<aside><h3>Related</h3><p>Other text about other things that goes on for quite a while.</p></aside><footer>&copy; Site</footer>"""


@pytest.mark.parametrize(
    "before, after",
    [
        ("<div class='content has-sidebar'><main><article>", "</article></main></div>"),
        ("<div class='page with-sidebar'><article>", "</article></div>"),
        ("<div class='sidebar-right'><article>", "</article></div>"),
        ("<div class='sidebar'><main>", "</main></div>"),
        ("<article class='post tags-news'>", "</article>"),
        ("<article class='post social-science'>", "</article>"),
    ],
)
def test_names_of_wrappers_do_not_hide_the_article(before, after):
    tree = html_blocks.grow(*html_blocks.labelled_blocks())
    head, text = "A title of the story", " ".join(f"w{i}" for i in range(60))
    for top in (f"<div class='entry-header'><h1>{head}</h1></div>", f"<h1 class='post-header'>{head}</h1>"):
        said = f"<div class='comments'><article class='comment'><p>{text} said</p></article></div>"
        got = html_blocks.main_text(f"<body>{before}{top}<p>{text}</p>{said}{after}</body>", tree)[0]
        assert got == f"{head}\n{text}"


def test_html_main_text(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, "v", None, "x"), (3, "w", "", "x"), (4, "z", "<p>a &am b &lt;", "x")], "page_id long, url string, html string, text string")
    out = {r["page_id"]: r for r in html_blocks.extract_pages(pages).collect()}
    want = 'Title & more\nFirst paragraph with "marks" and a line.\nShort.\nitem one\nitem two'
    assert out[1]["text"] == want and out[1]["n_chars"] == len(want)
    assert out[2]["text"] == "" == out[3]["text"] and out[2]["n_chars"] == 0
    assert [b.text for b in html_blocks.page_blocks("<p>a &am b &lt;")] == ["a &am b <"]


BARE_PAGES = [
    ("<html><body>Just a text of a few words.</body></html>", ["Just a text of a few words."]),
    ("<div><p>Short one.</p></div>", ["Short one."]),
    ("<h1>Pancakes</h1><p>Steps</p><ul><li>Take a pan.</li><li>Add salt.</li><li>Serve hot.</li></ul>", ["Pancakes", "Steps", "Take a pan.", "Add salt.", "Serve hot."]),
    (
        "<div><ul><li><a href='/'>Home</a></li><li><a href='/b'>Blog</a></li><li><a href='/c'>About us</a></li></ul></div><div><h1 id='menu'>Menu of the day</h1>"
        "<p class='reader'>We cooked for twelve people and this is what all of them had to say about it afterwards.</p><h2 id='related-work'>Related work</h2><p>None.</p>"
        "<p>Others cooked for ten, see <a href='/x'>their page</a>, and had a good time as well.</p></div><div>© 2020 Somebody</div>",
        [
            "Menu of the day",
            "We cooked for twelve people and this is what all of them had to say about it afterwards.",
            "Related work",
            "None.",
            "Others cooked for ten, see their page, and had a good time as well.",
        ],
    ),
    (
        "<div><h1>A walk</h1><p>It went over the hill and then down to the lake where we had our lunch.</p><p>Fine day.</p><h2>2 comments</h2>"
        "<div><p>I have been there too, and it is worth the long way up from the station.</p></div></div>",
        ["A walk", "It went over the hill and then down to the lake where we had our lunch.", "Fine day."],
    ),
    (
        "<article><h2 id='related-work'>Related work</h2><p class='legal'>A law.</p><div class='warning'><p>Beware.</p></div><section id='links'><h3>Links</h3><p>Two.</p></section>"
        "<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math>.</p><xmp>a <b> &amp;</xmp><p><a name='end'>The end</a></p></article><section class='comments'><p>No.</p></section>",
        ["Related work", "A law.", "Beware.", "Links", "Two.", "So x=2.", "a <b> &amp;", "The end"],
    ),
    ("<main><h1>T</h1><p>All rights reserved.</p><p>We use cookies in all our recipes.</p></main>", ["T", "All rights reserved.", "We use cookies in all our recipes."]),
]


@pytest.mark.parametrize("page, lines", BARE_PAGES)
def test_no_line_of_the_article_is_lost(page, lines):
    tree = html_blocks.grow(*html_blocks.labelled_blocks())
    assert html_blocks.main_text(page, tree)[0].split("\n") == lines


class _PlainBlocks(HTMLParser):
    """A plain splitter of well-formed pages into blocks, to hold the operator's to."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.blocks, self.now, self.raw = [], "", 0
        self.feed(page)
        self.close()
        self.cut()

    def cut(self):
        if self.now.split():
            self.blocks.append(" ".join(self.now.split()))
        self.now = ""

    def handle_starttag(self, tag, attrs):
        if tag in html_blocks.BLOCK_TAGS:
            self.cut()
        self.raw += tag in html_blocks.RAW_TAGS
        self.now += " " * (tag == "br" or tag in html_blocks.RAW_TAGS)

    def handle_endtag(self, tag):
        if tag in html_blocks.BLOCK_TAGS:
            self.cut()
        self.raw -= tag in html_blocks.RAW_TAGS

    def handle_data(self, data):
        if not self.raw:
            self.now += data


def test_blocks_are_those_of_a_plain_splitter():
    pick = random.Random(3)

    def grow(depth):
        kind = pick.choice(("text", "text", "inline", "block", "block", "raw", "comment", "br"))
        if kind == "text" or depth == 0:
            return pick.choice(("w ", "two  words", "a &amp; b", "&lt;p&gt;", "3 < 4", "\n", "é"))
        inner = "".join(grow(depth - 1) for _ in range(pick.randint(0, 4)))
        mark = pick.choice(("", " class='a b'", ' title="x > y"', " id=z"))
        if kind == "inline":
            return "<{0}{1}>{2}</{0}>".format(pick.choice(("b", "span", "a")), mark, inner)
        if kind == "block":
            return "<{0}{1}>{2}</{0}>".format(pick.choice(("div", "section", "ul", "article", "h2", "table")), mark, inner)
        return {"raw": "<script>if (a<b) x('<p>')</script>", "comment": "<!-- <p> - > -->", "br": "<br>"}[kind]

    for _ in range(300):
        page = "".join(grow(5) for _ in range(4))
        assert [b.text for b in html_blocks.page_blocks(page)] == _PlainBlocks(page).blocks


@pytest.mark.parametrize(
    "unit, tail", [("<div>", ""), ("<div><p>x</b>", ""), ("<a href='x ", ""), ("<a href='x >\"y ", ">"), ('<a "', ">"), ("<!-- ", ""), ("<div></p></ul>", "")]
)
def test_blocks_in_linear_time(unit, tail):
    def seconds(n):
        begun = time.process_time()
        html_blocks.page_blocks(unit * n + tail)
        return time.process_time() - begun

    assert seconds(120_000) < 10 * max(seconds(30_000), 0.05)


def test_html_columns_of_the_same_names(spark):
    pages = spark.createDataFrame([("<p>a text of some words</p>", 1, "m", 5)], "html string, n_kept int, _main string, page_id int")
    row = html_blocks.extract_pages(pages).collect()[0]
    assert (row["text"], row["n_kept"], row["_main"], row["page_id"]) == ("a text of some words", 1, "m", 5)
    assert html_blocks.extract_pages(pages.limit(0)).collect() == []


def test_tree_on_held_out_layouts():
    tree = html_blocks.grow(*html_blocks.labelled_blocks())
    x, y = html_blocks.labelled_blocks(100, seed=1)
    assert (html_blocks.is_main(tree, x) == (y > 0)).mean() > 0.98


# ---- toxicity -----------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    tables = [spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels")]
    labels = tables[1].withColumn("low_quality", 1 - F.col("quality"))
    seen = F.col("doc_id") % 5 != 0
    model = toxicity_chain.fit(tables[0], labels.where(seen), ["low_quality", "toxic"], max_rows=500)
    told = toxicity_chain.flag_toxic(tables[0].select("doc_id", "text"), model).join(labels.where(~seen).withColumnRenamed("toxic", "truth"), "doc_id")
    counts = {(r["truth"], r["toxic"]): r["count"] for r in told.groupBy("truth", "toxic").count().collect()}
    assert counts[1, True] > 0.9 * (counts[1, True] + counts.get((1, False), 0))
    assert counts.get((0, True), 0) < 0.05 * counts[0, False]


def test_threshold_against_all_cuts():
    pick = random.Random(5)
    for _ in range(200):
        n = pick.randint(1, 12)
        p = np.array([pick.choice((0.1, 0.2, 0.4, 0.5, 0.9)) for _ in range(n)])
        y, w = np.array([float(pick.random() < 0.4) for _ in range(n)]), np.array([float(pick.randint(1, 9)) for _ in range(n)])
        got = toxicity_chain.best_threshold(p, y, w)

        def f1(t):
            told = p >= t
            return 2 * (w * y * told).sum() / ((w * told).sum() + (w * y).sum())

        assert (got == 1.1) if not y.any() else np.isclose(f1(got), max(f1(t) for t in p))


def test_threshold_is_that_of_the_table(spark):
    """A sample of 30 rows per value out of 30 toxic and 1,500 clean texts: each sampled clean text stands for many."""
    pick = random.Random(6)
    rows = [(i, " ".join(pick.choices(["bad", "awful", "word", "tree", "hill"], [6, 6, 1, 1, 1] if i < 30 else [1, 1, 6, 6, 6], k=20)), int(i < 30)) for i in range(1530)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    sample = toxicity_chain.labelled_sample(table.drop("toxic"), table.drop("text"), ["toxic"], max_rows=30)
    assert sorted(sample.groupby("toxic")["weight"].sum().round(6).tolist()) == [30, 1500]
    assert sample.groupby("toxic")["weight"].first().round(6).tolist() == [50, 1]


def test_chain_against_plain_sums(spark):
    rows = pd.DataFrame({"text": ["bad awful word", "tree hill word", "bad bad", "hill tree", "awful", "", "word tree"] * 6, "low": [1, 0, 1, 0, 1, 0, 0] * 6})
    rows = rows.assign(toxic=rows["low"], fold=range(len(rows)), weight=1.0)
    model = toxicity_chain.fit_chain(rows, ["low", "toxic"], size=1 << 10)
    texts = ["bad word", "tree", "", None, "Awful awful, unknown words"]
    got = toxicity_chain.flag_toxic(docs(spark, texts), model).orderBy("doc_id").collect()
    for text, row in zip(texts, got):
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        counts = Counter(zlib.crc32(part.encode()) % 1024 for w in words for part in ["=" + w, *(w[:k] for k in (5, 6, 7) if len(w) >= k)])
        earlier = []
        for name, linear, limit in zip(model.categories, model.models, model.thresholds):
            score = linear.intercept + sum(linear.words[k] * math.log1p(n * 200 / max(len(words), 50)) for k, n in counts.items())
            score += sum(a * b for a, b in zip(linear.earlier, earlier))
            earlier.append(1 / (1 + math.exp(-score)))
            assert row[f"p_{name}"] == pytest.approx(earlier[-1], abs=1e-9) and row[name] == (row[f"p_{name}"] >= limit)
    assert [r["toxic"] for r in got][:2] == [True, False]


def test_toxicity_edges(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity_chain.fit(docs(spark, ["a"]), none, ["toxic"])
    out = toxicity_chain.flag_toxic(docs(spark, ["a", None, "", "1 2"]), model).collect()
    assert len(out) == 4 and not any(r["toxic"] for r in out)
    one = spark.createDataFrame([(0, 1), (None, 1), (9, None)], "doc_id long, toxic int")
    assert toxicity_chain.flag_toxic(docs(spark, ["a", None]), toxicity_chain.fit(docs(spark, ["a"]), one, ["toxic"])).count() == 2


# ---- language -----------------------------------------------------------------------------------


def test_language_code_lengths_against_plain():
    import math
    from collections import Counter

    import numpy as np
    import pandas as pd

    train = {"x": ["Abab cab!", "bab"], "y": ["zzé za", "éz"]}
    order, rows = 2, []
    for lang, texts in train.items():
        for t in texts:
            data = language_ppm.plain_bytes(t, order)
            for n in range(1, order + 2):
                for i in range(order, len(data)):
                    rows.append((lang, n, int.from_bytes(data[i + 1 - n : i + 1], "big"), 1))
    counts = pd.DataFrame(rows, columns=["lang", "length", "code", "n"]).groupby(["lang", "length", "code"], as_index=False).sum()
    model = language_ppm.PPM.from_counts(counts, order)

    def bits(lang, text):
        seen, data, total = Counter(), language_ppm.plain_bytes(text, order), 0.0
        for t in train[lang]:
            own = language_ppm.plain_bytes(t, order)
            for n in range(1, order + 2):
                seen.update(own[i + 1 - n : i + 1] for i in range(order, len(own)))
        for i in range(order, len(data)):
            for k in range(order, -1, -1):
                after = {g: c for g, c in seen.items() if len(g) == k + 1 and g[:k] == data[i - k : i]}
                n, q = sum(after.values()), len(after)
                if data[i - k : i + 1] in after:
                    total -= math.log2(after[data[i - k : i + 1]] / (n + q))
                    break
                total -= math.log2(q / (n + q)) if after else 0
            else:
                total += 8
        return total

    texts = ["abab", "zé za", "qq", "cab zz é", "b" * 50]
    got = model.code_lengths(texts, model.index())
    assert np.allclose(got, [[bits(lang, t) for lang in ("x", "y")] for t in texts])


def test_language_held_out_and_edges(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_ppm.fit(table.where(~language_ppm.held_out()), max_docs=60)
    told = language_ppm.identify_documents(table.where(language_ppm.held_out()), model)
    right = told.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98
    odd = language_ppm.identify_documents(docs(spark, [None, "", "12 34!", "中"]), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] == "und" for r in odd] == [True, True, True, False] and odd[0]["score"] == 0
    nothing = language_ppm.fit(table.where("false"))
    assert language_ppm.identify_documents(docs(spark, ["a"]), nothing).first()["lang_pred"] == "und"


def test_texts_without_a_letter_have_no_language():
    assert [language_ppm.has_letter(t) for t in ("12 \u00bd \u00b2", "\u2460", "\u2167", "", "a", "\u00e9", "\u4e2d")] == [False] * 4 + [True] * 3
