"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at its block-level tags. Each block has its number of words and its link density (share of
words inside links), those of the block before and after, what kind of element holds it, and whether the page
names its main part at all. A decision tree, grown on a small labelled table, decides which blocks are main text.

The labelled table comes from a rule (``labelled_blocks``): pages of several layouts whose words say
whether they belong to the article. Half of the pages name their parts by elements or classes, the
rest do not, so the tree knows both what names say and what numbers say. Names count on containers only:
the anchor id of a heading and the class of a paragraph inside the main part say nothing. Where nothing is
named, a heading such as "3 comments" opens a side part, up to the next heading of its level.

Edge cases: null or empty html, and pages without main text, give an empty text; elements left open
and stray end tags are tolerated; references that are no references stay as they are; raw text of
scripts, styles, templates and the like never counts, formulas and ``xmp`` do; very long pages are read whole, in
time that grows with their length however tags are nested or left open; reader comments that neither a name nor
a heading marks are taken for text; repeated rows get equal results; other columns are kept, whatever their
names; an empty table gives no rows.
"""

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .scratch import free_name

# Fixed values of the HTML standard: elements that start and end a block, and those without an end tag.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section"
    " summary table tbody td tfoot th thead tr ul xmp".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("annotation annotation-xml audio canvas datalist iframe noembed noframes noscript object script select style svg template textarea title video".split())
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tr": {"td", "th", "tr"}, "option": {"option"},
}
_ASIDE_TAGS = frozenset("nav header footer aside form menu dialog button fieldset search".split())
_MAIN_TAGS = frozenset("article main".split())
# Words in class, id and role values.
_ASIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|alert|banner\w*|breadcrumbs?|byline|comments?|commentlist|consent|contentinfo|cookies?|copyright|dialog|disclaimer|disqus|discussion|feedback"
    r"|foot|footer|form|gdpr|header|hidden|legal|links|login|masthead|menu\w*|modal|nav|navbar|navigation|newsletter|notices?|notification"
    r"|overlay|pager|pagination|popup|promo\w*|reader|reactions?|recommended|related|replies|reply|respond|responses?|search|share|sharing|sidebar|side|signup|skip|social|sponsor\w*"
    r"|subscribe|subscription|tags|teaser|toolbar|topbar|trending|warning|widget\w*)(?=$|[\s_-])",
    re.I,
)
_MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|entry|main|maincontent|post|story|text)(?=$|[\s_-])", re.I)
# Of these, words that also name parts of an article: inside the main part, and on paragraphs, they say nothing.
_TOPICS = re.compile(r"(?:^|(?<=[\s_-]))(?:alert|discussion|feedback|foot|form|legal|links|reader|search|side|warning)(?=$|[\s_-])", re.I)
# Elements whose names count, and those of which only a class does, and only outside the main part.
_CONTAINERS = frozenset("address article aside center details div dl footer form header main menu nav ol section table tbody td tr ul".split())
_BY_CLASS = frozenset("dd dt figure li p".split())
# Headings that open a side part, and blocks that are notices, where nothing is named.
_SIDE_HEADING = re.compile(
    r"(?:\d+ )?(?:reader |user )?comments?(?: ?\(\d+\))?:?|leave a (?:comment|reply)|post a comment|(?:related|recommended|popular|more) (?:articles|posts|stories)|you (?:may|might) also like",
    re.I,
)
_NOTICE = re.compile(r"^(?:©|\(c\)|copyright\b)|\b(?:we|this (?:web ?)?site) uses? cookies\b|all rights reserved\.?$", re.I)
# Tokens that say how a page is laid out, or name the head of an article: they make no side part.
_NO_ASIDE = re.compile(r"(?:^|(?<=\s))(?:(?:has|with|no|without)[-_]\S+|(?:entry|post|article|story)[-_]header)(?=$|\s)", re.I)
# An article element is a side part only by a token that starts so; other names on it are topics.
_SIDE_ARTICLE = re.compile(r"(?:^|\s)(?:div-)?(?:ads?|advert\w*|comments?|promo\w*|recommended|related|reply|replies|sponsor\w*|teaser\w*|widget\w*)(?=$|[\s_-])", re.I)
# Side parts that hold articles of their own.
_SIDE_LISTS = re.compile(
    r"(?:^|[\s_-])(?:comments?|commentlist|discussion|disqus|footer|promo\w*|reactions?|recommended|related|replies|responses?|sidebar(?![_-](?:left|right))|sponsor\w*|teaser|trending|widget\w*)(?=$|[\s_-])",
    re.I,
)
_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/<>]*))")
_UNQUOTED = re.compile(r"[^<>\"']*")
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HREF = re.compile(r"(?:^|\s)href\s*=", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s=]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*(?:\"[^\"]*|'[^']*)display\s*:\s*none)", re.I)

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "in_main", "in_aside", "heading", "notice", "place")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    in_main: bool
    in_aside: bool
    heading: bool
    notice: bool


class _Tags:
    """Finds where tags end: at the first > outside quotes, or, if quotes do not close, at the first > at all."""

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in "\"'>"}  # nothing is searched for beyond its last place

    def end(self, at: int) -> int:
        """The place of the > of a tag whose name ends at ``at``, or -1."""
        if at > self.last[">"]:
            return -1
        place = at
        while True:
            place = _UNQUOTED.match(self.page, place).end()
            mark = self.page[place : place + 1]
            if mark == ">":
                return place
            if mark in ("", "<") or place >= self.last[mark]:
                return self.page.find(">", at)
            place = self.page.find(mark, place + 1) + 1


def _kind(tag: str, attributes: str, in_main: bool) -> str:
    """``main``, ``aside`` or nothing for an element that opens; ``named+aside`` or ``listed+aside`` if only a name says so."""
    given = [(k.lower(), a or b or c) for k, a, b, c in _NAMES.findall(attributes)] if attributes else []
    if attributes and _HIDDEN.search(attributes):
        return "aside"
    names = " ".join(v for _, v in given)
    if tag == "main" or (tag == "article" and not _SIDE_ARTICLE.search(names)):
        return "main"
    if tag in _ASIDE_TAGS and not (tag == "header" and in_main):
        return "aside"
    if tag in _CONTAINERS:
        # Inside the main part an id is mostly the anchor of a section; it counts if it is a side word and no more.
        told = " ".join(v for k, v in given if not in_main or k != "id" or _ASIDE_NAMES.fullmatch(v))
    else:
        told = " ".join(v for k, v in given if k != "id") if tag in _BY_CLASS and not in_main else ""
    told = _NO_ASIDE.sub("", _TOPICS.sub("", told) if in_main or tag in _BY_CLASS else told)
    if told and _ASIDE_NAMES.search(told):
        return "listed+aside" if _SIDE_LISTS.search(told) else "named+aside"
    return "main" if names and tag in ("div", "section", "td") and _MAIN_NAMES.search(names) else ""


def page_blocks(page: str | None) -> list[Block]:
    page = page or ""
    blocks: list[Block] = []
    open_tags: list[tuple[str, str]] = []  # element and the kind that holds inside it
    n_open: Counter[str] = Counter()
    pieces: list[str] = []
    tags = _Tags(page)
    linked, in_link, level, side_level, at = 0, False, 0, 0, 0

    def kind():
        return open_tags[-1][1] if open_tags else ""

    def close():
        n_open[open_tags.pop()[0]] -= 1

    def flush():
        nonlocal linked, side_level
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                n, own = len(text.split(" ")), kind()
                if level and not own:
                    side_level = level if _SIDE_HEADING.fullmatch(text) else 0 if level <= side_level else side_level
                aside = own.endswith("aside") or (not own and side_level > 0)
                notice = not own and bool(_NOTICE.search(text, 0, 80) or _NOTICE.search(text, max(0, len(text) - 40)))
                blocks.append(Block(text, n, min(linked, n), own.startswith("main"), aside, level > 0, notice))
        linked = 0

    def take(raw, references=True):
        nonlocal linked
        if raw:
            text = html.unescape(raw) if references and "&" in raw else raw
            pieces.append(text)
            if in_link:
                linked += len(text.split())

    while m := _OPEN.search(page, at):
        take(page[at : m.start()])
        if m[1]:
            at = page.find("-->", m.end()) + 3
            at = at if at > 2 else len(page)
            continue
        if m[2]:
            at = page.find(">", m.end()) + 1 if m.end() <= tags.last[">"] else len(page)
            continue
        stop = tags.end(m.end())
        if stop < 0:  # no tag
            take(page[m.start() : m.end()])
            at = m.end()
            continue
        end, tag, attributes = m[3], m[4].lower(), page[m.end() : stop]
        at = stop + 1
        if tag in RAW_TAGS or tag == "xmp":
            if tag == "xmp":
                flush()
            if not end and not attributes.endswith("/"):
                over = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
                if tag == "xmp":
                    take(page[at : over.start() if over else len(page)], references=False)
                    flush()
                at = page.find(">", over.start()) + 1 if over else len(page)
                at = at or len(page)
            pieces.append(" ")
        elif tag == "a":
            in_link = not end and bool(_HREF.search(attributes))
        elif tag == "br":
            pieces.append(" ")
        elif tag in BLOCK_TAGS:
            flush()
            in_link = False
            if end:
                if n_open[tag]:
                    while open_tags[-1][0] != tag:
                        close()
                    close()
            elif tag not in VOID_TAGS:
                if open_tags and open_tags[-1][0] == "p":
                    close()
                while open_tags and open_tags[-1][0] in _CLOSES.get(tag, ()):
                    close()
                above = kind()
                own = _kind(tag, attributes, above == "main")
                # What stands inside a side part stays a side part, whatever its name; but an article or
                # main element ends one that comes from a name alone.
                if above.endswith("aside"):
                    ends = own == "main" and ("named" in above and tag in _MAIN_TAGS or "listed" in above and tag == "main")
                    own = own if ends else above
                elif own.endswith("aside") and above == "main":
                    own = f"main+{own}"
                open_tags.append((tag, own or above))
                n_open[tag] += 1
            top = open_tags[-1][0] if open_tags else ""
            level = int(top[1]) if top in ("h1", "h2", "h3", "h4", "h5", "h6") else 0
    take(page[at:])
    flush()
    return blocks


def block_features(blocks: list[Block]) -> np.ndarray:
    n = len(blocks)
    words = np.array([0, *(b.words for b in blocks), 0], float)
    links = np.array([0, *(b.linked / b.words for b in blocks), 0], float)
    sides = [words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:]]
    flags = [np.array([getattr(b, f) for b in blocks], float).reshape(n) for f in ("in_main", "in_aside", "heading", "notice")]
    # 0: in a side part, 1: elsewhere on a page that names its main part, 2: on a page that does not, 3: in the main part
    elsewhere = 1 if any(b.in_main and not b.in_aside for b in blocks) else 2
    place = [0 if b.in_aside else 3 if b.in_main else elsewhere for b in blocks]
    return np.column_stack([*sides, *flags, np.array(place, float)])


def labelled_pages(n_pages=480, seed=7) -> list[str]:
    """Pages by rule. Words of the article start with c, all others do not."""
    pick = random.Random(seed)

    def words(letter, low, high):
        return " ".join(f"{letter}{pick.randint(0, 999)}" for _ in range(pick.randint(low, high)))

    def link(text):
        return f'<a href="/x">{text}</a>'

    def part(style, tag, name, inner):
        if style == "tags":
            return f"<{tag}>{inner}</{tag}>"
        if style == "classes":
            return f'<div class="{name}">{inner}</div>'
        return f"<div>{inner}</div>"

    def article():
        out = [f"<h1>{words('c', 1, 14)}</h1>"] if pick.random() < 0.8 else []
        for _ in range(pick.randint(1, 9)):
            odd = pick.random()
            if odd < 0.15:
                out.append("<ul>" + "".join(f"<li>{words('c', 1, 9)}</li>" for _ in range(pick.randint(1, 5))) + "</ul>")
            elif odd < 0.2:
                out.append(f"<p>{words('c', 1, 5)} {link(words('c', 1, 8))}</p><p>{words('c', 1, 60)}</p>")
            elif odd < 0.4:
                out.append("<{0}>{1}</{0}>".format(pick.choice(("p", "h2", "p")), words("c", 1, 9)))
            else:
                out.append(f"<p>{words('c', 10, 150)} {link(words('c', 1, 4)) if pick.random() < 0.3 else ''}</p>")
        return out

    pages = []
    for i in range(n_pages):
        style = ("tags", "bare", "classes", "bare")[i % 4]
        named = style != "bare"
        if style == "bare" and pick.random() < 0.25:  # an article and nothing else
            pages.append("<html><body>" + (words("c", 1, 40) if pick.random() < 0.3 else "".join(article())) + "</body></html>")
            continue
        body = []
        if pick.random() < 0.5:
            body.append(part(style, "header", "site-header", "<{0}>{1}</{0}>".format(pick.choice(("h1", "p")), words("b", 1, 12))))
        between = pick.choice(("li", "li", "li", "|"))
        entries = [link(words("b", 1, 3)) for _ in range(pick.randint(2, 9))]
        menu = " | ".join(entries) if between == "|" else "<ul>" + "".join(f"<li>{e}</li>" for e in entries) + "</ul>"
        body.append(part(style, "nav", "menu", menu))
        if pick.random() < 0.6:
            body.append(f'<div class="ad">{words("b", 3, 30)}</div>' if named else f"<div>{link(words('b', 2, 12))}</div>")
        if pick.random() < 0.3:
            body.append(part("classes", "div", "cookie-notice", words("b", 5, 25)) if named else f"<div>We use cookies {words('b', 3, 20)}</div>")
        inner = article()
        if named and i % 3 and inner[0].startswith("<h1>") and pick.random() < 0.3:  # the title stands before the part that is named
            body.append(inner.pop(0))
        if named and pick.random() < 0.2:
            inner.append(f"<p>{link(words('c', 1, 8))}</p>")
        if named and pick.random() < 0.3:
            inner.insert(pick.randint(0, len(inner)), f'<aside class="related"><h3>{words("b", 1, 6)}</h3><p>{words("b", 4, 220)}</p></aside>')
        body.append(part(style, "article", "post-content", "".join(inner)))
        if pick.random() < 0.4:
            body.append(part(style, "aside", "sidebar", "".join(f"<p>{link(words('b', 2, 8))}</p>" for _ in range(3))))
            if named:
                body.append(part(style, "aside", "sidebar", f"<h3>{words('b', 1, 6)}</h3><p>{words('b', 5, 220)}</p>"))
        if pick.random() < 0.3:
            body.append(f"<form><p>{words('b', 1, 12)}</p></form>")
        if pick.random() < 0.5:
            said = "".join(f"<div><p>{words('b', 2, 220)}</p></div>" for _ in range(pick.randint(1, 5)))
            heading = words("b", 1, 4) if named else f"{pick.randint(1, 9)} comments"
            body.append(part("classes" if named else style, "section", "comments", f"<h2>{heading}</h2>{said}"))
        if named and pick.random() < 0.3:  # outside the part that is named, without a name
            body.append("".join(f"<div><p>{words('b', 1, 80)}</p></div>" for _ in range(pick.randint(1, 3))))
        body.append(part(style, "footer", "footer", f"{'' if named else '© '}{words('b', 3, 14)}"))
        if named and i % 3 == 0:
            wrapper = pick.choice(("page has-sidebar", "with-sidebar", "sidebar-right" if style == "tags" else "page"))
            body = [f'<div class="{wrapper}">', *body, "</div>"]
        pages.append("<html><head><title>t</title></head><body>" + "".join(body) + "</body></html>")
    return pages


def labelled_blocks(n_pages=480, seed=7) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels (1: main text) of the blocks of the pages made by rule."""
    pages = [page_blocks(p) for p in labelled_pages(n_pages, seed)]
    return np.concatenate([block_features(p) for p in pages]), np.array([b.text[0] == "c" for p in pages for b in p], float)


@dataclass
class Node:
    share: float
    feature: int = -1
    limit: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None


def grow(x: np.ndarray, y: np.ndarray, depth=8, least=4) -> Node:
    """A binary tree by Gini impurity; ties go to the first feature and the lowest limit."""
    node = Node(float(y.mean()))
    if depth == 0 or node.share in (0.0, 1.0) or len(y) < 2 * least:
        return node
    best = len(y) * node.share * (1 - node.share) - 1e-9
    for j in range(x.shape[1]):
        order = np.argsort(x[:, j], kind="stable")
        v, ones = x[order, j], np.cumsum(y[order])
        n = np.arange(1, len(y))
        left, right = ones[:-1], ones[-1] - ones[:-1]
        impurity = left * (1 - left / n) + right * (1 - right / (len(y) - n))
        impurity[(v[1:] == v[:-1]) | (n < least) | (len(y) - n < least)] = np.inf
        k = int(np.argmin(impurity))
        if impurity[k] < best:
            best, node.feature, node.limit = float(impurity[k]), j, float((v[k] + v[k + 1]) / 2)
    if node.feature >= 0:
        low = x[:, node.feature] <= node.limit
        node.low, node.high = grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)
    return node


def is_main(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.share >= 0.5)
    low = x[:, node.feature] <= node.limit
    out = np.empty(len(x), bool)
    out[low], out[~low] = is_main(node.low, x[low]), is_main(node.high, x[~low])
    return out


def main_text(page: str | None, tree: Node) -> tuple[str, int, int]:
    """Main text, number of blocks, number of blocks kept."""
    blocks = page_blocks(page)
    if not blocks:
        return "", 0, 0
    keep = is_main(tree, block_features(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k), len(blocks), int(keep.sum())


def extract_pages(pages: DataFrame, page_html="html", text="text") -> DataFrame:
    """``pages`` without the html, with ``text``, ``n_chars``, ``n_blocks`` and ``n_kept``."""
    tree = grow(*labelled_blocks())

    @F.pandas_udf("text string, n_blocks long, n_kept long")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([main_text(p, tree) for p in batch], columns=["text", "n_blocks", "n_kept"])

    main = free_name(pages, "main")
    told = pages.withColumn(main, extract(F.col(page_html)))
    kept = [c for c in pages.columns if c not in (page_html, text, "n_chars", "n_blocks", "n_kept")]
    found = F.col(f"{main}.text")
    return told.select(*kept, found.alias(text), F.char_length(found).cast("long").alias("n_chars"), f"{main}.n_blocks", f"{main}.n_kept")
