"""One page -> flat element list. The only per-row Python in the package.

``parse`` turns a page into events in document order (element opens, closes, text, other
markup) and one entry per element. Tables of elements and the one-pass cleaner are both read
off that list, so every step is a loop over it, whatever the nesting depth.

Output rules, which content hashes depend on: attributes in source order in double quotes
(single quotes if the value holds a double quote), ``& < >`` escaped in text and values, void
elements as ``<br/>``, whitespace-only text outside ``pre`` and ``textarea`` reduced to one
newline or space, list-valued attributes joined by single spaces.
"""

from html import unescape
from html.entities import html5
from html.parser import HTMLParser
from typing import NamedTuple

from ..constants import (
    CONTENT_SELECTORS,
    MIN_DIV_TEXT,
    MIN_SELECTED_TEXT,
    MIN_WRAPPER_TEXT,
    NAVIGATION_SELECTORS,
    STRIPPED_TAGS,
    UNWRAPPED_TAGS,
    VOID_TAGS,
)

OPEN, CLOSE, TEXT, OTHER = range(4)
_VOID = frozenset(VOID_TAGS)
_KEEP_SPACE = frozenset(["pre", "textarea"])
_LIST_ATTRS = {"a": ("rel", "rev"), "td": ("headers",), "th": ("headers",), "form": ("accept-charset",),
               "object": ("archive",), "area": ("rel",), "icon": ("sizes",), "iframe": ("sandbox",),
               "output": ("for",)}
_LIST_ATTRS_ANY = ("class", "accesskey", "dropzone")


def escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


class Element:
    __slots__ = ("pre", "last", "parent", "depth", "tag", "attrs", "classes", "elem_id", "open_at", "close_at",
                 "own_len", "first_text", "n_children")

    def __init__(self, pre, parent, tag, attrs, open_at):
        self.pre, self.last, self.tag, self.attrs, self.open_at = pre, pre, tag, attrs, open_at
        self.parent = parent.pre if parent else None
        self.depth = parent.depth + 1 if parent else 0
        self.classes = attrs.get("class", "").split()
        self.elem_id = attrs.get("id")
        self.close_at = open_at
        self.own_len = self.n_children = 0
        self.first_text = None

    def open_html(self) -> str:
        listed = _LIST_ATTRS_ANY + _LIST_ATTRS.get(self.tag, ())
        out = [self.tag]
        for name, value in self.attrs.items():
            value = escape(" ".join(value.split()) if name in listed else value)
            quote = '"'
            if quote in value:
                if "'" in value:
                    value = value.replace('"', "&quot;")
                else:
                    quote = "'"
            out.append(f"{name}={quote}{value}{quote}")
        # A void element that was given content after all is written like any other.
        return "<" + " ".join(out) + ("/>" if self.is_void() else ">")

    def close_html(self) -> str:
        return "" if self.is_void() else f"</{self.tag}>"

    def is_void(self) -> bool:
        return self.tag in _VOID and self.close_at == self.open_at + 1


class Page(HTMLParser):
    """Events and elements of one document; element 0 stands for the document itself."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.events, self.elements, self.stack = [], [], []
        self.pending, self.n_open, self.closed_voids = [], {}, {}
        self._push("", {})

    def _push(self, tag, attrs):
        parent = self.stack[-1] if self.stack else None
        element = Element(len(self.elements), parent, tag, attrs, len(self.events))
        if parent:
            parent.n_children += 1
        self.elements.append(element)
        self.stack.append(element)
        self.n_open[tag] = self.n_open.get(tag, 0) + 1
        self.events.append((OPEN, element.pre, None))

    def _pop(self):
        element = self.stack.pop()
        self.n_open[element.tag] -= 1
        element.last = len(self.elements) - 1
        element.close_at = len(self.events)
        self.events.append((CLOSE, element.pre, None))
        return element

    def _flush(self):
        if not self.pending:
            return
        text = "".join(self.pending)
        self.pending.clear()
        if not text.strip(" \n\t\f\r") and not any(self.n_open.get(t) for t in _KEEP_SPACE):
            text = "\n" if "\n" in text else " "
        owner = self.stack[-1]
        if owner.first_text is None:
            owner.first_text = text
        owner.own_len += len(text.strip())
        self.events.append((TEXT, owner.pre, text))

    def _other(self, markup):
        self._flush()
        self.events.append((OTHER, self.stack[-1].pre, markup))

    def handle_starttag(self, tag, attrs):
        self._flush()
        self._push(tag, {name: value or "" for name, value in attrs})
        if tag in _VOID:
            self._pop()
            self.closed_voids[tag] = self.closed_voids.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self._flush()
        self._push(tag, {name: value or "" for name, value in attrs})
        self._pop()

    def handle_endtag(self, tag):
        self._flush()
        if self.closed_voids.get(tag):
            self.closed_voids[tag] -= 1
        elif self.n_open.get(tag):
            while self._pop().tag != tag:
                pass

    def handle_data(self, data):
        self.pending.append(data)

    def handle_entityref(self, name):
        self.pending.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        self.pending.append(unescape(f"&#{name};"))

    def handle_comment(self, data):
        self._other(f"<!--{data}-->")

    def handle_decl(self, decl):
        self._other(f"<!DOCTYPE {decl[len('DOCTYPE '):]}>\n")

    def handle_pi(self, data):
        self._other(f"<?{data}>")

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self._other(f"<![CDATA[{data[len('CDATA['):]}]]>")
        else:
            self._other(f"<?{data}?>")

    def finish(self):
        self.close()
        self._flush()
        while self.stack:
            self._pop()
        return self


def decode(content) -> str:
    """Bytes as UTF-8, or as windows-1252 if they are not."""
    if isinstance(content, str):
        return content
    try:
        return bytes(content).decode("utf-8-sig")
    except UnicodeDecodeError:
        return bytes(content).decode("windows-1252", "replace")


def parse(content) -> Page:
    page = Page()
    page.feed(decode(content))
    return page.finish()


class Selectors:
    """A list of ``tag``, ``tag.class``, ``.class``, ``#id`` and ``tag[attr]`` selectors, kept in order."""

    def __init__(self, names):
        self.by_tag, self.by_class, self.by_id = {}, {}, {}
        for rank, name in enumerate(names):
            tag, _, cls = name.partition(".")
            if name.startswith("#"):
                self.by_id.setdefault(name[1:], rank)
            elif cls:
                self.by_class.setdefault(cls, []).append((tag, rank))
            else:
                self.by_tag.setdefault(name, rank)

    def ranks(self, e: Element) -> list[int]:
        """Positions of the selectors that match, in order."""
        found = []
        if e.tag in self.by_tag:
            found.append(self.by_tag[e.tag])
        if e.elem_id is not None and e.elem_id in self.by_id:
            found.append(self.by_id[e.elem_id])
        for cls in set(e.classes) if self.by_class else ():
            found += [rank for tag, rank in self.by_class.get(cls, ()) if tag in ("", e.tag)]
        return sorted(found)


NOISE = Selectors(STRIPPED_TAGS + NAVIGATION_SELECTORS)
CONTENT = Selectors(CONTENT_SELECTORS)


class Cleaned(NamedTuple):
    html: str
    tier: str
    tag: str | None
    text_len: int


def clean(content) -> Cleaned:
    """Main content of a page as markup, in one pass over its events."""
    page = parse(content)
    elements = page.elements
    alive = [True] * len(elements)
    for e in elements[1:]:
        alive[e.pre] = alive[e.parent] and not NOISE.ranks(e)
    text_len = [e.own_len if alive[e.pre] else 0 for e in elements]
    leaf = [True] * len(elements)
    for e in reversed(elements[1:]):
        if alive[e.pre]:
            text_len[e.parent] += text_len[e.pre]
            leaf[e.parent] = False
    tier, main = _main_element(elements, alive, text_len)
    if main is None:
        return Cleaned(_write(page, elements[0], alive, set()), tier, None, text_len[0])
    unwrapped = set()
    for e in elements[main.pre + 1 : main.last + 1]:
        if alive[e.pre] and leaf[e.pre]:
            if not text_len[e.pre]:
                alive[e.pre] = False
            elif e.tag in UNWRAPPED_TAGS and text_len[e.pre] < MIN_WRAPPER_TEXT:
                unwrapped.add(e.pre)
    return Cleaned(_write(page, main, alive, unwrapped), tier, main.tag, text_len[main.pre])


def _main_element(elements, alive, text_len):
    first, longest, body = {}, None, None
    for e in elements[1:]:
        if not alive[e.pre]:
            continue
        for rank in CONTENT.ranks(e):
            first.setdefault(rank, e)
        if e.tag == "div" and text_len[e.pre] > max(MIN_DIV_TEXT, text_len[longest.pre] if longest else 0):
            longest = e
        if e.tag == "body" and body is None:
            body = e
    for rank in sorted(first):
        if text_len[first[rank].pre] > MIN_SELECTED_TEXT:
            return "selector", first[rank]
    if longest is not None:
        return "div", longest
    return ("body", body) if body is not None else ("none", None)


def _write(page, root, alive, unwrapped) -> str:
    out, at = [], root.open_at
    while at <= root.close_at:
        kind, pre, payload = page.events[at]
        e = page.elements[pre]
        if kind == OPEN and not alive[pre]:
            at = e.close_at
        elif kind in (OPEN, CLOSE):
            if pre and pre not in unwrapped:
                out.append(e.open_html() if kind == OPEN else e.close_html())
        else:
            out.append(escape(payload) if kind == TEXT else payload)
        at += 1
    return "".join(out)
