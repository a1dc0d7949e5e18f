"""Main text of web pages by tree scoring.

Blocks of text pass points for their length and commas to the elements around them, the nearer the more;
an element's points are discounted by its share of link text and count half as much again where its tag says
that it is an article. The element with most points is the main container, or the article element around it.
Of the container only known furniture is left out. Text beside it of few links is kept with it, and so is
that beside its ancestors as long as most of what lies there is of that kind; the score decides only against
what is mostly links or named like furniture.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

# Roles of HTML elements.
_RAW = {"script", "style", "title", "textarea", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_DROPPED = {"nav", "footer", "aside", "form", "script", "style", "title", "noscript", "template", "iframe", "textarea", "select", "button", "input", "svg", "annotation", "annotation-xml", "canvas", "object", "video", "audio", "dialog", "menu", "map", "datalist", "fieldset"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "nobr"}
_INLINE |= {"math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "mspace", "mstyle", "mpadded", "mphantom", "merror", "menclose", "mfenced", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts", "mprescripts", "mtable", "mtr", "mtd", "maction"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu", "menubar", "form", "toolbar"}
#: Words of class and id names that mark what does not belong to an article.
_UNLIKELY = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adbox", "adslot", "banner", "sponsor", "sponsored", "promo", "promotion",
    "sidebar", "sidenav", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "header",
    "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login",
    "social", "share", "sharing", "related", "recommended", "recommendations", "comment", "comments", "commentlist", "disqus", "respond", "replies",
    "widget", "widgets", "toolbar", "pagination", "pager", "copyright", "hidden", "form",
}
#: With these after them, and numbers, such words are whole names of furniture, as are comments of those in _WHOSE; the words in _BARE are none by themselves.
_PARTS = ("area", "articles", "banner", "bar", "block", "body", "box", "button", "buttons", "container", "content", "footer", "form", "icons", "inner", "item", "links", "list", "menu", "modal", "nav", "notice", "popup", "posts", "section", "slot", "thread", "unit", "widget", "wrap", "wrapper")
_WHOSE = ("reader", "readers", "user", "users", "visitor", "visitors", "guest")
_BARE = {"header", "form", "notice", "overlay", "copyright", "subscription", "promotion"}
_KNOWN = re.compile(rf"(?:(?:{'|'.join(sorted(_UNLIKELY - _BARE))})(?:-(?:{'|'.join(_PARTS)}))*|(?:{'|'.join(_WHOSE)})-(?:comment|comments|replies)(?:-(?:{'|'.join(_PARTS)}))*|(?:notice|subscription|form)(?:-(?:{'|'.join(_PARTS)}))+)(?:-?\d+)?")
_NEVER = {"html", "body", "main", "article", "h1"}
_ARTICLE = ("article", "main")


class Page:
    """Elements in page order (parents before children), and the runs of text inside them.

    Every open tag knows its places on the stack, so a tag is opened or closed without a walk over it.
    """

    def __init__(self, html: str):
        self.tag, self.parent = ["#"], [-1]
        self.out, self.doubtful = [False], [False]  # furniture by tag or whole name; by a word in its name
        self.inside, self.holder = [False], [0]  # within an article; the element of the block that text belongs to
        self.runs: list[tuple[int, int, str]] = []  # element, block number, text
        self.block = 0
        self.stack, self.solid, self.places = [0], [0], {}  # solid: for each place that of the nearest block at or below it
        self._read(html)

    def _read(self, html: str) -> None:
        stack = self.stack
        pos, n, last, comment = 0, len(html), html.rfind(">"), html.rfind("<!--")
        while pos < n:
            m = _TOKEN.search(html, pos) if pos <= last or pos <= comment else None
            if m is None:
                self._text(stack[-1], html[pos:])
                return
            if m.start() > pos:
                self._text(stack[-1], html[pos : m.start()])
            pos = m.end()
            name = m[2] or m[5]
            if name is None:
                continue
            name, closing, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
            if closing:
                self._close(name)
                continue
            self._open(name, attributes)
            if name in _RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(html, pos)
                pos = end.end() if end else n
                self._cut(len(stack) - 1)

    def _text(self, element: int, text: str) -> None:
        self.runs.append((element, self.block, unescape(text)))

    def _cut(self, place: int) -> None:
        """Takes the stack down to ``place``."""
        while len(self.stack) > place:
            self.places[self.tag[self.stack.pop()]].pop()
            self.solid.pop()

    def _last(self, name: str) -> int:
        at = self.places.get(name)
        return at[-1] if at else 0

    def _open(self, name: str, attributes: str) -> None:
        stack = self.stack
        if name not in _INLINE:
            self.block += 1
            if name not in ("td", "th") and self.tag[stack[self.solid[-1]]] == "p":  # a block ends an open paragraph
                self._cut(self.solid[-1])
        if closes := _CLOSES.get(name):
            scope = max(self._last(x) for x in _SCOPE[name])
            first = [at[k] for x in closes if (at := self.places.get(x)) and (k := bisect_right(at, scope)) < len(at)]
            if first:
                self._cut(min(first))
        up, x = stack[-1], len(self.tag)
        self.tag.append(name)
        self.parent.append(up)
        self.inside.append(self.inside[up] or name in _ARTICLE)
        out, doubtful = self._unlikely(name, attributes)
        self.out.append(out)
        self.doubtful.append(doubtful and not self.inside[up])
        self.holder.append(self.holder[up] if name in _INLINE else x)
        if name == "br":
            self.runs.append((up, self.block, " "))
        elif name not in _VOID:
            self.solid.append(self.solid[-1] if name in _INLINE else len(stack))
            self.places.setdefault(name, []).append(len(stack))
            stack.append(x)

    def _close(self, name: str) -> None:
        if name not in _INLINE:
            self.block += 1
        place = self._last(name)
        if place and (name not in _INLINE or place > self.solid[-1]):  # an inline end tag does not close a block
            self._cut(place)

    def _unlikely(self, name: str, attributes: str) -> tuple[bool, bool]:
        """Whether an element is furniture for certain, and whether a word in its names makes it doubtful."""
        if name in _DROPPED:
            return True, True
        if not attributes or name in _NEVER:
            return False, name == "header"
        given = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", attributes))}
        if given.get("role") in _ROLES or "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", ""):
            return True, True
        names = [*given.get("class", "").replace("_", "-").split(), given.get("id", "").replace("_", "-")]
        words = {w for x in names for w in re.split(r"[^a-z]+", x)}
        return any(_KNOWN.fullmatch(x) for x in names), name == "header" or bool(words & _UNLIKELY)


def _squeeze(text: str) -> str:
    return " ".join(text.split())


def main_text(html: str | None) -> str:
    """The article's blocks, white space squeezed, one per line; empty for a null or empty page."""
    if not html:
        return ""
    page = Page(html)
    tag, parent, n = page.tag, page.parent, len(page.tag)
    holds = [False] * n  # an article inside
    for x in range(n - 1, 0, -1):
        holds[x] |= tag[x] in _ARTICLE
        holds[parent[x]] |= holds[x]
    out, doubtful, link = [False] * n, [False] * n, [False] * n
    for x in range(1, n):
        out[x] = out[parent[x]] or page.out[x] and not (holds[x] and tag[x] not in _DROPPED)
        doubtful[x] = doubtful[parent[x]] or page.doubtful[x] and not holds[x]
        link[x] = link[parent[x]] or tag[x] == "a"
    blocks: dict[int, list] = {}  # number -> [element of the block, pieces, link characters]
    for x, number, text in page.runs:
        if not out[x]:
            b = blocks.setdefault(number, [page.holder[x], [], 0])
            b[1].append(text)
            if link[x]:
                b[2] += len(_squeeze(text))
    found = [(y, s, links) for y, pieces, links in blocks.values() if (s := _squeeze("".join(pieces)))]
    if not found:
        return ""
    length, links, points = [0] * n, [0] * n, [0.0] * n
    for y, s, k in found:
        length[y] += len(s)
        links[y] += k
        if len(s) >= 25 and not doubtful[y]:
            worth = (1 + s.count(",") + s.count("，") + s.count("、") + min(len(s) / 100, 3)) * (1 - min(1, k / len(s)))
            up = y if tag[y] in ("div", "section", "article", "main", "body", "#", "td") else parent[y]
            for level in range(4):
                if up < 0:
                    break
                points[up] += worth / (1, 2, 6, 9)[level]
                up = parent[up]
    for x in range(n - 1, 0, -1):
        length[parent[x]] += length[x]
        links[parent[x]] += links[x]
    value = [p * (1 - links[x] / length[x]) * (1.5 if tag[x] in _ARTICLE else 1) if length[x] else 0.0 for x, p in enumerate(points)]
    best = max(range(n), key=lambda x: (value[x], -x))
    if value[best] <= 0:  # nothing scores: an article element if there is one with text
        best = max((x for x in range(n) if length[x] and not out[x]), key=lambda x: (_ARTICLE[::-1].index(tag[x]) if tag[x] in _ARTICLE else -1, -x))
    core, y = best, best
    while y > 0:  # the outermost article around it, or the main element
        if tag[y] == "article" or tag[y] == "main" and tag[core] != "article":
            core = y
        y = parent[y]
    keep, own = {core}, set()  # with all inside; the text right inside only
    if core > 0 and tag[core] not in _ARTICLE:
        least = max(10.0, 0.2 * value[best])
        kids: dict[int, list[int]] = {}
        for x in range(1, n):
            if not out[x] and not doubtful[x] and length[x]:
                kids.setdefault(parent[x], []).append(x)
        y = core
        while y > 0:
            up = parent[y]
            beside = [x for x in kids.get(up, ()) if x != y]
            plain = [x for x in beside if links[x] < 0.25 * length[x]]
            keep.update(plain)
            keep.update(x for x in beside if value[x] >= least)
            bare = length[up] - length[y] - sum(length[x] for x in beside)
            if bare and links[up] - links[y] - sum(links[x] for x in beside) < 0.25 * bare:
                own.add(up)
            if 2 * sum(length[x] for x in plain) < sum(length[x] for x in beside):
                break
            y = up
    whole = tag[core] in ("#", "html", "body")  # the page itself is no container with furniture outside
    kept, inner, menu = [False] * n, [False] * n, [False] * n
    for x in range(n):
        up = parent[x]
        kept[x] = x in keep or x > 0 and kept[up]
        inner[x] = x == core and not whole or x > 0 and inner[up]
        heavy = tag[x] in ("ul", "ol") and length[x] and links[x] >= 0.8 * length[x]
        menu[x] = not inner[x] and (bool(heavy) or doubtful[x] or x > 0 and menu[up])
    return "\n".join(s for y, s, _ in found if (kept[y] or y in own) and not menu[y])


def extract(df: DataFrame, html: str = "html") -> DataFrame:
    """Adds text (main text of the whole page) and n_chars (its code points) to every row.

    A null or empty page, or one without text, gives the empty text. Malformed mark-up is read as browsers
    read it: missing end tags are supplied, stray ones ignored; the work grows with the page's length alone.
    Menus, page headers and footers, sidebars, notices, adverts, forms, reader comments, scripts and styles
    are left out; inside the article only by tag, role or a whole known name, so an id or class that merely
    has such a word in it, and a list of links, stay. Repeated rows are treated each for itself; columns
    named text or n_chars are replaced; an empty table gives no rows. One map, no shuffle.
    """

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p) for p in pages], dtype="object")

    return df.withColumn("text", text(F.col(html))).withColumn("n_chars", F.char_length("text").cast("long"))
