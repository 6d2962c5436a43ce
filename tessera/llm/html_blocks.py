"""Blocks of a web page: (text, zone) in page order, from tolerant reading of its markup."""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape

MAIN, FREE, BOILER = "main", "free", "boiler"

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z) | <(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)> | <[!?][^>]*>""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
# Element names by their role in HTML.
_RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BOILER_TAGS = {"nav", "footer", "aside", "form", "button", "select", "template", "svg", "dialog", "menu", "object", "canvas", "head"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl",
          "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
          "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody",
          "td", "tfoot", "th", "thead", "tr", "ul", "button", "select", "option", "template", "title"}
_BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "form", "menu", "menubar"}
# Words in class or id that name a part of the page beside its article.
_BOILER_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
                 "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay",
                 "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "masthead", "footer",
                 "comments", "comment", "disqus", "respond", "newsletter", "subscribe", "signup", "share", "sharing",
                 "social", "related", "recommended", "widget", "widgets", "toolbar", "pagination", "pager", "skip"}
# Words that say of a part's name no more than its place or form.
_PLAIN_WORDS = {"site", "page", "main", "global", "top", "bottom", "left", "right", "primary", "secondary", "box", "bar",
                "list", "item", "items", "link", "links", "button", "buttons", "icon", "icons", "wrap", "wrapper",
                "container", "inner", "area", "block", "section", "form", "post", "posts", "article", "articles", "media",
                "to"}
# Names that stand for such a part even inside an article, and for a part with others' articles.
_BESIDE = {"ad", "ads", "advert", "adverts", "advertisement", "sponsored", "promo", "sidebar", "navbar", "breadcrumb",
           "breadcrumbs", "comments", "disqus", "newsletter", "signup", "pagination", "pager", "popup"}
_OTHERS = {"comments", "comment", "respond", "disqus", "related", "recommended", "sidebar"}
_HOLDS_ALL = {"html", "body", "article", "main"}
_CONTAINERS = {"div", "section", "ul", "ol", "li", "dl", "table", "figure", "fieldset", "details", "p", "center"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_NAME_PART = re.compile(r"[a-z]+")
BESIDE, NAMED, HINTED = "beside", "named", "hinted"


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _is_boiler(name: str, attributes: dict[str, str], in_main: bool) -> bool:
    """By element, role or hiding; class and id see _named."""
    if name in _BOILER_TAGS or (name == "header" and not in_main):
        return True
    if not attributes or name in _HOLDS_ALL:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    return attributes.get("role", "").lower() in _BOILER_ROLES


def _named(name: str, attributes: dict[str, str], in_main: bool) -> tuple[str, set[str]]:
    """What class and id say, with their words: BESIDE, a name that is one of _BESIDE; NAMED,
    a name of nothing but boilerplate and plain words; HINTED, such a word in a longer name;
    else ''. They say nothing of headings."""
    if name in _HOLDS_ALL or name in _HEADINGS:
        return "", set()
    boiler = _BOILER_WORDS if in_main else _BOILER_WORDS | {"header"}
    found, words = "", set()
    for whole in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        parts = set(_NAME_PART.findall(whole))
        if whole in _BESIDE:
            return BESIDE, {whole}
        hits = parts & boiler
        if hits and parts <= boiler | _PLAIN_WORDS:
            found, words = NAMED, words | hits
        elif hits and not found:
            found = HINTED
    return found, words


def blocks(html: str | None) -> list[tuple[str, str]]:
    """(text, zone) of every block that has text, see page_blocks."""
    return [(t, z) for t, z, _ in page_blocks(html)]


def page_blocks(html: str | None) -> list[tuple[str, str, int]]:
    """(text, zone, doubt) of every block that has text. ``main``: in the page's article, or in its
    main element where it has no article; ``boiler``: menus, headers, footers, sidebars,
    notices, adverts, forms, comments and what is hidden; ``free``: the rest.

    A class or id never drops a heading, nor a part that holds an article, main element or
    h1 -- but others' articles (comments, related ones) beside the page's own. Outside the
    article it drops only where the whole name is of boilerplate words, inside only where it
    is one of a few names. Any other part of the article with such a word in its name
    stays ``main``; its blocks have the part's number as ``doubt`` (0: none), so that
    differencing can tell whether it is boilerplate. Where class and id would leave nothing of
    the page they count for nothing.

    Scripts, styles, the page's title and markup have no text. Character references are
    decoded, white space inside a block becomes one space, empty blocks vanish. An article
    that is never closed ends with the page; such a boilerplate element ends where an
    article or heading begins; else a footer ends with the page and another holds nothing."""
    tokens: list[tuple[str, str, str, str]] = []  # (kind, name, attributes, text)
    at, html = 0, html or ""
    low = None
    while True:
        m = _TOKEN.search(html, at)
        text = html[at:m.start()] if m else html[at:]
        if text:
            tokens.append(("text", "", "", text))
        if not m:
            break
        at = m.end()
        if m[2]:
            name = m[2].lower()
            kind = "close" if m[1] else "open"
            tokens.append((kind, name, m[3], ""))
            if kind == "open" and name in _RAW and not m[3].endswith("/"):
                low = html.lower() if low is None else low
                end = low.find(f"</{name}", at)
                at = len(html) if end < 0 else end
    ends = _ends(tokens)
    marks = [i for i, (kind, name, attributes, _) in enumerate(tokens) if kind == "open"
             and (name in ("article", "main", "h1") or ("role" in attributes and _attributes(attributes).get("role") == "main"))]
    own = [i for i in marks if tokens[i][1] != "h1"]
    out = _zones(tokens, ends, marks, own, True)
    if not any((a or m or not own) and not b for _, b, a, m, _ in out):
        out = _zones(tokens, ends, marks, own, False)
    has_article = any(a and not b for _, b, a, _, _ in out)
    has_main = any(m and not b for _, b, _, m, _ in out)

    def zone(boiler: bool, article: bool, main: bool) -> str:
        if boiler:
            return BOILER
        if has_article:
            return MAIN if article else BOILER
        if has_main:
            return MAIN if main else BOILER
        return FREE

    zoned = [(t, zone(b, a, m), d) for t, b, a, m, d in out]
    return [(t, z, d if z == MAIN else 0) for t, z, d in zoned]


def _zones(tokens: list[tuple[str, str, str, str]], ends: list[int | None], marks: list[int], own: list[int],
           names: bool) -> list[tuple[str, bool, bool, bool, int]]:
    """(text; in boilerplate, article, main element; doubtful part) of every block. ``marks``:
    where articles, main elements and h1 begin; ``own``: without h1; ``names``: class and id count."""
    out: list[tuple[str, bool, bool, bool, int]] = []
    parts: list[str] = []
    boiler_until = article_until = main_until = doubt_until = -1
    doubt = 0

    def close_block() -> None:
        text = " ".join(unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        if text:
            out.append((text, *state))

    def drops(i: int, name: str, attrs: dict[str, str], in_main: bool, end: int) -> bool | None:
        """Whether class and id drop the element; None if they only raise a doubt."""
        said, words = _named(name, attrs, in_main)
        inside = [tokens[j][1] for j in marks[bisect_right(marks, i):bisect_right(marks, end)]]
        if i <= article_until:  # articles in an article are comments
            inside = [x for x in inside if x != "article"]
        if in_main and name not in _CONTAINERS:
            return False
        if inside:
            return names and said in (BESIDE, NAMED) and bool(words & _OTHERS and own and (own[0] < i or own[-1] > end))
        if in_main:
            return True if names and said == BESIDE else None
        return names and said in (BESIDE, NAMED)

    state = (False, False, False, 0)
    for i, (kind, name, attributes, text) in enumerate(tokens):
        if kind == "text":
            parts.append(text)
            continue
        if name in _BLOCK:
            close_block()
        elif name == "br":
            parts.append(" ")
        if kind == "open" and name not in _VOID and i > boiler_until:
            in_main = i <= article_until or i <= main_until
            attrs = _attributes(attributes) if attributes.strip(" /") else {}
            boiler = _is_boiler(name, attrs, in_main)
            named = not boiler and ("class" in attrs or "id" in attrs) and _named(name, attrs, in_main)[0]
            end = (_unclosed(tokens, i) if ends[i] is None else ends[i]) if boiler or named else None
            if named and end is not None:
                boiler = drops(i, name, attrs, in_main, end)
                if boiler is None and i > doubt_until:
                    doubt, doubt_until = doubt + 1, end
            if boiler:
                if end is not None:
                    if name not in _BLOCK:
                        close_block()
                    boiler_until = end
            elif name == "article" and i > article_until:
                article_until = len(tokens) if ends[i] is None else ends[i]
            elif (name == "main" or attrs.get("role") == "main") and i > main_until:
                main_until = len(tokens) if ends[i] is None else ends[i]
        if i == boiler_until:
            close_block()
        state = (i < boiler_until, i < article_until, i < main_until, doubt if i < doubt_until else 0)
    close_block()
    return out


def _ends(tokens: list[tuple[str, str, str, str]]) -> list[int | None]:
    """For every opening tag the index of its closing tag, counting nested ones of its name."""
    ends: list[int | None] = [None] * len(tokens)
    open_tags: dict[str, list[int]] = {}
    for i, (kind, name, attributes, _) in enumerate(tokens):
        if kind == "open" and name not in _VOID and not attributes.endswith("/"):
            open_tags.setdefault(name, []).append(i)
        elif kind == "close" and open_tags.get(name):
            ends[open_tags[name].pop()] = i
    return ends


def _unclosed(tokens: list[tuple[str, str, str, str]], i: int) -> int | None:
    """Last token of a boilerplate element that is never closed."""
    for j in range(i + 1, len(tokens)):
        if tokens[j][0] == "open" and tokens[j][1] in ("article", "main", "h1"):
            return j - 1
    return len(tokens) if tokens[i][1] == "footer" else None
