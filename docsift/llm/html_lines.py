"""Lines of an HTML page, each with its place: in the article, in the main part, beside
the text (menus, adverts and the like), or open."""

from __future__ import annotations

import html
import re

ARTICLE, MAIN, BESIDE, OPEN = "article", "main", "beside", "open"

_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))"""
    r"""|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>"']+|"[^"]*"|'[^']*')*+)>"""
    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)""",
    re.S,
)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

#: Elements whose content is not HTML text; it ends at their end tag only.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
SKIPPED = set("nav aside footer form menu dialog button select datalist svg math template object canvas audio video "
              "map head".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar "
            "tablist status".split())
#: Words of class names and ids that tell what an element is for.
WORDS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs masthead topbar toolbar footer comment comments disqus reply replies "
    "respond share sharing social related recommended recommendations widget pagination pager skip alert".split()
)
#: What a whole class name or id must be; their words alone also occur in articles.
WHOLE = {"header", "site-header", "page-header", "siteheader", "pageheader", "top-header", "hidden", "sr-only"}
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}


def _is_beside(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in SKIPPED:
        return True
    if tag == "header" and not in_article:
        return True
    if not attrs.strip():
        return False
    for name, value in _ATTR.findall(attrs):
        name = name.lower()
        value = html.unescape(value.strip("\"'"))
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id") and tag not in ("html", "body"):
            for one in value.split():
                if one.lower() in WHOLE or any(w.lower() in WORDS for w in _WORD.findall(one)):
                    return tag not in ("article", "main") or "comment" in one.lower()
    return False


class _Lines:
    def __init__(self):
        self.stack: list[tuple[str, str]] = []  # tag, place inside
        self.out: list[tuple[str, str]] = []
        self.parts: list[str] = []
        self.place = OPEN

    def line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.out.append((text, self.place))
            self.parts = []

    def inside(self) -> str:
        return self.stack[-1][1] if self.stack else OPEN

    def text(self, raw: str) -> None:
        if raw:
            place = self.inside()
            if place != self.place:
                self.line()
                self.place = place
            self.parts.append(html.unescape(raw) if "&" in raw else raw)

    def pop(self, depth: int) -> None:
        del self.stack[depth:]

    def open(self, tag: str, attrs: str) -> None:
        if tag == "br" or tag == "hr":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag not in INLINE:
            self.line()
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == "p":
                    self.pop(i)
                    break
                if self.stack[i][0] not in INLINE:
                    break
            if tag in _CLOSES:
                closed, scope = _CLOSES[tag]
                for i in range(len(self.stack) - 1, -1, -1):
                    if self.stack[i][0] in closed:
                        self.pop(i)
                        break
                    if self.stack[i][0] in scope:
                        break
        outer = self.inside()
        if outer == BESIDE or _is_beside(tag, attrs, outer == ARTICLE):
            place = BESIDE
        elif tag == "article":
            place = ARTICLE
        elif tag == "main" and outer != ARTICLE:
            place = MAIN
        else:
            place = outer
        self.stack.append((tag, place))

    def close(self, tag: str) -> None:
        if tag not in INLINE:
            self.line()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self.pop(i)
                return
            # An inline end tag does not close the block it lies in.
            if tag in INLINE and self.stack[i][0] not in INLINE:
                return


def lines(page: str | None) -> list[tuple[str, str]]:
    """Text and place of every line of a page, in order."""
    page = page or ""
    state = _Lines()
    at = 0
    while True:
        begin = page.find("<", at)
        if begin < 0:
            break
        found = _TOKEN.match(page, begin)
        if found is None:  # a mere character
            state.text(page[at : begin + 1])
            at = begin + 1
            continue
        state.text(page[at:begin])
        at = found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        if found["end"] or found["end2"]:
            state.close(tag)
            continue
        attrs = found["attrs"] or found["attrs2"] or ""
        if tag in RAW:
            state.line()
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if not attrs.rstrip().endswith("/") or tag not in ("path", "use", "g"):
            state.open(tag, attrs)
    state.text(page[at:])
    state.line()
    return state.out
