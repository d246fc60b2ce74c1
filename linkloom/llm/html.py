"""Blocks of text of a web page, and what kind of block each is, in one pass over the markup."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

# Elements by their part in a page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center caption dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base basefont bgsound br col embed hr img input link meta param source track wbr".split())
SKIPPED_TAGS = frozenset("script style noscript template svg math canvas iframe object audio video textarea title".split())
BOILERPLATE_TAGS = frozenset("aside button datalist dialog footer form head input label menu nav search select".split())
BOILERPLATE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disclaimer disqus footer form gdpr login menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo "
    "promoted promotion recommended related replies reply respond share sharing sidebar signin signup social sponsor sponsored subscribe "
    "subscription toolbar widget".split()
)
# What a compound class name that begins with one of those words must end with, and what takes its meaning away.
CONTAINER_WORDS = frozenset(
    "area articles bar block body box buttons container content icons inner item items links list panel posts section slot stories thread unit wrap wrapper".split()
)
STATE_WORDS = frozenset("closed disabled enabled has hide is no not off on open show with without".split())
HEADER_WORDS = frozenset(("header", "masthead", "topbar"))
ARTICLE_WORDS = frozenset(("articlebody", "mainentityofpage"))
# What may stand in a head; anything else ends it.
HEAD_TAGS = frozenset("base basefont bgsound link meta noscript script style template title".split())
# Elements that an open list item, term or definition does not reach beyond, to be ended by the next one.
BARRIER_TAGS = BLOCK_TAGS.union(("button", "select")) - frozenset("address div p option legend search dialog".split())
TABLE_TAGS = frozenset("caption table tbody td tfoot th thead tr".split())
# Of the parts of a table, those that the begin of another ends.
TABLE_ENDS = {
    "td": ("td", "th", "caption"), "th": ("td", "th", "caption"), "tr": ("td", "th", "caption", "tr"),
    **dict.fromkeys(("caption", "tbody", "tfoot", "thead"), ("td", "th", "caption", "tr", "tbody", "tfoot", "thead")),
}

_NAME = re.compile(r"/?([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
# What stands between the name of a tag and its end: attributes, with any > in quoted values.
ATTRIBUTES = r"""(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))?+)*+"""
_REST = re.compile(f"{ATTRIBUTES}>")
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Block(NamedTuple):
    """``kind`` is ``article``, ``main``, ``plain``, ``boilerplate``, or ``inner`` for an article or main element in what would be boilerplate by a compound name."""

    kind: str
    text: str


def _tag_end(html: str, begin: int) -> int:
    """The place of the ``>`` that closes the tag whose name ends at ``begin``, past any in quoted values; -1 if there is none."""
    found = _REST.match(html, begin)
    return found.end() - 1 if found else -1


def _attributes(tag: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(tag)}


def _names(attributes: dict[str, str], wanted: frozenset[str]) -> tuple[bool, bool]:
    """Whether a class name or id is one of the ``wanted`` words, and whether it is made of one.

    A compound is about its last word ("site-footer") or about a container of its first ("comment-list"); one that
    states something ("no-sidebar", "comments-open") or goes on otherwise ("related-work") says nothing.
    """
    whole = made = False
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = _WORD.findall(name)
        if len(words) == 1 and words[0] in wanted:
            whole = True
        elif len(words) > 1 and STATE_WORDS.isdisjoint(words):
            made = made or words[-1] in wanted or (words[0] in wanted and words[-1] in CONTAINER_WORDS)
    return whole, made


def _role(name: str, tag: str, in_article: bool) -> str | None:
    """What an element makes of its content, if it makes anything of it; ``weak`` and ``form`` are boilerplate that may hold an article."""
    attributes = _attributes(tag) if tag.strip() else {}
    role = attributes.get("role", "").lower()
    whole, made = _names(attributes, BOILERPLATE_WORDS) if name not in ("html", "body") else (False, False)
    # A form may be around the whole page.
    if (name in BOILERPLATE_TAGS and name != "form") or role in BOILERPLATE_ROLES or whole:
        return "boilerplate"
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(attributes.get("style", "").lower()):
        return "boilerplate"
    if name == "article" or role == "article" or attributes.get("itemprop", "").lower() in ARTICLE_WORDS:
        return "article"
    if name == "main" or role == "main":
        return "main"
    if name == "form" or made:
        return "form" if name == "form" and not made else "weak"
    if name == "header" or any(_names(attributes, HEADER_WORDS)):
        return None if in_article else "boilerplate"
    return None


def _inside(kind: str, role: str | None) -> str:
    """The kind of the content of an element with a role, in content of a kind."""
    if role in ("article", "main"):
        if kind in ("weak", "inner"):
            return "inner"
        return "article" if kind == "article" else role
    if role == "form" and kind == "weak":
        return kind
    return role or kind


class _Open:
    """Open elements with the kind of block inside each; all steps take constant time per element."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, str]] = []
        self.places: dict[str, list[int]] = {}
        self.barriers: list[int] = []
        self.tables: list[int] = []

    @property
    def top(self) -> str:
        return self.stack[-1][0] if self.stack else ""

    @property
    def kind(self) -> str:
        return self.stack[-1][1] if self.stack else "plain"

    def push(self, name: str, kind: str) -> None:
        place = len(self.stack)
        self.stack.append((name, kind))
        self.places.setdefault(name, []).append(place)
        if name in BARRIER_TAGS:
            self.barriers.append(place)
        if name in TABLE_TAGS:
            self.tables.append(place)

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.places[self.stack.pop()[0]].pop()
        for places in (self.barriers, self.tables):
            while places and places[-1] >= depth:
                places.pop()

    def close(self, name: str) -> bool:
        found = bool(self.places.get(name))
        if found:
            self.cut(self.places[name][-1])
        return found

    def close_before(self, name: str) -> None:
        """End what the begin of element ``name`` ends."""
        if name in BLOCK_TAGS and self.top == "p":
            self.cut(len(self.stack) - 1)
        if name in ("option", "optgroup") and self.top == "option":
            self.cut(len(self.stack) - 1)
        if name == "optgroup" and self.top == "optgroup":
            self.cut(len(self.stack) - 1)
        if name in ("li", "dt", "dd") and self.barriers:
            same = ("li",) if name == "li" else ("dt", "dd")
            if self.stack[self.barriers[-1]][0] in same:
                self.cut(self.barriers[-1])
        while self.tables and self.stack[self.tables[-1]][0] in TABLE_ENDS.get(name, ()):
            self.cut(self.tables[-1])


def blocks_of(html: str) -> Iterator[Block]:
    """Blocks in page order; character references decoded, white space collapsed, no empty blocks.

    Scripts, styles, comments and other elements without readable text give nothing. Time is linear
    in the length of the page, whatever is left open in it.
    """
    open_ = _Open()
    kind, parts, pos = "plain", [], 0
    no_close: set[str] = set()

    def flush() -> Iterator[Block]:
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text:
            yield Block("boilerplate" if kind in ("weak", "form") else kind, text)

    while pos < len(html):
        at = html.find("<", pos)
        text = html[pos : at if at >= 0 else len(html)]
        if open_.top == "head" and not text.isspace() and text:
            parts.clear()
            open_.cut(len(open_.stack) - 1)
            kind = open_.kind
        parts.append(text)
        if at < 0:
            break
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            pos = len(html) if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), at):
            end = html.find(">", at)
            pos = len(html) if end < 0 else end + 1
            continue
        found = _NAME.match(html, at + 1)
        if not found:
            parts.append("<")
            pos = at + 1
            continue
        end = _tag_end(html, found.end())
        if end < 0:
            break  # a tag that never ends
        name, pos = found[1].lower(), end + 1
        closing, empty = html[at + 1] == "/", html[end - 1] == "/"
        if open_.top == "head" and not closing and name not in HEAD_TAGS:
            parts.clear()
            open_.cut(len(open_.stack) - 1)
            kind = open_.kind
        if name in SKIPPED_TAGS:
            if not closing and not empty and (name not in no_close or name == "title"):
                close = None if name in no_close else re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(html, pos)
                if close:
                    pos = close.end()
                else:
                    no_close.add(name)
                    if name in ("script", "style"):
                        pos = len(html)
                if not close and name == "title":
                    after = html.find("<", pos)
                    pos = after if after >= 0 else len(html)
            parts.append(" ")
            continue
        if name == "br":
            parts.append(" ")
            continue
        block = name in BLOCK_TAGS
        if block:
            yield from flush()
        if closing:
            if open_.close(name):
                if not block and open_.kind != kind:
                    yield from flush()
                kind = open_.kind
        elif name not in VOID_TAGS and not empty:
            open_.close_before(name)
            if open_.kind != kind:
                yield from flush()
                kind = open_.kind
            role = None if kind == "boilerplate" else _role(name, html[found.end() : end], kind in ("article", "main", "inner"))
            inner = _inside(kind, role)
            if inner != kind:
                yield from flush()
            open_.push(name, inner)
            kind = inner
    yield from flush()
