"""A tolerant reading of HTML: elements by path, text by block, boilerplate by tag and name."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import xxhash

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<more>(?:[^>"']++|"[^"]{0,100000}+"|'[^']{0,100000}+')*+)>"""
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<more2>[^>]*+)>"
    r"|<[!?/][^>]*+>"
    r"|<[a-zA-Z/!?][^>]*+\Z",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d{3,}")  # numbers of single pages

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Elements that an end tag of another does not close.
WALLS = frozenset("html body article main section nav header footer aside div table td th form ul ol dl blockquote".split())
IMPLIED = {  # an opening tag closes these, unless a wall stands between
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
CONTAINERS = frozenset("body article main section div td center form".split())
MAIN = frozenset(("article", "main"))
#: Never part of an article.
DROPPED = frozenset(
    "head script style textarea title noscript iframe template nav footer aside form button select svg canvas object menu dialog "
    "xmp noembed noframes datalist".split()
)
#: Words of classes and ids of what is no article.
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adslot banner sponsor sponsored promo promotion menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup share sharing social related recommended comment comments commentlist respond "
    "disqus pagination pager widget widgets toolbar masthead login search".split()
)
_OUTSIDE = frozenset(("header",))  # only where no article or main is open
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
_COMMENTS = frozenset("comment comments commentlist respond disqus".split())


def path_of(parent: int, label: str) -> int:
    x = xxhash.xxh64_intdigest(label, parent & 0xFFFFFFFFFFFFFFFF)
    return x - (1 << 64) if x >> 63 else x


_path = lru_cache(1 << 16)(path_of)


@lru_cache(1 << 14)
def _described(name: str, more: str) -> tuple[str, frozenset[str], bool, bool]:
    """Label, words of its names, whether a role or attribute drops it, whether a role makes it main."""
    label, words, dropped, main = name, set(), _HIDDEN.search(more) is not None, False
    named = {}
    for attribute, *values in _NAMES.findall(more):
        named.setdefault(attribute.lower(), next((v for v in values if v), ""))
    if "role" in named:
        dropped |= named["role"].lower() in _ROLES
        main = named["role"].lower() == "main"
    for attribute, sign in (("id", "#"), ("class", ".")):
        if named.get(attribute):
            words.update(w.lower() for w in _WORD.findall(named[attribute]))
            label += sign + ".".join(sorted(_DIGITS.sub("0", named[attribute]).split()))
    return label, frozenset(words), dropped, main


class Element:
    __slots__ = ("tag", "label", "path", "parent", "chars", "linked", "dropped", "is_main", "in_main", "comments", "in_link")


def _opened(tag: str, more: str, top: Element | None) -> Element:
    e = Element()
    label, words, dropped, main = _described(tag, more[:2000])
    e.tag, e.label = tag, label
    e.parent = top.path if top else 0
    e.path = _path(e.parent, label)
    e.chars = e.linked = 0
    e.is_main = tag in MAIN or main
    e.in_link = tag == "a" or bool(top and top.in_link)
    in_main = bool(top and top.in_main)
    e.comments = bool(top and top.comments) or bool(words & _COMMENTS)
    by_name = tag not in ("html", "body") and not e.is_main and bool(words & DROPPED_NAMES)
    outside = not in_main and (tag == "header" or bool(words & _OUTSIDE)) and tag not in ("html", "body") and not e.is_main
    above = top.dropped if top else 0  # 1: by a name, in which an article may still stand; 2: by its tag or as comments
    if tag in DROPPED and tag != "form" or dropped or e.comments or above == 2:
        e.dropped = 2
    elif e.is_main:
        e.dropped = 0
    else:
        e.dropped = 1 if by_name or outside or above or (tag == "form" and in_main) else 0
    e.in_main = in_main or e.is_main
    return e


def read(html: str) -> Iterator[tuple[str, Element, str]]:
    """("open" | "close" | "text" | "break", element, text) in the order of the page.

    Every element opened is closed; text comes with the element that holds it, decoded.
    """
    stack: list[Element] = []
    counts: dict[str, int] = {}
    at, end = 0, len(html)

    def close() -> Element:
        e = stack.pop()
        counts[e.tag] -= 1
        if stack:
            stack[-1].chars += e.chars
            stack[-1].linked += e.linked
        return e

    root = _opened("html", "", None)
    while at < end:
        found = _TAG.search(html, at)
        start = found.start() if found else end
        if start > at:
            yield "text", stack[-1] if stack else root, unescape(html[at:start])
        if not found:
            break
        at = found.end()
        name = found["name"] or found["name2"]
        if not name:
            continue
        tag, more = name.lower(), (found["more"] or found["more2"] or "")
        if found["end"] or found["end2"]:
            if not counts.get(tag):
                continue
            if tag not in WALLS:  # not through a wall; that of an inline element not through any block
                walls = WALLS if tag in BLOCKS else BLOCKS
                for e in reversed(stack):
                    if e.tag == tag or e.tag in walls:
                        break
                if e.tag != tag:
                    continue
            while True:
                e = close()
                yield "close", e, ""
                if e.tag == tag:
                    break
            continue
        closes = IMPLIED.get(tag, ()) if tag not in BLOCKS or tag in IMPLIED else ()
        if tag in BLOCKS and counts.get("p"):
            closes = (*closes, "p")
        if any(counts.get(x) for x in closes):
            depth = None
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in closes:
                    depth = k
                    if stack[k].tag != "p" or len(closes) == 1:
                        break
                elif stack[k].tag in WALLS and stack[k].tag not in ("td", "th"):
                    break
            while depth is not None and len(stack) > depth:
                yield "close", close(), ""
        if tag in VOID:
            yield "break", stack[-1] if stack else root, tag
            continue
        e = _opened(tag, more, stack[-1] if stack else None)
        stack.append(e)
        counts[tag] = counts.get(tag, 0) + 1
        yield "open", e, ""
        if more.endswith("/") and tag in ("svg", "path"):
            yield "close", close(), ""
        elif tag in RAW:
            finish = _raw_end(tag).search(html, at)
            if finish and finish.start() > at and tag in ("title", "textarea"):
                yield "text", e, unescape(html[at : finish.start()])
            at = finish.end() if finish else end
            yield "close", close(), ""
    while stack:
        yield "close", close(), ""


@lru_cache(32)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\b[^>]*>", re.I)
