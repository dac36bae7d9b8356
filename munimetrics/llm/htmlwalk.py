"""A small HTML walker: elements with their paths, and text by block."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_DIGITS = re.compile(r"\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed template svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot"
    " thead tr ul".split()
)
#: An opening tag ends these open elements above the nearest element that holds them.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "body": {"head"}}
HOLDERS = frozenset("ul ol menu dl table tbody thead tfoot select body html article section div".split())

#: Parts of a page that are no main text, by element, by role, and by names in class or id.
ASIDE = frozenset("nav aside footer button select dialog canvas object head menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
WORDS = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads adv advert adverts advertisement advertisements"
    " advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup"
    " modal overlay newsletter subscribe subscription signup login comment comments commentlist respond reply replies disqus"
    " share sharing social related recommended breadcrumb breadcrumbs pagination pager toolbar widget skip".split()
)
#: A name of several words tells a part if one is of ``WORDS`` and the others are of these (``site-footer``).
PLACES = frozenset(
    "site main top bottom left right primary secondary global container wrapper inner outer box bar list item items area block"
    " section panel links link form unit slot buttons".split()
)
#: Share of a page's prose that makes an element hold the main text, wherever the headline stands.
MOST = 0.8
_WORD = re.compile(r"[a-z]+")


class Element(NamedTuple):
    name: str
    path: str
    aside: bool  # whatever it holds, by itself or an element around it
    doubtful: tuple[int, ...]  # it and elements around it that are aside unless they hold the page's main text
    number: int


class Text(NamedTuple):
    stack: tuple[Element, ...]
    block: int
    text: str


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)} if source.strip(" /\n\t") else {}


def _is_aside(name: str, attributes: dict[str, str], within: tuple[Element, ...]) -> bool:
    if name in ASIDE or (name == "header" and not any(e.name in ("article", "main") for e in within)):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in attributes.get("style", "").lower().replace(" ", ""):
        return True
    if name in ("html", "body", "article", "main"):
        return False
    if attributes.get("role", "").lower() in ROLES:
        return True
    return False


def _is_doubtful(name: str, attributes: dict[str, str], within: tuple[Element, ...]) -> bool:
    if name == "form":
        return True
    if name in ("html", "body", "article", "main", "h1"):
        return False
    for token in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = set(_WORD.findall(token))
        telling = words & WORDS
        if words <= {"header"} and any(e.name in ("article", "main") for e in within):
            continue
        if telling and words - telling <= PLACES:
            return True
    return False


def walk(source: str) -> Iterator[Element | Text]:
    """Every element as it opens, and every stretch of text with the elements around it and its block's number.

    Only elements that shape blocks are on the stack, and ones that (may) stand aside whatever they are. Comments,
    declarations, scripts, styles and the like are passed over. References are decoded.
    """
    stack: tuple[Element, ...] = ()
    block = number = at = 0
    lowered: str | None = None
    last = max(source.rfind(">"), source.rfind("<!"), source.rfind("<?"))  # no tag ends or opens for good behind it
    while True:
        found = _TAG.search(source, at) if at <= last else None
        text = source[at : found.start() if found else len(source)]
        if text:
            yield Text(stack, block, html.unescape(text))
        if found is None:
            return
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        if found[1] or found[4]:
            if name in BLOCK:
                block += 1
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].name == name:
                    stack = stack[:depth]
                    break
                if name in ("p", "li", "span") and stack[depth].name in HOLDERS:
                    break
            continue
        if name in ("td", "th", "br"):
            yield Text(stack, block, " ")
        if name in BLOCK:
            block += 1
            if stack and stack[-1].name == "p":
                stack = stack[:-1]
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth].name in CLOSES.get(name, ()):
                stack = stack[:depth]
                break
            if stack[depth].name in HOLDERS:
                break
        if name in ("svg", "math") and (found[3] or found[6] or "").endswith("/"):
            continue
        if name in RAW:
            if lowered is None:
                lowered = source.lower()
                if len(lowered) != len(source):  # a letter whose lower case is longer
                    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), source)
            end = lowered.find(f"</{name}", at)
            if end < 0 and name in ("svg", "math"):
                continue
            close = source.find(">", end) if end >= 0 else -1
            at = close + 1 if close >= 0 else len(source)
            continue
        if name in VOID:
            continue
        attributes = _attributes(found[3] or found[6] or "")
        aside, doubtful = _is_aside(name, attributes, stack), _is_doubtful(name, attributes, stack)
        if name in BLOCK or aside or doubtful:
            number += 1
            around = (*(stack[-1].doubtful if stack else ()), *([number] if doubtful else []))
            mark = _DIGITS.sub("", f"{name}.{attributes.get('class', '')}#{attributes.get('id', '')}")
            element = Element(name, f"{stack[-1].path if stack else ''}/{mark}", aside or bool(stack and stack[-1].aside), around, number)
            stack = (*stack, element)
            yield element


def judged(source: str) -> list[tuple[Element | Text, bool]]:
    """The parts of a page and whether they stand aside.

    A doubtful element holds the main text if more than half of the page's prose is in it (of its articles' prose, if
    that is at least half of all) and no headline stands outside it in the main text, or if ``MOST`` of the prose is.
    """
    parts = list(walk(source))
    size, inside, headlines = [0, 0], ({}, {}), []
    for part in parts:
        if not isinstance(part, Text) or (part.stack and part.stack[-1].aside):
            continue
        length = len(" ".join(part.text.split()))
        if not length:
            continue
        doubtful = part.stack[-1].doubtful if part.stack else ()
        for kind in (0, 1) if any(e.name in ("article", "main") for e in part.stack) else (0,):
            size[kind] += length
            for number in doubtful:
                inside[kind][number] = inside[kind].get(number, 0) + length
        if any(e.name == "h1" for e in part.stack):
            headlines.append(set(doubtful))
    kind = int(size[1] > 0 and 2 * size[1] >= size[0])
    large = {n for n, held in inside[kind].items() if 2 * held > size[kind]}
    kept = {
        n for n in large
        if inside[kind][n] >= MOST * size[kind] or any(n in h for h in headlines) or all(h - large for h in headlines)
    }

    def is_aside(part: Element | Text) -> bool:
        holder = part if isinstance(part, Element) else part.stack[-1] if part.stack else None
        return holder is not None and (holder.aside or not kept.issuperset(holder.doubtful))

    return [(part, is_aside(part)) for part in parts]
