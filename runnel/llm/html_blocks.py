"""Leaf blocks of an HTML page: runs of inline content with the tags, classes and ids they lie under."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Elements by kind, after the HTML standard.
BLOCK = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section summary table tbody td tfoot th thead title tr ul xmp".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes svg object canvas audio video textarea select annotation annotation-xml".split())
#: A start tag of the key closes an open element of these names, up to the nearest of the others.
_P_ENDS = frozenset(("p",))
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "optgroup")),
    "body": (("head",), ("html",)),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S
)
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]  # open block elements, outermost first
    names: frozenset[str]  # words of classes, ids and roles of all open elements
    linked: int  # characters in links


@dataclass
class _Open:
    tag: str
    names: frozenset[str] = field(default_factory=frozenset)


def _names(attributes: str) -> frozenset[str]:
    out = set()
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key in ("class", "id", "role"):
            out.update(NAME.findall(CAMEL.sub(" ", value).lower()))
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            out.add("!hidden")
    return frozenset(out)


def blocks(page: str) -> list[Block]:
    """All leaf blocks in page order. References are decoded, white space inside a block is one space, empty ones go.

    Comments, declarations and the content of scripts, styles, embedded objects, form fields and noscript (which a
    browser does not show) are no text; the symbols of math are, and xmp holds text as it stands. Missing end tags are put in where the standard does (p, li, dt, dd, tr, td, th, option); a stray end tag is passed over.
    """
    out: list[Block] = []
    stack: list[_Open] = []
    parts: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                names = frozenset().union(*(e.names for e in stack)) if stack else frozenset()
                out.append(Block(text, tuple(e.tag for e in stack), names, min(linked, len(text))))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                linked += len(text.strip())

    def close(tags: tuple[str, ...] | frozenset[str], upto: tuple[str, ...]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag in tags:
                del stack[i:]
                if "p" in tags or stack and stack[-1].tag in upto:
                    return
            elif stack[i].tag in upto:
                return

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, end = m[2].lower(), m[1] == "/"
        if tag in RAW and not end:
            if not m[3].rstrip().endswith("/"):
                stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else n
            if tag in ("textarea", "select", "iframe", "svg", "object", "canvas", "audio", "video", "template", "noscript"):
                parts.append(" ")
            continue
        if tag == "a":
            links = 0 if end else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in BLOCK:
            continue
        flush()
        if end:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        links = 0
        if stack and stack[-1].tag == "p" or any(e.tag == "p" for e in stack):
            close(_P_ENDS, ("td", "th", "table", "body"))
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag == "xmp":
            stop = re.compile(r"</xmp\b[^>]*>", re.I).search(page, at)
            parts.append(page[at : stop.start() if stop else n])
            stack.append(_Open(tag, _names(m[3])))
            flush()
            stack.pop()
            at = stop.end() if stop else n
            continue
        if tag not in VOID and not (tag in ("html", "body") and any(e.tag == tag for e in stack)):
            stack.append(_Open(tag, _names(m[3])))
    flush()
    return out
