"""Leaf blocks of an HTML page with their tag paths, in one linear scan."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

#: Fixed values from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template title textarea iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]), "dt": frozenset(["dd", "dt"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "tr": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]), "tbody": frozenset(["td", "th", "tr", "thead", "tbody"]),
}
BARRIER = frozenset("ul ol dl table body html article section main div nav aside form".split())
#: Elements that a page element inside them ends, unless they may hold it; and what they don't show.
FOREIGN = frozenset(["svg", "math"])
HOLDERS = FOREIGN | {"object", "select"}
INLINE_HTML = frozenset("b big br code em embed i img nobr ruby s small span strong strike sub sup tt u var".split())
CHOICES = frozenset(["option", "optgroup", "hr"])
UNSEEN = frozenset(["title", "desc", "metadata", "annotation", "annotation-xml"])

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|</?([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?([a-zA-Z][^\s/>]*+)([^>]*+)>?""", re.S)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    """Text between two block boundaries; ``path`` has the names of all open elements, outermost first."""

    path: tuple[tuple[str, ...], ...]
    text: str
    linked: int = 0
    chunks: list[str] = field(default_factory=list, repr=False)


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    found = [tag]
    if "=" in attributes or "hidden" in attributes:
        for name, value in _ATTR.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "style":
                found += ["hidden"] if "display:none" in value.replace(" ", "").lower() else []
            elif name in ("hidden", "aria-hidden"):
                found += ["hidden"] if value.lower() != "false" else []
            else:
                found += [x.lower() for x in _NAME.findall(value)]
    return tuple(found)


def blocks(page: str | None) -> list[Block]:
    """The non-empty leaf blocks in page order; white space is one space, references are decoded.

    Scripts, styles and other elements without visible text are left out. Drawings,
    formulas, objects and choices are elements like others; page elements end a drawing,
    a formula or a choice left open. Unclosed and badly nested elements are closed as
    browsers do in the common cases; a page that ends inside an element gives what came
    before.
    """
    page = page or ""
    stack: list[str] = []
    names: list[tuple[str, ...]] = []
    out: list[Block] = []
    chunks: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(chunks).split())
        if text:
            out.append(Block(tuple(names), text, linked))
        chunks.clear()
        linked = 0

    def close(depth: int) -> None:
        del stack[depth:], names[depth:]

    def foreign() -> int:
        """Depth of the outermost drawing or formula around here, but not around a page part held by it; else -1."""
        found = -1
        if "svg" not in stack and "math" not in stack:
            return found
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth] == "foreignobject":
                break
            found = depth if stack[depth] in FOREIGN else found
        return found

    while at < len(page):
        start = page.find("<", at)
        start = len(page) if start < 0 else start
        if start > at:
            text = html.unescape(page[at:start]) if "&" in page[at:start] else page[at:start]
            depth = foreign()
            if depth < 0 or UNSEEN.isdisjoint(stack[depth:]):
                chunks.append(text)
                linked += len(text) if "a" in stack else 0
        at = start
        if at >= len(page):
            break
        match = _TAG.match(page, at)
        if not match:
            chunks.append("<")
            at += 1
            continue
        at = match.end()
        tag = (match[1] or match[3] or "").lower()
        if not tag:
            continue
        if page[start + 1] == "/":
            if tag == "text":
                chunks.append(" ")
            if tag in stack:
                depth = len(stack) - 1 - stack[::-1].index(tag)
                holds = any(x in BLOCK for x in stack[depth + 1 :])
                if tag in BLOCK or tag in HOLDERS or not holds:
                    if tag in BLOCK or holds:
                        flush()
                    close(depth)
            elif tag in BLOCK:
                flush()
            continue
        attributes = match[2] or match[4] or ""
        depth = foreign()
        if depth >= 0 and (tag in BLOCK or tag in INLINE_HTML):
            close(depth)
            depth = -1
        if "select" in stack and (tag == "select" or tag in BLOCK and tag not in CHOICES):
            flush()
            close(stack.index("select"))
        if tag == "br":
            chunks.append(" ")
        elif tag in RAW and not (depth >= 0 and tag == "title"):
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{tag}[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
            if tag == "title":
                flush()
        elif tag in BLOCK:
            flush()
            if "p" in stack and not (tag in CHOICES and "select" in stack):
                depth = len(stack) - 1 - stack[::-1].index("p")
                if not any(x in ("table", "button", "td", "th", "object") for x in stack[depth + 1 :]):
                    close(depth)
            ends = CLOSED_BY.get(tag)
            if ends:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth] in ends:
                        close(depth)
                    elif stack[depth] in BARRIER and stack[depth] not in ("tbody", "thead"):
                        break
            if tag not in VOID:
                stack.append(tag)
                names.append(_names(tag, attributes))
        elif tag not in VOID and not attributes.endswith("/"):
            if tag == "text":
                chunks.append(" ")
            elif tag == "select":
                flush()
            stack.append(tag)
            names.append(_names(tag, attributes))
    flush()
    return out
