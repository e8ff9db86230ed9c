"""A small reader of HTML as it is found: text pieces with their tag path, in page order."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

# Element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body br button caption head html legend optgroup option select tbody td tfoot th thead tr".split())
# an opening tag closes an open one of these, unless one of the others stands between
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"})}
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


@dataclass(frozen=True)
class Element:
    name: str
    attributes: str
    parent: "Element | None"

    def get(self, wanted: str) -> str | None:
        for name, a, b, c in _ATTRIBUTE.findall(self.attributes):
            if name.lower() == wanted:
                return html.unescape(a or b or c)
        return None


def _closed(stack: list[Element], names: set[str] | frozenset[str], walls: set[str]) -> None:
    for k in range(len(stack) - 1, -1, -1):
        if stack[k].name in names:
            del stack[k:]
            return
        if stack[k].name in walls:
            return


def pieces(page: str) -> Iterator[tuple[Element | None, str, bool]]:
    """(innermost element, decoded text, False), and (None, "", True) where a block begins or ends.

    Comments, declarations and the content of raw elements are left out. An end tag
    without a start is ignored; what is open at the end of the page ends there.
    """
    stack: list[Element] = []
    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        end = found.start() if found else len(page)
        if end > at:
            yield stack[-1] if stack else None, html.unescape(page[at:end]), False
        if not found:
            return
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        if name in BLOCK:
            yield None, "", True
        if found[1] or found[4]:
            if any(e.name == name for e in stack):
                while stack.pop().name != name:
                    pass
            continue
        attributes = found[3] or found[6] or ""
        if name in CLOSES_P:
            _closed(stack, {"p"}, {"button", "table", "article", "body", "div", "section", "main", "td", "th", "li", "blockquote"})
        if name in SIBLINGS:
            _closed(stack, *SIBLINGS[name])
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
        elif name not in VOID:
            stack.append(Element(name, attributes, stack[-1] if stack else None))


def plain_text(page: str) -> str:
    """All text outside raw elements and the head, a line for each block, white space as single spaces."""
    lines: list[str] = []
    line: list[str] = []
    for element, text, ends in pieces(page):
        if ends:
            lines.append(" ".join("".join(line).split()))
            line = []
        else:
            line.append(text)
    lines.append(" ".join("".join(line).split()))
    return "\n".join(x for x in lines if x)
