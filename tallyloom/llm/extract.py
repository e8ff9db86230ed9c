"""Main text of web pages by tag-path ratios.

Every text block of a page has a root-to-block tag path (element names with their
classes). Text length and punctuation are summed per path and divided by the number
of blocks of the path: two ratios. A block longer than a short paragraph counts as one, so that no long
block outweighs the others. Both ratios are smoothed over neighbouring blocks, fused by
multiplication, and paths with a fused value above a share of the page's mean are content
paths. The content element is the lowest common ancestor of all content paths; in it content paths, headings, and
what stands between content blocks and is no row of links are kept in page order. `article` and `main` elements
come first: the ratios are then taken of their blocks alone, articles without any content path are teasers, and in the others
content paths, headings and text elements that are no links are kept.

Elements that never hold an article (menus, page headers, footers, sidebars, forms) count nothing. Nor do elements whose class
or id has a word for such things (adverts, notices, comments), unless it can only be a word about the layout: the element
holds an `article` and no other part of the page does, or it holds nearly all text of the page or of the article.

Defined cases: null and empty pages, and pages without text, give an empty text; unclosed and
unopened tags are mended as browsers do; rows that repeat or lack an id get a row each; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.markup import BLOCK, Element, pieces

LAYOUT = 0.75  # of an element's text and the text beside it: with that much its class words tell of the layout
PARAGRAPH = 120  # characters that count of a block
SHARE = 0.25  # of the mean fused value makes a path content
# Elements, roles and words of class names that hold no article text.
NEVER = frozenset("head nav footer aside form button select menu dialog svg canvas object audio video map datalist fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup share sharing social related "
    "recommended recommendations sidebar sidenav menu nav navbar navigation navigator breadcrumb breadcrumbs pager pagination toc comment comments "
    "commentlist disqus replies reply respond discussion footer masthead toolbar widget widgets login search searchbox disclaimer copyright "
    "hidden skip skiplink outbrain taboola teaser trending".split())
WHOLE = frozenset("header site-header page-header top-header global-header side left-column right-column rail site-footer".split())
MAIN_ROLES = frozenset(("main", "article"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("p li td th dt dd".split())
TEXT = ITEMS | frozenset("blockquote pre figcaption caption address summary".split())
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")
_PARTS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


@lru_cache(maxsize=100_000)
def _unwanted_here(name: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """(whether never content, whether a word of its class or id says so)."""
    if name in NEVER or (name == "header" and not in_article):
        return True, False
    if not attributes.strip():
        return False, False
    own = Element(name, attributes, None)
    role = (own.get("role") or "").lower()
    if role in ROLES or own.get("hidden") is not None or (own.get("aria-hidden") or "").lower() == "true":
        return True, False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", own.get("style") or "", re.I):
        return True, False
    if name in ("html", "body", "main") or role == "main":
        return False, False
    for names in (own.get("class"), own.get("id")):
        for one in (names or "").split():
            plain = _CAMEL.sub("-", one).lower()
            if plain in WHOLE or WORDS.intersection(_PARTS.split(plain)):
                return False, True
    return False, False


def _is_main(element: Element) -> bool:
    return (element.name in MAIN_ROLES or (element.get("role") or "").lower() in MAIN_ROLES
            or (element.get("itemprop") or "") == "articleBody") if element.name in MAIN_ROLES or element.attributes else False


@dataclass(frozen=True)
class _About:
    element: Element
    depth: int
    key: int  # of the tag path
    never: bool
    named: tuple[Element, ...]  # from the root: those with a word of WORDS or WHOLE
    mains: tuple[Element, ...]  # from the root: article and main elements
    linked: bool
    block: Element  # innermost that is not inline


class _Page:
    """What is known of the elements of one page."""

    def __init__(self) -> None:
        self.known: dict[int, _About] = {}
        self.keys: dict[tuple[int, str, str], int] = {}

    def about(self, element: Element) -> _About:
        chain = []
        e: Element | None = element
        while e is not None and id(e) not in self.known:
            chain.append(e)
            e = e.parent
        have = self.known[id(e)] if e is not None else None
        for e in reversed(chain):
            mains = have.mains if have else ()
            never, named = _unwanted_here(e.name, e.attributes, bool(mains))
            never = never or (have is not None and have.never)
            key = (have.key if have else -1, e.name, e.attributes)
            have = self.known[id(e)] = _About(
                e, have.depth + 1 if have else 0, self.keys.setdefault(key, len(self.keys)), never, (have.named if have else ()) + ((e,) if named else ()),
                mains + ((e,) if not never and _is_main(e) else ()), e.name == "a" or (have is not None and have.linked),
                e if e.name in BLOCK or have is None else have.block)
        return have

    def common(self, a: Element | None, b: Element | None) -> Element | None:
        """The lowest element around both."""
        while a is not None and b is not None and a is not b:
            if self.about(a).depth >= self.about(b).depth:
                a = a.parent
            else:
                b = b.parent
        return a if a is b else None

    def layout(self, parts: list[tuple[_About, int]]) -> set[int]:
        """The named elements whose words tell of the layout only; `parts` are texts with their lengths."""
        def scope(about: _About, element: Element | None) -> int:
            outer = [m for m in about.mains if m is not element and (element is None or self.about(m).depth < self.about(element).depth)]
            return id(outer[0]) if outer else 0

        held: dict[int, int] = {}
        total: dict[int, int] = {}
        within: dict[int, int] = {}  # named element: the article around it, or 0
        around: set[int] = set()  # named elements around an article
        clear = False  # an article with no such word on or above it
        order: dict[int, None] = {}
        for about, n in parts:
            total[0] = total.get(0, 0) + n
            if about.mains:
                total[id(about.mains[0])] = total.get(id(about.mains[0]), 0) + n
            named = {id(e) for e in about.named}
            for e in about.named:
                order[id(e)] = None
                held[id(e)] = held.get(id(e), 0) + n
                within[id(e)] = scope(about, e)
            for m in about.mains:
                above = [e for e in about.named if self.about(e).depth <= self.about(m).depth]
                clear = clear or not above
                if id(m) not in named:
                    around.update(id(e) for e in above)
        spared: set[int] = set()
        for k in order:
            if not clear and k in around and not within[k]:
                spared.add(k)
            elif 2 * held[k] > total[within[k]] and (within[k] or not clear):
                beside = sum(n for about, n in parts if (not within[k] or (about.mains and id(about.mains[0]) == within[k]))
                             and all(id(e) in spared for e in about.named))
                inside = sum(n for about, n in parts if any(id(e) == k for e in about.named) and all(id(e) in spared for e in about.named))
                if held[k] >= LAYOUT * (held[k] + beside - inside):
                    spared.add(k)
        return spared


def _smooth(values: np.ndarray) -> np.ndarray:
    if len(values) < 3:
        return values
    padded = np.pad(values, 1, mode="edge")
    return 0.25 * padded[:-2] + 0.5 * values + 0.25 * padded[2:]


def main_text(page: str) -> str:
    """The article of one page, its blocks joined by a space."""
    know = _Page()
    root = Element("body", "", None)
    read: list[tuple[_About, Element, str] | None] = []
    for element, text, ends in pieces(page):
        if ends:
            read.append(None)
        elif not (about := know.about(element or root)).never:
            read.append((about, element or root, text))
    read.append(None)
    spared: set[int] = set()
    if any(p[0].named for p in read if p):
        spared = know.layout([(p[0], n) for p in read if p and (n := len("".join(p[2].split())))])

    texts: list[str] = []
    owners: list[Element] = []
    links: list[bool] = []
    line: list[str] = []
    owner: Element | None = None
    linked = 0
    for part in read:
        if part is None:
            text = " ".join("".join(line).split())
            if text and owner is not None:
                texts.append(text)
                owners.append(owner)
                links.append(2 * linked > len("".join(text.split())))
            line, owner, linked = [], None, 0
            continue
        about, element, text = part
        if any(id(e) not in spared for e in about.named):
            continue
        line.append(text)
        if about.linked:
            linked += len("".join(text.split()))
        if owner is None and text.strip():
            owner = element
    if not texts:
        return ""

    if any(know.about(e).mains for e in owners):
        inside = [k for k, e in enumerate(owners) if know.about(e).mains]
        texts, owners, links = ([column[k] for k in inside] for column in (texts, owners, links))
        marked = True
    else:
        marked = False
    owners_about = [know.about(e) for e in owners]
    blocks_of = [a.block for a in owners_about]
    number = np.unique([know.about(e).key for e in blocks_of], return_inverse=True)[1]
    blocks = np.bincount(number)
    length = np.array([len(t) for t in texts], float)
    counted = np.minimum(length, PARAGRAPH)
    marks = np.array([len(_PUNCTUATION.findall(t)) for t in texts], float) * counted / length
    text_ratio = (np.bincount(number, counted) / blocks)[number]
    mark_ratio = (np.bincount(number, marks) / blocks)[number]
    fused = _smooth(text_ratio) * (1.0 + _smooth(mark_ratio))

    content = fused >= SHARE * np.average(fused, weights=length)
    if marked:  # articles with a content path; in them content paths and what a text element says in running words
        chosen = {id(a.mains[0]) for a, is_content in zip(owners_about, content) if is_content}
        return " ".join(t for t, a, e, is_content, link in zip(texts, owners_about, blocks_of, content, links) if id(a.mains[0]) in chosen
                        and (is_content or e.name in HEADINGS or (not link and (e.name in TEXT or e is a.mains[-1]))))

    found = np.flatnonzero(content)
    holder: Element | None = blocks_of[found[0]]
    for k in found[1:]:
        holder = know.common(holder, blocks_of[k])
    if holder is not None and holder.name in ITEMS and holder.parent is not None:
        holder = holder.parent  # the items and headings beside the only long one
    kept = []
    for k, (e, link) in enumerate(zip(blocks_of, links)):
        between = found[0] < k < found[-1]
        fits = content[k] or e.name in HEADINGS or (between and not link) or (e.name in ITEMS and (between or not link))
        if fits and (holder is None or know.common(e, holder) is holder):
            kept.append(texts[k])
    return " ".join(kept)


def _extract(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for part in texts:
        yield pa.array([main_text(x.as_py() or "") for x in part], pa.string())


def main_texts(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    out = pages.select("page_id", "url", F.arrow_udf(_extract, "string")(F.col("html").cast("string")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
