"""Main text of web pages by line-block distribution.

The markup is stripped into lines, one for each block of the page. A line's
weight is the length of its text outside links; lines of boilerplate containers
(menus, headers, footers, sidebars, notices, adverts, forms, comments ...) are
left out first, so they make no dive. A name alone makes no boilerplate: a
container with most of the page's own text stays (see `boilerplate`). Weights are summed over
sliding windows of the other lines. A surge is where the sum rises over the
threshold, a dive where it falls to nothing; the text between a surge and its
dive is kept. Lines of <article> and <main> that have text outside links weigh
the threshold more, so a short article surges too; the lines beside them are
summed among themselves and need the threshold like those of any page.

Lines of a container that holds kept text of the threshold or more are joined to
it: all with text outside links, and links between its first and its last line.
At either end, links that are no list items are joined unless there are as many
in a row as a window has lines.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches

# Fixed values of HTML: element names by their role.
RAW = "script style noscript template iframe svg math object canvas textarea select title"
VOID = "area base br col embed hr img input link meta source track wbr param"
INLINE = ("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
          "strong sub sup time tt u var wbr")
BOILERPLATE = "nav header footer aside form button dialog menu head fieldset"
ARTICLE = "article main"
#: Blocks that structure the text of their container.
TEXT = ("p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd blockquote pre figure figcaption section details summary center table caption "
        "thead tbody tfoot tr td th")
# Words of class, id and role attributes that name boilerplate containers.
NOTICES = ("ad ads advert adverts advertisement advertising sponsored sponsor promo promotion banner cookie cookies consent gdpr notice "
           "notices alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side aside "
           "widget related recommended recommendations share sharing social newsletter subscribe subscription signup login search "
           "comment comments commentlist discussion replies reply respond disqus pagination pager toolbar skip copyright complementary "
           "contentinfo")
# Those of them that name what readers write.
COMMENTS = "comment comments commentlist discussion replies reply respond disqus"

_RAW = frozenset(RAW.split())
_VOID = frozenset(VOID.split())
_INLINE = frozenset(INLINE.split())
_BOILER = frozenset(BOILERPLATE.split())
_ARTICLE = frozenset(ARTICLE.split())
_TEXT = frozenset(TEXT.split())
_NOTICES = frozenset(NOTICES.split())
_COMMENTS = frozenset(COMMENTS.split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|</\s*([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>", re.S)
_RAW_END = {name: re.compile(rf"</\s*{name}\s*[^>]*>", re.I) for name in _RAW}
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HREF = re.compile(r"\bhref\s*=", re.I)  # an anchor without it is no link
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
_ABSENT = frozenset("has with no not without".split())  # "has-sidebar" names the container beside it
_PART = re.compile(r"[^a-z0-9]+")


def doubt_of(name: str, attributes: str) -> str | None:
    """Why an element is or may be boilerplate: `always` (hidden, or by its element), `comments` or `named` (a form, or by class, id or role); None if nothing says so."""
    if name in _BOILER and name != "form" or _HIDDEN.search(attributes):
        return "always"
    found = "named" if name == "form" else None
    for _, a, b, c in _ATTRIBUTE.findall(attributes):
        for word in (a or b or c).lower().split():
            parts = _PART.split(word)
            if not _NOTICES.isdisjoint(parts) and _ABSENT.isdisjoint(parts):
                if not _COMMENTS.isdisjoint(parts):
                    return "comments"
                found = "named"
    return found


class Line(NamedTuple):
    text: str
    plain: int  # characters outside links
    doubts: tuple[tuple[int, str], ...]  # elements around it that may be boilerplate, and why
    article: bool  # in an article element
    item: bool  # in a list item
    inside: tuple[int, ...]  # the block itself unless it is one of TEXT, and its container


class Element(NamedTuple):
    name: str
    doubts: tuple[tuple[int, str], ...]  # so far, the outermost first
    article: bool  # in an article so far
    link: bool
    item: bool  # in a list item so far
    number: int
    container: int  # number of the innermost element around that is a block and not one of TEXT


def lines(page: str) -> list[Line]:
    """One line for each block that has text."""
    done: list[Line] = []
    stack: list[Element] = []
    number = 0  # of the last element; 0 is the page
    parts: list[str] = []
    plain = 0

    def close() -> None:
        nonlocal plain
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            doubts, article, item = (stack[-1].doubts, stack[-1].article, stack[-1].item) if stack else ((), False, False)
            block = next((x for x in reversed(stack) if x.name not in _INLINE), None)
            inside = (0,) if block is None else (block.container,) if block.name in _TEXT else (block.number, block.container)
            done.append(Line(text, min(plain, len(text)), doubts, article, item, inside))
        parts.clear()
        plain = 0

    def pop_to(depth: int) -> None:
        """Closes elements down to `depth`; a change of block or of role ends the line."""
        if any(x.name not in _INLINE for x in stack[depth:]) or (stack and stack[-1].doubts != (stack[depth - 1].doubts if depth > 0 else ())):
            close()
        del stack[depth:]

    at, n = 0, len(page)
    while at < n:
        start = page.find("<", at)
        m = _TOKEN.match(page, start) if start >= 0 else None
        if m is None and start >= 0:  # a bare "<" is text
            start += 1
        text = page[at:start if start >= 0 else n]
        if text:
            parts.append(text)
            if not any(x.link for x in stack):
                plain += len(text)
        if not m:
            at = start if start >= 0 else n
            continue
        at = m.end()
        ended, begun = m.group(1), m.group(2)
        if ended:
            name = ended.lower()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].name == name:
                    pop_to(depth)
                    break
                if name in _INLINE and stack[depth].name not in _INLINE:
                    break  # an inline end tag closes nothing outside its block
            if name not in _INLINE and parts:
                close()
        elif begun:
            name = begun.lower()
            if name in _RAW:
                if name != "title" and not m.group(3).rstrip().endswith("/") or name == "title":
                    end = _RAW_END[name].search(page, at)
                    at = end.end() if end else n
                if name not in _INLINE:
                    close()
                continue
            if name == "br":
                parts.append(" ")
                continue
            if name in _VOID:
                if name == "hr":
                    close()
                continue
            if name not in _INLINE:
                close()
                for depth in range(len(stack) - 1, -1, -1):  # p and li end at the next of their kind
                    if stack[depth].name == "p" or stack[depth].name == name == "li":
                        pop_to(depth)
                        break
                    if stack[depth].name not in _INLINE:
                        break
                while stack and stack[-1].name in _INLINE:  # inline elements do not reach over a block
                    stack.pop()
            before = stack[-1].doubts if stack else ()
            why = None if name in ("html", "body", *_ARTICLE) else doubt_of(name, m.group(3))
            article = name in _ARTICLE or bool(stack and stack[-1].article)
            if why:
                close()
            if not m.group(3).rstrip().endswith("/"):
                number += 1
                doubts = (*before, (number, why)) if why else before
                around = stack[-1] if stack else None
                container = 0 if around is None else around.container if around.name in _INLINE or around.name in _TEXT else around.number
                link = name == "a" and _HREF.search(m.group(3)) is not None
                stack.append(Element(name, doubts, article, link, name == "li" or bool(around and around.item), number, container))
        elif m.group(0).startswith("<!") or m.group(0).startswith("<?"):
            continue
    close()
    return done


def boilerplate(found: list[Line], width: int, threshold: float) -> list[bool]:
    """Which lines lie in boilerplate: a name gives a container doubt, its share of the page's text decides.

    A doubted container that holds most of the page's text outside links, the
    threshold at least, is none if the lines beside all doubted containers do
    not surge. If they do, only an article in it (that is no reader's comment)
    can clear it, and only while none stands outside. Hidden elements and
    those that are boilerplate by their element (nav, footer ...) always are.
    """
    total = sum(x.plain for x in found if all(why != "always" for _, why in x.doubts))
    inside: dict[tuple[int, str], list[Line]] = {}
    for x in found:
        for d in x.doubts:
            inside.setdefault(d, []).append(x)
    beside = [x for x in found if not x.doubts]
    surges = between_surges(np.array([float(x.plain) for x in beside]), width, threshold).any()
    outside = any(x.article and x.plain for x in beside)
    cleared = set()
    for d, own in inside.items():
        held = sum(x.plain for x in own if all(why != "always" for _, why in x.doubts))
        if d[1] != "always" and held >= threshold and 2 * held > total:
            if not surges and not outside or d[1] != "comments" and not outside and any(x.article and x.plain for x in own):
                cleared.add(d)
    return [any(d not in cleared for d in x.doubts) for x in found]


def between_surges(weights: np.ndarray, width: int = 3, threshold: float = 1.0) -> np.ndarray:
    """Lines between a surge and its dive: windows of `width` lines that start there and sum up to `threshold` or more.

    A surge is a window over the threshold after one below it; the dive is the
    first window that sums up to nothing. A line without weight at either end
    of such a stretch is left out.
    """
    n = len(weights)
    sums = np.convolve(weights, np.ones(width))[width - 1:width - 1 + n] if n else weights
    keep = np.zeros(n, bool)
    i = 0
    while i < n:
        if sums[i] < threshold:
            i += 1
            continue
        j = i
        while j < n and sums[j] > 0:
            j += 1
        inside = np.flatnonzero(weights[i:j] > 0)
        if len(inside):
            keep[i + inside[0]:i + inside[-1] + 1] = True
        i = j
    return keep


def rejoined(found: list[Line], keep: np.ndarray, width: int, threshold: float) -> np.ndarray:
    """`keep` and the other lines of the containers that hold kept text of `threshold` characters, or of an article."""
    held: dict[int, float] = {}
    for line, k in zip(found, keep, strict=True):
        for c in set(line.inside) if k else ():
            held[c] = held.get(c, 0.0) + line.plain + threshold * line.article
    heavy = {c for c, n in held.items() if n >= threshold}
    members: dict[int, list[int]] = {}
    for n, line in enumerate(found):
        for c in heavy.intersection(line.inside):
            members.setdefault(c, []).append(n)
    keep = keep.copy()
    for at in members.values():
        plain = [i for i, n in enumerate(at) if keep[n] or found[n].plain > 0]
        first, last = plain[0], plain[-1]
        keep[at[first:last + 1]] = True
        for end in (at[:first][::-1], at[last + 1:]):  # links at either end, from the text outwards
            run = next((i for i, n in enumerate(end) if found[n].item), len(end))
            if run < width:
                keep[end[:run]] = True
    return keep


def main_text(page: str | None, width: int = 3, threshold: float = 80.0) -> str:
    """The kept lines, joined by a line feed; empty if there are none.

    Windows of `width` lines must reach `threshold` characters outside links;
    a line of an article that has any weighs `threshold` more. If no window
    does, all lines that are not boilerplate are kept.
    """
    found = lines(page or "")
    found = [x for x, out in zip(found, boilerplate(found, width, threshold), strict=True) if not out]
    weights = np.array([float(x.plain) for x in found])
    inside = np.array([x.article for x in found], bool)
    keep = np.zeros(len(found), bool)
    for part, added in ((inside, threshold), (~inside, 0.0)):
        keep[part] = between_surges(weights[part] + added * (weights[part] > 0), width, threshold)
    keep = rejoined(found, keep, width, threshold) if keep.any() else ~keep
    return "\n".join(x.text for x, k in zip(found, keep, strict=True) if k)


def extracted(pages: DataFrame) -> DataFrame:
    """One row per row of `pages`: page_id, url, text, n_chars. Null or empty html: empty text, 0."""

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_batches(rows, run, "page_id long, url string, text string, n_chars long")
