"""Main text of web pages by the distribution of text over lines.

1. `lines` strips the markup. Every block element begins a new line; scripts,
   styles and comments vanish; lines inside menus, headers, footers, sidebars,
   forms, notices, adverts and reader comments (by element or by a word of
   their class, id or role) are set apart. End tags that HTML lets out (of
   heads, items, cells, paragraphs) are implied.
2. `weights` gives each line its characters outside links, `MARK` times inside
   an article or main element; a linked line of an article that stands alone
   counts whole. Lines set apart weigh 0, so that they are gaps; but an element
   with at least `SURGE` characters that outweighs the rest of the page is the
   text, whatever its name, and is not set apart (what it holds may be). Where
   an article begins or ends there is a gap as well.
3. `regions` sums the weights over windows of `WINDOW` lines. A surge is a line
   at which the sums rise to `SURGE`, a dive the line at which they fall to 0.
   The lines of weight between each surge and its dive are the text. A page on
   which nothing reaches the threshold keeps all its lines of weight.

White space (space, 0x09-0x0D) inside a line is one space; character references
are decoded; lines are joined by a newline. Null and empty pages give an empty
text. Each row is worked on by itself, whatever its other columns hold.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 3
SURGE = 80
MARK = 8

# Comments, elements whose content is no text, declarations.
_RAW = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_STOP = re.compile(r"[>\"']")
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math picture "
    "q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_APART = frozenset("nav footer aside form header menu dialog select button head object".split())
_APART_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent contentinfo complementary disclaimer footer menu modal nav navbar navigation newsletter "
    "notice notices popup promo promoted reply replies related share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar widget".split()
)


def _apart(name: str, attributes: str, in_article: bool) -> bool:
    if name in _APART:
        return not (name == "header" and in_article)
    if name in ("body", "html", "article", "main") and "comment" not in attributes.lower():
        return False
    for m in _NAMED.finditer(attributes):
        if _APART_WORDS.intersection(re.split(r"[^a-z]+", m[1].lower())):
            return True
    return False


_HEAD = frozenset("base link meta title style script noscript template".split())
# The elements that an element of the name ends, and those beyond which it does not reach.
_ENDS = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select"),
    "tr": ("tr", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "thead": ("thead tbody tfoot", "table"), "tbody": ("thead tbody tfoot", "table"),
    "tfoot": ("thead tbody tfoot", "table"),
}
_ENDS = {name: tuple(frozenset(part.split()) for part in parts) for name, parts in _ENDS.items()}
_P_STAYS = frozenset("button caption object table td th".split())


class _Open:
    """The open elements of a page, and which of them are set apart."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.count: Counter[str] = Counter()
        self.apart: list[tuple[int, int]] = []  # depth and number of each element set apart
        self.roots: list[tuple[int, int]] = []  # of each number: the number around it, articles around it

    @property
    def articles(self) -> int:
        return self.count["article"] + self.count["main"]

    def cut(self, depth: int) -> None:
        for name in self.names[depth:]:
            self.count[name] -= 1
        del self.names[depth:]
        while self.apart and self.apart[-1][0] >= depth:
            self.apart.pop()

    def _cut_within(self, ended: frozenset[str], bounds: frozenset[str]) -> None:
        if not any(self.count[name] for name in ended):
            return
        for depth in range(len(self.names) - 1, -1, -1):
            if self.names[depth] in ended:
                return self.cut(depth)
            if self.names[depth] in bounds:
                return None

    def begin(self, name: str, attributes: str) -> None:
        if self.count["head"] and name not in _HEAD and name not in ("head", "html"):
            self.cut(self.names.index("head"))
        if name in _ENDS:
            self._cut_within(*_ENDS[name])
        elif name not in _INLINE:
            self._cut_within(frozenset(("p",)), _P_STAYS)
        if name in _VOID or attributes.endswith("/") and name not in _INLINE and name in _APART:
            return
        if _apart(name, attributes, self.articles > 0):
            self.roots.append((self.apart[-1][1] if self.apart else -1, self.articles))
            self.apart.append((len(self.names), len(self.roots) - 1))
        self.names.append(name)
        self.count[name] += 1

    def end(self, name: str) -> None:
        if not self.count[name]:
            return
        for depth in range(len(self.names) - 1, -1, -1):
            if self.names[depth] == name:
                return self.cut(depth)
            if name in _INLINE and self.names[depth] not in _INLINE:
                return None


class Line(NamedTuple):
    text: str
    linked: int
    articles: int
    apart: int  # number of the innermost element set apart, -1 if there is none


def _close(html: str, at: int, failed: set[int]) -> int:
    """Where the tag whose attributes begin at `at` ends, `>` inside quotes apart; -1 if a quote stays open.

    `failed` holds places from which no end was found, so that no later tag
    reads the same quotes again.
    """
    seen = []
    while at not in failed:
        seen.append(at)
        stop = _STOP.search(html, at)
        if not stop:
            break
        if stop[0] == ">":
            return stop.start()
        at = html.find(stop[0], stop.end()) + 1
        if not at:
            break
    failed.update(seen)
    return -1


def tokens(html: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Of each piece of markup where it begins and ends, and of tags whether they end, name and attributes.

    A tag with an open quote ends at the next `>` and has no name. Each
    character is read a constant number of times, however broken the page is.
    """
    last, failed = html.rfind(">"), set()
    at = html.find("<")
    while 0 <= at < last:
        end = at + 1
        if raw := _RAW.match(html, at):
            end = raw.end()
            yield at, end, False, "", ""
        elif tag := _NAME.match(html, at):
            close = _close(html, tag.end(), failed)
            if close >= 0:
                end = close + 1
                yield at, end, bool(tag[1]), tag[2].lower(), html[tag.end():close]
            else:
                end = html.find(">", tag.end()) + 1
                yield at, end, False, "", ""
        at = html.find("<", end)
    at = html.find("<!--", at) if at >= 0 else -1  # beyond the last `>` only a comment can begin
    if at >= 0:
        yield at, len(html), False, "", ""


def lines(html: str) -> tuple[list[Line], list[tuple[int, int]]]:
    """The lines of a page; of each element set apart the number of the one around it and the articles around it."""
    out: list[Line] = []
    parts: list[str] = []
    opened = _Open()
    links = linked = 0

    def close() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", unescape("".join(parts))).strip(" ")
        if text:
            out.append(Line(text, min(linked, len(text)), opened.articles, opened.apart[-1][1] if opened.apart else -1))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if links:
            linked += len(unescape(text).strip())

    at = 0
    for begin, end, ends, name, attributes in tokens(html):
        if begin > at:
            add(html[at:begin])
        at = end
        if not name:
            continue
        if name == "a":
            links = max(0, links - 1) if ends else links + 1
        if name == "br":
            parts.append(" ")
        if name not in _INLINE:
            close()
            links = 0
        elif not ends and name not in _VOID and _apart(name, attributes, opened.articles > 0):
            close()
        elif ends and opened.apart and opened.names[opened.apart[-1][0]] == name:
            close()
        if ends:
            opened.end(name)
        else:
            opened.begin(name, attributes)
    if at < len(html):
        add(html[at:])
    close()
    return out, opened.roots


def weights(found: list[Line], roots: list[tuple[int, int]]) -> list[tuple[str, int]]:
    """The text and weight of each line, with gaps where an article begins or ends."""
    plain = [len(x.text) - x.linked for x in found]
    held = [[0, 0] for _ in roots]  # characters and weight of all that each element set apart holds
    total = 0
    for line, n in zip(found, plain, strict=True):
        apart = line.apart
        total += n * (MARK if line.articles > (roots[apart][1] if apart >= 0 else 0) else 1)
        while apart >= 0:
            held[apart][0] += n
            held[apart][1] += n * (MARK if line.articles > roots[apart][1] else 1)
            apart = roots[apart][0]
    out_of = []  # whether a line of each element set apart stays so
    for number, (around, _) in enumerate(roots):
        n, weight = held[number]
        out_of.append((around >= 0 and out_of[around]) or n < SURGE or 2 * weight <= total)
    out: list[tuple[str, int]] = []
    inside = False
    for i, line in enumerate(found):
        if inside != (line.articles > 0):
            inside = not inside
            out += [("", 0)] * WINDOW
        n = plain[i]
        if inside and n <= 0 and not any(plain[j] <= 0 for j in (i - 1, i + 1) if 0 <= j < len(found)):
            n = len(line.text)
        away = line.apart >= 0 and out_of[line.apart]
        out.append(("", 0) if away else (line.text, n * MARK if inside else n))
    return out


def regions(weights: list[int], threshold: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """Half-open ranges of lines from each surge to its dive."""
    n = len(weights)
    sums = [0] * n
    running = 0
    for i in range(n - 1, -1, -1):
        running += weights[i] - (weights[i + window] if i + window < n else 0)
        sums[i] = running
    found, i = [], 0
    while i < n:
        if sums[i] < threshold or not weights[i]:
            i += 1
            continue
        dive = i
        while dive < n and sums[dive] > 0:
            dive += 1
        while i and weights[i - 1]:
            i -= 1
        found.append((i, dive))
        i = dive
    return found


def main_text(html: str) -> str:
    """The main text of one page."""
    found = weights(*lines(html))
    each = [weight for _, weight in found]
    kept = regions(each, SURGE) or [(0, len(found))]
    return "\n".join(found[i][0] for low, high in kept for i in range(low, high) if each[i])


def extracted(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """`pages` with the column `html` replaced by `into`, the main text of each page.

    Another column of the name `into` is left out.
    """
    rest = [f for f in pages.schema.fields if f.name == html or f.name.lower() != into.lower()]
    fields = [T.StructField(into, T.StringType()) if f.name == html else f for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py() or "") for x in batch.column(html)], pa.string())
            columns = [texts if f.name == html else batch.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return pages.select(*[F.col(f"`{f.name}`") for f in rest]).mapInArrow(run, T.StructType(fields))
