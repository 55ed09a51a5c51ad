"""Main text of web pages by line-block distribution.

Markup is stripped so that every block becomes a line, and an element that never holds article text
(menus, adverts, scripts ..) becomes a stretch of empty lines.  An element is left out for a class or id only if a
whole name says so and it isn't around an article or main; for names that articles also have for parts of
their own, most of its text must be links, too.  Text lengths are summed over a sliding
window of lines.  Where the sums rise from zero the text surges, where they fall to zero it dives;
lines between a surge and the next dive are one passage, cut where an ``article`` or ``main`` begins or ends.
On every page a passage is kept if its highest sum is large, where text of links doesn't count.  Tags are
a weight: sums in an article (or, outside articles, in ``main``) count up to twice, by the share of the page's text
that the element holds, and an element with a kept passage is kept whole, so that its short passages stay.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from rolelake.shipping import ship

#: Lines in a window; also the empty lines that a left-out element stands for.
WINDOW = 3
#: A passage is kept if its highest window sum reaches this many characters ..
SURGE_CHARS = 80
#: .. or the page's highest, and this share of the page's highest.
SURGE_SHARE = 0.3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*(?>\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z)", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

# Elements of HTML by what they mean here.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
_LEFT_OUT = frozenset("aside audio button canvas datalist dialog footer form head map menu nav object select svg video".split())
_BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
_SPACED = frozenset("br td th".split())
#: An opening tag of the first kind ends an open element of the second, up to the nearest of the third.
_IMPLIED_END = {"li": ("li", frozenset(("ul", "ol"))), "dt": ("dd", frozenset(("dl",))), "dd": ("dt", frozenset(("dl",)))}
_LEFT_OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Names of classes and ids that mark what isn't article text, where all of a name's parts are from here or the next two sets ..
_LEFT_OUT_NAMES = frozenset(
    "ad ads adsense advert advertisement advertising advertorial banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies dialog disqus footer gdpr menu modal nav navbar navigation newsletter overlay pagination popup promo sharing sidebar "
    "signup skip sponsor sponsored subscribe toolbar".split()
)
#: .. names that articles have for their own parts, too: left out if most of the element's text is links ..
_DOUBTFUL_NAMES = frozenset(
    "discussion notice paywall promotion recommended related replies reply respond share social subscription widget".split()
)
#: .. and parts that say nothing by themselves.
_NEUTRAL_NAMES = frozenset(
    "area bar block bottom box button buttons c container global inner item items js l left link links list main outer panel primary "
    "right secondary section site slot top u unit wp wrap wrapper".split()
)
#: These mark page parts only outside an article; in one they hold its title.
_PAGE_HEADS = frozenset("header masthead".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


_KEPT, _DOUBTFUL, _NAMED, _OUT = range(4)


def _name_mark(names: str, in_article: bool) -> int:
    """What a class or id says about its element, by whole names."""
    found = _KEPT
    for name in names.split():
        parts = {p.lower() for p in _NAME_PART.findall(name)}
        marks = parts & (_LEFT_OUT_NAMES if in_article else _LEFT_OUT_NAMES | _PAGE_HEADS)
        if (marks or parts & _DOUBTFUL_NAMES) and not parts - marks - _DOUBTFUL_NAMES - _NEUTRAL_NAMES:
            found = max(found, _NAMED if marks else _DOUBTFUL)
    return found


def _mark(tag: str, attributes: str, in_article: bool) -> int:
    """Whether an element is left out: never, if most of its text is links, unless it holds an article or main, or always."""
    if tag == "form":
        return _OUT if in_article else _NAMED
    if tag in _LEFT_OUT:
        return _OUT
    if tag == "header":
        return _KEPT if in_article else _OUT
    if tag in ("html", "body", "article", "main") or not attributes:
        return _KEPT
    found = _KEPT
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), unescape("".join(values))
        if name == "class" or name == "id":
            said = _name_mark(value, in_article)
            # Ids of an article's parts are their titles.
            found = max(found, min(said, _DOUBTFUL) if name == "id" and in_article else said)
        elif (
            name == "role" and value.strip().lower() in _LEFT_OUT_ROLES
            or name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true"
            or name == "style" and "display:none" in value.replace(" ", "").lower()
        ):
            return _OUT
    if found == _DOUBTFUL and (tag in _HEADINGS or tag not in _BLOCKS):
        return _KEPT
    return found


class _Suspect:
    """An element that may be left out; known when all of it has been read."""

    def __init__(self, at: int, mark: int, in_article: bool, around: _Suspect | None) -> None:
        self.at, self.mark, self.in_article, self.around = at, mark, in_article, around
        self.holds_article, self.chars, self.plain = False, 0, 0

    def left_out(self) -> bool:
        if self.holds_article and not self.in_article:
            return False
        return self.mark == _NAMED or 2 * self.plain < self.chars


class _Lines:
    """Lines of a page as (text, length without links, region); one pass over its tags.

    A region is the number of the outermost article around a line or, outside articles, of the outermost main.
    """

    def __init__(self) -> None:
        self.lines: list[tuple[str, int, int | None]] = []
        self.open: list[str] = []
        self.places: dict[str, list[int]] = {}  # of each tag in ``open``, in order
        self.begun = 0  # articles and mains so far
        self.region: dict[str, int] = {}
        self.suspects: list[_Suspect] = []  # all, in order
        self.suspect: _Suspect | None = None  # the innermost open one
        self.within: list[_Suspect | None] = []  # the innermost around each line
        self.out_at: int | None = None  # position in ``open`` of the outermost left-out element
        self.pieces: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            region = next((self.region[t] for t in ("article", "main") if self.places.get(t)), None)
            self.add(text, max(0, len(text) - self.linked), region)
        self.pieces, self.linked = [], 0

    def add(self, text: str, plain: int, region: int | None) -> None:
        self.lines.append((text, plain, region))
        self.within.append(self.suspect)
        if self.suspect is not None:
            self.suspect.chars += len(text)
            self.suspect.plain += plain

    def gap(self) -> None:
        self.flush()
        for _ in range(WINDOW):
            self.add("", 0, None)

    def found(self) -> list[tuple[str, int, int | None]]:
        """The lines, with empty ones for the elements that turned out to be left out."""
        for x in reversed(self.suspects):
            if x.around is not None:
                x.around.chars += x.chars
                x.around.plain += x.plain
                x.around.holds_article |= x.holds_article
        out: dict[_Suspect | None, bool] = {None: False}
        for x in self.suspects:
            out[x] = out[x.around] or x.left_out()
        shown: list[tuple[str, int, int | None]] = []
        gap = False
        for line, within in zip(self.lines, self.within, strict=True):
            if not out[within]:
                shown.append(line)
            elif not gap:
                shown += [("", 0, None)] * WINDOW
            gap = out[within]
        return shown

    def say(self, text: str) -> None:
        if text and self.out_at is None:
            text = unescape(text)
            self.pieces.append(text)
            if self.places.get("a"):
                self.linked += len(text.strip())

    def close_to(self, size: int) -> None:
        """Close the innermost elements until ``size`` are open; the line ends while they still count."""
        if self.out_at is None and (any(t in _BLOCKS for t in self.open[size:]) or self.suspect is not None and self.suspect.at >= size):
            self.flush()
        for tag in self.open[size:]:
            self.places[tag].pop()
        del self.open[size:]
        while self.suspect is not None and self.suspect.at >= size:
            self.suspect = self.suspect.around
        if self.out_at is not None and self.out_at >= size:
            self.out_at = None
            self.gap()

    def innermost(self, tag: str, until: frozenset[str]) -> int | None:
        """Position of the innermost open ``tag``, not looking past an element of ``until``."""
        if not self.places.get(tag):
            return None
        k = self.places[tag][-1]
        return None if any(self.places.get(other, [])[-1:] > [k] for other in until) else k

    def start(self, tag: str, attributes: str) -> None:
        if tag in _BLOCKS:
            if (k := self.innermost("p", _BLOCKS - {"p"})) is not None:
                self.close_to(k)
            if tag in _IMPLIED_END:
                other, until = _IMPLIED_END[tag]
                for name in {tag, other}:
                    if (k := self.innermost(name, until)) is not None:
                        self.close_to(k)
            if self.out_at is None:
                self.flush()
        elif tag in _SPACED:
            self.say(" ")
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCKS:
            return
        if self.out_at is None:
            in_article = bool(self.places.get("article"))
            mark = _mark(tag, attributes, in_article)
            if mark == _OUT:
                self.gap()
                self.out_at = len(self.open)
            elif mark != _KEPT:
                self.flush()
                self.suspect = _Suspect(len(self.open), mark, in_article, self.suspect)
                self.suspects.append(self.suspect)
            elif tag in ("article", "main") and self.suspect is not None:
                self.suspect.holds_article = True
        if tag in ("article", "main") and not self.places.get(tag):
            self.begun += 1
            self.region[tag] = self.begun
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(tag)

    def end(self, tag: str) -> None:
        # The end of an inline element doesn't end blocks that were opened inside it.
        k = self.innermost(tag, frozenset() if tag in _BLOCKS or tag in _LEFT_OUT else _BLOCKS)
        if k is not None:
            self.close_to(k)


def page_lines(html: str) -> list[tuple[str, int, int | None]]:
    """Blocks of a page in order, with empty lines for the elements left out."""
    found, at = _Lines(), 0
    while (token := _TOKEN.search(html, at)) is not None:
        found.say(html[at : token.start()])
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if token[1]:
            found.end(tag)
        elif tag in _RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(html, at)
            at = close.start() if close else len(html)
        else:
            found.start(tag, token[3])
    found.say(html[at:])
    found.flush()
    return found.found()


def passages(lengths: list[int]) -> list[tuple[int, int, int]]:
    """(first line, end line, highest window sum) of the stretches between surge and dive points."""
    sums = [sum(lengths[i : i + WINDOW]) for i in range(len(lengths))]
    found, i = [], 0
    while i < len(lengths):
        if lengths[i] == 0:
            i += 1
            continue
        first = i  # surge: the first line with text
        while i < len(lengths) and sums[i] > 0:
            i += 1
        found.append((first, i, max(sums[first:i])))
    return found


def _cut(lines: list[tuple[str, int, int | None]], a: int, b: int) -> list[tuple[int, int]]:
    """The parts of a passage that lie in one region each; empty lines go with the part before."""
    edges, region = [a], lines[a][2]
    for i in range(a, b):
        if lines[i][0] and lines[i][2] != region:
            edges.append(i)
            region = lines[i][2]
    return list(zip(edges, [*edges[1:], b], strict=True))


def main_text(html: str | None) -> str:
    """The page's main text: its blocks joined by empty lines; empty if there is none."""
    lines = page_lines(html or "")
    plain = [line[1] for line in lines]
    parts = [part for a, b, _ in passages([len(line[0]) for line in lines]) for part in _cut(lines, a, b)]
    held: dict[int | None, int] = {}
    for _, n, region in lines:
        held[region] = held.get(region, 0) + n
    total = sum(held.values())
    weight = {region: 1 + n / total if total and region is not None else 1.0 for region, n in held.items()}
    scores = [weight[lines[a][2]] * max(sum(plain[i : min(i + WINDOW, b)]) for i in range(a, b)) for a, b in parts]
    top = max(scores, default=0)
    large = {p for p, x in zip(parts, scores, strict=True) if x >= min(SURGE_CHARS, top) and x >= SURGE_SHARE * top and top > 0}
    # Text of links alone is main text only in an article or main.
    regions = {lines[a][2] for a, _ in large} - {None} if top > 0 else set(held) - {None}
    kept = [p for p in parts if p in large or lines[p[0]][2] in regions]
    return "\n\n".join(lines[i][0] for a, b in kept for i in range(a, b) if lines[i][0])


@F.pandas_udf(T.StringType())
def _main_texts(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None)


def with_main_text(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """Add the main text of every page as column ``into``, from the whole page.

    Null or empty page, or one without main text: empty text.  Broken or unended markup: read as far as it
    goes; an element left out that never ends reaches to the end of the element around it.  Repeated pages: equal texts.  Empty
    table: no rows.  An input column named ``into`` is replaced.
    """
    ship(pages.sparkSession)
    return pages.withColumn(into, _main_texts(F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))))
