"""Posting cards out of a table of HTML pages.

Which block of a page belongs to a link depends on the nesting of its tags, which column
expressions cannot follow.  So a small parser runs per Arrow batch and returns raw text
only; all cleaning stays in column expressions.  A block's text is returned once per page
and referred to by number, so that many links in one block do not repeat it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime
from html.parser import HTMLParser
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rolelake.functions.dates import parse_date, timestamp_lit
from rolelake.functions.text import (
    DEFAULT_CITY,
    KNOWN_CITIES,
    NO_LOCATION,
    _KEPT_PUNCTUATION,
    clean_text,
    extract_salary,
    first_city,
    normalize_location,
    organisation,
    split_title,
    truncate_text,
)
from rolelake.functions.urls import make_absolute_url
from rolelake.shipping import ship

Step = tuple[str, str | None]  # tag name and, if wanted, a class


@dataclass(frozen=True)
class ContainerRules:
    """Pages whose cards are marked: every ``card`` element is one posting."""

    source: str
    base_url: str
    card: Step
    title_paths: Sequence[Sequence[Step]]
    logo_path: Sequence[Step]
    description: Step
    date_tag: str
    date_id: str
    place_href: str
    default_place: str = DEFAULT_CITY


@dataclass(frozen=True)
class LinkRules:
    """Pages known by their links: a card is the nearest block around a link.

    ``climb`` limits how many ancestors are looked at; a block counts once its text is
    more than ``margin`` characters longer than the title.
    """

    source: str
    base_url: str
    patterns: Sequence[str]
    climb: int
    min_title_length: int
    skip_own_url: bool
    company_href: str | None = None
    find_city: bool = False
    cities: Sequence[str] = KNOWN_CITIES
    default_place: str = NO_LOCATION
    block_tags: Sequence[str] = ("article", "div", "li", "section")
    margin: int = 10


# Where each source's pages keep their postings.
MYJOBMAG = ContainerRules(
    source="MyJobMag",
    base_url="https://www.myjobmag.co.ke",
    card=("li", "job-list-li"),
    title_paths=((("li", "mag-b"), ("h2", None), ("a", None)), (("h2", None), ("a", None))),
    logo_path=(("li", "job-logo"), ("a", None), ("img", None)),
    description=("li", "job-desc"),
    date_tag="li",
    date_id="job-date",
    place_href="/jobs-location/",
)
BRIGHTERMONDAY_LINKS = LinkRules(
    source="BrighterMonday",
    base_url="https://www.brightermonday.co.ke",
    patterns=("/listings/",),
    climb=6,
    min_title_length=1,
    skip_own_url=False,
    company_href="/company/",
    find_city=True,
    default_place=DEFAULT_CITY,
)
FUZU_LINKS = LinkRules(
    source="Fuzu",
    base_url="https://fuzu.com",
    patterns=("/kenya/job/", "/job/", "/jobs/"),
    climb=5,
    min_title_length=4,
    skip_own_url=True,
)

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_NO_TEXT = frozenset(("script", "style"))


class _Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def ancestors(self):
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def walk(self):
        """Elements below this one, in page order."""
        stack = [iter(self.children)]
        while stack:
            child = next(stack[-1], None)
            if child is None:
                stack.pop()
            elif isinstance(child, _Node):
                yield child
                stack.append(iter(child.children))

    def strings(self):
        stack = [iter(self.children)]
        while stack:
            child = next(stack[-1], None)
            if child is None:
                stack.pop()
            elif isinstance(child, str):
                yield child
            elif child.tag not in _NO_TEXT:
                stack.append(iter(child.children))

    def text(self, separator=""):
        return separator.join(s for s in (part.strip() for part in self.strings()) if s)

    def fits(self, step):
        tag, css_class = step
        return self.tag == tag and (
            css_class is None or css_class in (self.attrs.get("class") or "").split()
        )

    def first(self, path):
        """First element below that fits the last step, inside the earlier steps."""
        for node in self.walk():
            if node.fits(path[-1]):
                wanted, above = list(path[:-1]), node.parent
                while wanted and above is not None:
                    if above.fits(wanted[-1]):
                        wanted.pop()
                    above = above.parent
                if not wanted:
                    return node
        return None


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = _Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in ("li", "p", "a"):
            self._close(tag, stop_at=("ul", "ol", "table") if tag == "li" else ("div", "td", "li"))
        named = {}
        for name, value in attrs:
            named.setdefault(name, value or "")
        node = _Node(tag, named, self.open)
        self.open.children.append(node)
        if tag not in _VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self._close(tag)

    def handle_data(self, data):
        self.open.children.append(data)

    def _close(self, tag, stop_at=()):
        node = self.open
        while node.parent is not None and node.tag not in stop_at:
            if node.tag == tag:
                self.open = node.parent
                return
            node = node.parent


def _parse(html: str) -> _Node:
    builder = _TreeBuilder()
    builder.feed(html or "")
    builder.close()
    return builder.root


_UNUSUAL = re.compile(rf"[^\w {_KEPT_PUNCTUATION}]")


def _clean_length(title: str) -> int:
    """Length of the title as the column cleaning will leave it."""
    return len(_UNUSUAL.sub("", " ".join(title.split())).strip())


def _link_to(node: _Node, fragment: str) -> _Node | None:
    return next((n for n in node.walk() if n.tag == "a" and fragment in n.attrs.get("href", "")), None)


def _container_cards(root: _Node, url: str, rules: ContainerRules):
    blocks, cards = [], []
    for node in root.walk():
        if not node.fits(rules.card):
            continue
        title = next(filter(None, (node.first(path) for path in rules.title_paths)), None)
        if title is None or not title.attrs.get("href"):
            continue
        logo = node.first(rules.logo_path)
        description = node.first((rules.description,))
        date = next(
            (n for n in node.walk() if n.tag == rules.date_tag and n.attrs.get("id") == rules.date_id),
            None,
        )
        place = _link_to(date, rules.place_href) if date is not None else None
        cards.append(
            {
                "pos": len(cards),
                "href": title.attrs["href"],
                "title": title.text(),
                "block": len(blocks),
                "logo_alt": logo.attrs.get("alt") if logo is not None else None,
                "description": description.text() if description is not None else None,
                "date_text": "".join(c.strip() for c in date.children if isinstance(c, str))
                if date is not None
                else None,
                "place": place.text() if place is not None else None,
            }
        )
        blocks.append({"text": "".join(node.strings()), "company": None})
    return blocks, cards


def _link_cards(root: _Node, url: str, rules: LinkRules):
    links = [n for n in root.walk() if n.tag == "a" and n.attrs.get("href")]
    chosen = next(
        (hits for p in rules.patterns if (hits := [n for n in links if p in n.attrs["href"]])), []
    )
    blocks, cards, seen, numbers, lengths = [], [], set(), {}, {}

    def length_of(node: _Node) -> int:
        if id(node) not in lengths:
            lengths[id(node)] = len(node.text(" "))
        return lengths[id(node)]

    for link in chosen:
        href = link.attrs["href"]
        if href in seen or (rules.skip_own_url and href == url):
            continue
        seen.add(href)
        title = link.text()
        enough = _clean_length(title) + rules.margin
        # The nearest ancestor that fits; failing that, the one at the end of the climb.
        above = list(islice(link.ancestors(), rules.climb + 1))
        fitting = (n for n in above[: rules.climb] if n.tag in rules.block_tags and length_of(n) > enough)
        block = next(fitting, above[rules.climb] if len(above) > rules.climb else None)
        if block is not None and id(block) not in numbers:
            company = _link_to(block, rules.company_href) if rules.company_href else None
            numbers[id(block)] = len(blocks)
            blocks.append(
                {
                    "text": block.text("|"),
                    "company": company.text() if company is not None else None,
                }
            )
        cards.append(
            {
                "pos": len(cards),
                "href": href,
                "title": title,
                "block": numbers.get(id(block)) if block is not None else None,
                "logo_alt": None,
                "description": None,
                "date_text": None,
                "place": None,
            }
        )
    return blocks, cards


_RAW_FIELDS = (
    "blocks array<struct<text:string,company:string>>, "
    "cards array<struct<pos:int,href:string,title:string,block:int,logo_alt:string,"
    "description:string,date_text:string,place:string>>"
)


def raw_cards(
    pages: DataFrame,
    rules: ContainerRules | LinkRules,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """One row per page with its blocks and cards as raw text."""
    cut = _container_cards if isinstance(rules, ContainerRules) else _link_cards

    def parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [cut(_parse(page), own_url, rules) for page, own_url in zip(batch[html], batch[url])]
            yield pd.DataFrame(
                {
                    key: batch[key],
                    url: batch[url],
                    "blocks": [blocks for blocks, _ in found],
                    "cards": [cards for _, cards in found],
                }
            )

    ship(pages.sparkSession)
    slim = pages.select(key, url, html)
    key_type = slim.schema[key].dataType.simpleString()
    return slim.mapInPandas(parse_batches, f"{key} {key_type}, {url} string, {_RAW_FIELDS}")


def page_cards(
    pages: DataFrame,
    rules: ContainerRules | LinkRules,
    as_of: datetime | str | Column,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Normalised posting columns per card, with the page's key, URL and card position."""
    raw = raw_cards(pages, rules, key, url, html)
    per_block = raw.select(
        key,
        url,
        "cards",
        # Salary and city once per block, however many links share it.
        F.transform(
            "blocks",
            lambda b: F.struct(
                extract_salary(b["text"]).alias("salary"),
                first_city(
                    b["text"],
                    getattr(rules, "cities", KNOWN_CITIES),
                    rules.default_place,
                ).alias("city"),
                b["company"].alias("company"),
            ),
        ).alias("_blocks"),
    )
    cards = per_block.select(key, url, "_blocks", F.explode("cards").alias("c")).select(
        key, url, "c.*", F.get("_blocks", F.col("c.block")).alias("_block")
    )
    cleaned = cards.withColumn("_title", clean_text("title"))
    null_text = F.lit(None).cast("string")
    if isinstance(rules, ContainerRules):
        job_title, from_title = split_title("_title")
        company = organisation("logo_alt", from_title)
        place = F.when(F.col("place").isNotNull(), normalize_location(clean_text("place")))
        location = F.coalesce(place, F.lit(rules.default_place))
        snippet = truncate_text(
            F.when(F.col("description").isNotNull(), clean_text("description")), 500
        )
        posted = parse_date("date_text", as_of, default=as_of)
        base_metadata = [F.lit("scraper_version"), F.lit("2.0")]
        keep = F.col("_title") != ""
    else:
        job_title = F.col("_title")
        company = F.when(
            F.col("_block.company").isNotNull(), clean_text("_block.company")
        ).otherwise(F.lit("N/A"))
        location = F.coalesce("_block.city", F.lit(rules.default_place)) if rules.find_city else F.lit(
            rules.default_place
        )
        snippet = null_text
        posted = timestamp_lit(as_of)
        base_metadata = [F.lit("source"), F.lit("html_parse")]
        keep = F.length("_title") >= max(rules.min_title_length, 1)
    return cleaned.where(keep).select(
        key,
        "pos",
        job_title.alias("job_title"),
        company.alias("company"),
        location.alias("location"),
        make_absolute_url(F.lit(rules.base_url), "href").alias("posting_url"),
        F.lit(rules.source).alias("source"),
        F.col("_block.salary").alias("salary_text"),
        snippet.alias("description_snippet"),
        null_text.alias("full_description"),
        posted.alias("posted_date"),
        F.create_map(*base_metadata, F.lit("page_url"), F.col(url)).alias("metadata"),
    )
