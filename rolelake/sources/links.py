"""Posting links out of a table of HTML pages, without leaving the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rolelake.functions.html import TAG, decode_references, visible_text
from rolelake.functions.text import clean_text, first_filled
from rolelake.functions.urls import make_absolute_url

_RAW_ELEMENTS = "|".join(
    rf"<{name}(?=[\s/>])(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+>.*?(?:</{name}\s*>|\z)" for name in ("script", "style")
)
# Comments and raw elements are tokens like tags, so what looks like one in an attribute's value is none.
_TOKEN = rf"(?is)<!--.*?(?:-->|\z)|{_RAW_ELEMENTS}|{TAG}|[^<]+|<"
_NOT_CONTENT = r"(?i)^<(?:!--|(?:script|style)[\s/>])"
_IS_ANCHOR = r"(?is)^<a(?=[\s/>]).*>$"
# Stands before every anchor's tag; a character that no HTML text may hold.
_MARK = "\u0001"
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
# Attributes are read in order, and the first href counts.
_HREF = (
    rf"""(?is)^<a(?:[\s/]+(?!href[\s=/>])[^\s=/>]+(?:\s*=\s*{_VALUE})?)*+[\s/]+href\s*=\s*"""
    r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))"""
)
_INNER = rf"(?is)^{TAG}(.*?)(?:</a\s*>|\z)"


def _href(anchor: Column) -> Column:
    values = [F.regexp_extract(anchor, _HREF, group) for group in (1, 2, 3)]
    return decode_references(first_filled(*values, default=""))


def anchors(html: Column | str) -> Column:
    """Array of (href, pos, body) per anchor, in page order.

    ``body`` runs from inside the start tag to the next anchor; comments, scripts and
    style sheets do not count.
    """
    content = F.translate(F.coalesce(html, F.lit("")), _MARK, " ")
    # Whole tags are told apart first, so neither ">" nor "<a" in an attribute's value misleads.
    tokens = F.regexp_extract_all(content, F.lit(_TOKEN), F.lit(0))
    marked = F.transform(
        tokens,
        lambda t: F.when(t.rlike(_IS_ANCHOR), F.concat(F.lit(_MARK), t)).when(t.rlike(_NOT_CONTENT), "").otherwise(t),
    )
    pieces = F.split(F.array_join(marked, ""), _MARK, -1)
    after_first = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(
        after_first,
        lambda piece, i: F.struct(_href(piece).alias("href"), i.alias("pos"), piece.alias("body")),
    )


def _href_contains(pattern: str) -> Callable[[Column], Column]:
    return lambda anchor: F.contains(anchor["href"], F.lit(pattern))


def page_links(
    pages: DataFrame,
    patterns: Sequence[str],
    base_url: Column | str = "url",
    min_title_length: int = 1,
    skip_own_url: bool = True,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """(key, url, pos, href, job_title, posting_url), one row per kept link.

    Per page the first pattern that any href contains is used.  Of equal hrefs the first
    counts, even where its title is then too short.  Everything is decided inside the
    page's own row, so there is no shuffle; first-of-equals is found by sorting.
    """
    parsed = pages.select(key, url, anchors(F.col(html)).alias("_anchors"))
    chosen = F
    for pattern in patterns:
        hit = _href_contains(pattern)
        chosen = chosen.when(F.exists("_anchors", hit), F.filter("_anchors", hit))
    usable = parsed.select(key, url, chosen.alias("_hits")).select(
        key,
        url,
        F.sort_array(
            F.filter(
                "_hits",
                lambda a: (a["href"] != "") & ((a["href"] != F.col(url)) | F.lit(not skip_own_url)),
            )
        ).alias("_sorted"),
    )
    def titled(anchor: Column) -> Column:
        inner = F.regexp_extract(anchor["body"], _INNER, 1)
        return F.struct(
            anchor["pos"].alias("pos"),
            anchor["href"].alias("href"),
            clean_text(visible_text(inner)).alias("job_title"),
        )

    firsts = F.filter(
        "_sorted", lambda a, i: (i == 0) | (F.get("_sorted", i - 1)["href"] != a["href"])
    )
    # Filtered before the rows are made: a filter on the rows would be pushed down and
    # compute every title a second time.
    kept = F.filter(
        F.transform(firsts, titled), lambda a: F.length(a["job_title"]) >= max(min_title_length, 1)
    )
    return usable.select(key, url, F.inline(kept)).withColumn(
        "posting_url", make_absolute_url(base_url, "href")
    )
