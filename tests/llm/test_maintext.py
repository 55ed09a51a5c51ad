import html
import re

import time

import pytest

from rolelake.llm import maintext

PAGES = {
    "article only": ('<nav><a>Menu</a></nav><article><h1>T</h1><p>One <b>two</b>\n three<p>Four</article><footer>f</footer>', "T\n\nOne two three\n\nFour"),
    "parts inside": (
        '<article><header><h1>T</h1></header><p>One<aside>no</aside><p>Two<form><input>x</form><ul><li>a<li>b</ul>'
        '<section class="comments"><article><p>hey</article></section><div>after</div></article><p>out', "T\n\nOne\n\nTwo\n\na\n\nb\n\nafter",
    ),
    "no article": (
        '<body><header><h1>Site</h1></header><div class="cookie-notice"><p>We use cookies <b>ok</div><div id=content><h1>Title</h1>'
        '<p>First paragraph with enough text to be kept, surely it is long enough for that.<p>Second &amp; third&nbsp;x</div><footer>f</footer>',
        "Title\n\nFirst paragraph with enough text to be kept, surely it is long enough for that.\n\nSecond & third x",
    ),
    "markup": (
        '<article><!-- a > b --><script>if (a < b) "</p>"</script><style>p{}</style><p title="a>b" class=x>1 &lt; 2 &#233;&eacute &amp</p>'
        "<p it's>it's > that<br>line<table><tr><td>c<td>d</table></article>", "1 < 2 éé &\n\nit's > that line\n\nc d",
    ),
    "unended": ('<article><p>text<div class="ad">gone</article>tail<script>never ends', "text"),
    "plain": ("just text", "just text"), "empty": ("", ""), "only links": ('<ul><li><a href=x>a link</a></ul>', ""), "null": (None, ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, want = PAGES[name]
    assert maintext.main_text(page) == want


def test_column_over_pages_and_clashing_names(spark):
    rows = [(i, page, "old") for i, (page, _) in enumerate(PAGES.values())]
    got = maintext.with_main_text(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: want for i, (_, want) in enumerate(PAGES.values())}
    assert maintext.with_main_text(spark.createDataFrame([], "html string")).count() == 0


def test_given_pages_match_their_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in maintext.with_main_text(pages).collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.DOTALL)[1]
        blocks = (re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", article))
        assert r["text"] == "\n\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_passages_lie_between_surge_and_dive():
    assert maintext.passages([0, 0, 5, 0, 7, 0, 0, 0, 9]) == [(2, 5, 12), (8, 9, 9)]
    assert maintext.passages([]) == maintext.passages([0, 0]) == []


def test_long_page():
    page = "<article>" + "<p>some words here</p>" * 50_000 + "</article>"
    assert maintext.main_text(page).count("some words here") == 50_000


BODY = "<h1>Title</h1>" + "".join(f"<p>Paragraph {k} of the body, with sentences long enough to make the sums of a window of lines rise.</p>" for k in range(6))
BODY_TEXT = "\n\n".join(["Title", *(f"Paragraph {k} of the body, with sentences long enough to make the sums of a window of lines rise." for k in range(6))])
TEASER = "<article><h3>Teaser</h3><p>Some words on another page.</p></article>"


@pytest.mark.parametrize("page", [
    f"<body><main>{BODY}</main>{TEASER}", f"<body><main>{BODY}{TEASER}</main>", f"<body><div>{BODY}</div>{TEASER}{TEASER}",
    f"{TEASER}<div>{BODY}</div>", f"{TEASER}<article>{BODY}</article>", f"<div>{BODY}</div>",
])
def test_sums_choose_the_passages_whatever_the_tags(page):
    assert maintext.main_text(page) == BODY_TEXT


def test_tags_are_a_weight():
    box = f"<div><p>{'Words of a box beside the text. ' * 4}</div>"
    assert maintext.main_text(f"<article>{BODY}</article>{'<hr><nav></nav>'}{box}") == BODY_TEXT
    assert "a box beside" in maintext.main_text(f"<div>{BODY}</div>{'<hr><nav></nav>'}{box}")
    assert maintext.main_text("<article><p><a href=x>only a link</a></article>") == "only a link"


@pytest.mark.parametrize("around", [
    'class="layout has-sidebar"', 'class="no-sidebar"', 'class="page with-nav"', 'class=widget', 'class="sidebar"', 'id="nav-wrapper"',
    'class="header"', 'class="content-sidebar-wrap"',
])
def test_a_wrapper_is_never_left_out_with_its_article(around):
    assert maintext.main_text(f"<body><div {around}><article>{BODY}</article></div>") == BODY_TEXT
    assert maintext.main_text(f"<body><div {around}><main>{BODY}</main></div>") == BODY_TEXT
    assert maintext.main_text(f"<body><form {around}><div><article>{BODY}</article></div></form>") == BODY_TEXT


@pytest.mark.parametrize("name", [
    "discussion", "related-work", "social-science", "notice", "reply-to-critics", "share-prices", "comment-on-methods", "consent", "navigation",
])
def test_parts_of_an_article_stay_whatever_their_names(name):
    part = f"<section id='{name}'><h2 id='{name}'>Its heading</h2><p>What it says.</section>"
    assert maintext.main_text(f"<article>{BODY}{part}<p>End.</article>") == f"{BODY_TEXT}\n\nIts heading\n\nWhat it says.\n\nEnd."
    assert "Its heading" in maintext.main_text(f"<article>{BODY}{part.replace('id=', 'class=')}") or name in ("consent", "navigation")


@pytest.mark.parametrize("name", ["ad", "ad-slot", "comments", "comment-list", "site-nav", "js-cookie-notice", "sidebar left", "mainMenu", "comments__list"])
def test_named_elements_are_left_out(name):
    out = f'<div class="{name}"><p>{"Text that nobody came for, however long. " * 9}</div>'
    assert maintext.main_text(f"{out}<div>{BODY}</div>{out}") == maintext.main_text(f"{out}<article>{BODY}{out}</article>") == BODY_TEXT


def test_doubtful_names_go_by_their_links():
    links = "<ul>" + "<li><a href=x>Another page with a long title</a>" * 5 + "</ul>"
    page = '<article>{}<div class="related-links"><h3>More</h3>{}</div></article>'
    assert maintext.main_text(page.format(BODY, links)) == BODY_TEXT
    assert "long title" in maintext.main_text(page.format(BODY, links.replace("<a ", "<b ").replace("</a>", "</b>")))


@pytest.mark.parametrize("tag", ["<b>", "<p><i>", "<div>", "<div class=related>", "<li><span>", "<article>", "<p></b>", "<a href=x>", "<nav>", "<", "<!--", "<a b='"])
def test_time_grows_with_the_page(tag):
    start = time.process_time()
    maintext.main_text(f"<body>{BODY}" + f"{tag}some words " * 50_000)
    assert time.process_time() - start < 5
