import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from rolelake.sources import cards, links, payloads

AS_OF = datetime(2024, 2, 1, 12, 0)


def pages(spark, *htmls, url="https://a.com/jobs"):
    return spark.createDataFrame([(i, url, h) for i, h in enumerate(htmls)], "page_id long, url string, html string")


def test_links(spark):
    html = """
      <!-- <a href="/kenya/job/0">Commented</a> --><script>'<a href="/kenya/job/s">Script</a>'</script>
      <a class=x href='/kenya/job/1?a=1&amp;b=2'> Data <b> Engineer</b> </a>
      <a href="/kenya/job/2"><img></a> <a href="/kenya/job/2">Hidden by the first</a>
      <A HREF=/kenya/job/3>abc</A> <a href="/kenya/job/4">Caf&eacute; R&amp;D</a>
      <a href="/job/5">Other pattern</a> <a name="/kenya/job/6">No link</a>
      <a href="/kenya/job/7">Unclosed <a href="/kenya/job/8">Next one</a>
    """
    fallback = '<a href="/jobs/1">Only here</a><a href="https://a.com/jobs/own">Own page</a>'
    df = pages(spark, html, fallback, "<p>none</p>", None)
    patterns = ["/kenya/job/", "/job/", "/jobs/"]
    got = links.page_links(df, patterns, F.lit("https://fuzu.com"), min_title_length=4)
    assert [tuple(r) for r in got.orderBy("page_id", "pos").select("page_id", "href", "job_title").collect()] == [
        (0, "/kenya/job/1?a=1&b=2", "DataEngineer"),
        (0, "/kenya/job/4", "Café RD"),
        (0, "/kenya/job/7", "Unclosed"),
        (0, "/kenya/job/8", "Next one"),
        (1, "/jobs/1", "Only here"),
        (1, "https://a.com/jobs/own", "Own page"),
    ]
    urls = {r["posting_url"] for r in got.collect()}
    assert "https://fuzu.com/kenya/job/4" in urls and "https://a.com/jobs/own" in urls
    own = pages(spark, fallback, url="https://a.com/jobs/own")
    assert links.page_links(own, patterns).count() == 1
    assert links.page_links(own, patterns, skip_own_url=False).count() == 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "InPandas" not in plan


def test_payload_shapes(spark):
    item = {"title": "T", "url": "/1"}
    bodies = [
        [item, 5, "x", None, [item]],
        {"jobs": [], "results": [item, item]},
        {"jobs": "text", "results": [item]},
        {"jobs": 0, "results": None, "data": {}, "listings": False, "items": [item]},
        {"other": [item]},
        "text",
        [{"title": "", "name": "N", "url": "https://b.org/2"}, {"title": "T"}, {"url": "/x"}],
    ]
    df = spark.createDataFrame(
        [(i, json.dumps(b)) for i, b in enumerate(bodies)] + [(98, "{broken"), (99, None)], "q int, body string")
    got = payloads.payload_fields(df, payloads.FUZU).orderBy("q", "item_pos").collect()
    assert [(r["q"], r["raw_title"], r["raw_url"]) for r in got] == [
        (0, "T", "https://fuzu.com/1"),
        (1, "T", "https://fuzu.com/1"), (1, "T", "https://fuzu.com/1"),
        (3, "T", "https://fuzu.com/1"),
        (6, "N", "https://b.org/2"),
    ]


def test_empty_json_values_are_skipped_but_strings_are_not(spark):
    body = json.dumps([{"title": 0, "name": "0", "url": "/1"}, {"title": 1.5, "url": "/1"}, {"title": False, "name": [], "job_title": {"a": 1}, "url": "/1"}])
    df = spark.createDataFrame([(body,)], "body string")
    got = payloads.payload_fields(df, payloads.FUZU).orderBy("item_pos").collect()
    assert [r["raw_title"] for r in got] == ["0", "1.5", '{"a":1}']


def test_payload_postings(spark):
    body = json.dumps({"data": [
        {"position": "Data  Engineer ", "job_url": "/l/1", "employer": "R&D", "city": "Nairobi County",
         "summary": "Pay KES 10 - KES 20 " + "x" * 600, "published_at": "2 days ago"},
        {"title": "A", "url": "/l/2", "salary_range": "10k", "created_at": "2024-01-15"},
    ]})
    df = spark.createDataFrame([("q1", body)], "query string, body string")
    one, two = payloads.payload_postings(df, payloads.BRIGHTERMONDAY, AS_OF).orderBy("item_pos").collect()
    assert (one["query"], one["job_title"], one["company"], one["location"], one["salary_text"]) == (
        "q1", "Data Engineer", "RD", "Nairobi", "KES 10 - KES 20")
    assert one["posting_url"] == "https://www.brightermonday.co.ke/l/1"
    assert len(one["description_snippet"]) == 500 and one["posted_date"] == AS_OF - timedelta(days=2)
    assert (two["company"], two["location"], two["salary_text"], two["description_snippet"]) == ("N/A", "Nairobi", "10k", None)
    assert two["posted_date"] == datetime(2024, 1, 15) and two["metadata"] == {"source": "api_intercept"}
    fuzu = payloads.payload_postings(
        spark.createDataFrame([(json.dumps([{"title": "A", "url": "/2", "salary": "10k"}]),)], "body string"), payloads.FUZU, AS_OF).first()
    assert (fuzu["location"], fuzu["salary_text"], fuzu["posted_date"]) == ("Kenya", None, None)


CARD_PAGE = """
<ul>
 <li class="job-list-li new"><ul>
   <li class="job-logo"><a href="/c"><img src=x alt="Acme Ltd logo"></a></li>
   <li class="mag-b"><h2><a href="/job/1">Data Engineer at Large at Other</a></h2></li>
   <li class="job-desc">Pay: KES 5,000 <b>now</b></li>
   <li id="job-date">2 days ago <span>x</span><a href="/jobs-location/mombasa">Mombasa, Kenya &amp; more</a></li>
 </ul></li>
 <li class="job-list-li"><h2><a href="/job/2">Clerk at Small Co</a></h2></li>
 <li class="job-list-li"><h2><a>No link</a></h2></li>
 <li class="other"><h2><a href="/job/3">Not a card</a></h2></li>
</ul>"""


def test_container_cards(spark):
    df = pages(spark, CARD_PAGE, "<p>captcha</p>", "", url="https://www.myjobmag.co.ke/p")
    one, two = cards.page_cards(df, cards.MYJOBMAG, AS_OF).orderBy("pos").collect()
    assert (one["job_title"], one["company"], one["location"]) == ("Data Engineer at Large", "Acme Ltd", "Mombasa, Kenya more")
    assert (one["salary_text"], one["description_snippet"]) == ("KES 5,000", "Pay: KES 5,000now")
    assert one["posting_url"] == "https://www.myjobmag.co.ke/job/1"
    assert one["posted_date"] == AS_OF - timedelta(days=2)
    assert one["metadata"] == {"scraper_version": "2.0", "page_url": "https://www.myjobmag.co.ke/p"}
    assert (two["job_title"], two["company"], two["location"], two["salary_text"], two["description_snippet"]) == (
        "Clerk", "Small Co", "Nairobi", None, None)
    assert two["posted_date"] == AS_OF


def test_link_cards(spark):
    html = """
    <article><p><a href="/listings/1">Data Engineer</a></p><a href="/company/x">Acme</a> Kisumu or Mombasa KES 1,000</article>
    <section><div><a href="/listings/2">Clerk</a></div></section>
    <div><span><a href="/listings/2">Again</a></span></div>"""
    got = cards.page_cards(pages(spark, html), cards.BRIGHTERMONDAY_LINKS, AS_OF).orderBy("pos").collect()
    assert [(r["job_title"], r["company"], r["location"], r["salary_text"]) for r in got] == [
        ("Data Engineer", "Acme", "Mombasa", "KES 1,000"),
        # No block around it is long enough.
        ("Clerk", "N/A", "Nairobi", None),
    ]
    fuzu = '<div><a href="/kenya/job/1">Data Engineer</a><i>Ksh 2,000 - Ksh 3,000</i></div><div><a href="/kenya/job/2">abc</a> long enough text</div>'
    got = cards.page_cards(pages(spark, fuzu), cards.FUZU_LINKS, AS_OF).collect()
    assert [(r["job_title"], r["location"], r["company"], r["salary_text"], r["posting_url"]) for r in got] == [
        ("Data Engineer", "Kenya", "N/A", "Ksh 2,000 - Ksh 3,000", "https://fuzu.com/kenya/job/1")]


def test_links_sharing_a_block_do_not_repeat_its_text(spark):
    html = "<div>" + "".join(f'<a href="/job/{i}">Title {i}</a>' for i in range(50)) + "Ksh 9</div>"
    raw = cards.raw_cards(pages(spark, html), cards.FUZU_LINKS).first()
    assert len(raw["cards"]) == 50 and len(raw["blocks"]) == 1
    got = cards.page_cards(pages(spark, html), cards.FUZU_LINKS, AS_OF)
    assert got.where("salary_text = 'Ksh 9'").count() == 50


HARD_PAGE = """<p title="<a href='/job/no'>x</a>">t</p><div><a href="/job/a>b">First</a></div> <a title="x href=/job/fake" href="/job/real">Sec <b title="q>r">ond</b></a>
<a title="a>b" href='/job/c'>Third &#000000065; Caf&eacute</a><a class=x href=/job/d?x=1&amp;y=2>Fourth</a><A HREF = "/job/e" href="/job/f">Fifth</A>
<script>var s="<a href='/job/s'>no</a>";</script><a data-href="/job/z" href="/job/y">Sixth</a><!-- <a href="/job/h">hidden</a>"""


def test_links_and_cards_agree_on_hard_markup(spark):
    from rolelake.sources.links import page_links

    pages = spark.createDataFrame([(1, "http://x.y/", HARD_PAGE)], "page_id long, url string, html string")
    got = [(r["href"], r["job_title"]) for r in page_links(pages, ["/job/"]).orderBy("pos").collect()]
    assert got == [
        ("/job/a>b", "First"), ("/job/real", "Second"), ("/job/c", "Third A Café"), ("/job/d?x=1&y=2", "Fourth"), ("/job/e", "Fifth"), ("/job/y", "Sixth")
    ]
    raw = raw_hrefs(pages)
    assert raw == [href for href, _ in got]


def raw_hrefs(pages):
    from rolelake.sources.cards import LinkRules, raw_cards

    rules = LinkRules(source="s", base_url="http://x.y", patterns=["/job/"], climb=3, min_title_length=1, skip_own_url=True, block_tags=("div",), margin=5)
    return [c["href"] for c in raw_cards(pages, rules).first()["cards"]]


def test_cards_parse_in_a_session_started_elsewhere(tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from rolelake.sources.cards import LinkRules, raw_cards
rules = LinkRules(source="s", base_url="http://x.y", patterns=["/job/"], climb=3, min_title_length=1, skip_own_url=True, block_tags=("div",), margin=5)
pages = spark.createDataFrame([(1, "http://x.y/", "<a href=/job/1>Job</a>")], "page_id long, url string, html string")
print("CARDS", len(raw_cards(pages, rules).first()["cards"]))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "CARDS 1" in done.stdout, done.stderr[-1500:]


def test_markup_inside_attributes_ends_nothing(spark):
    hard = [
        '<a title="<!--" href="/job/1">First job</a><a href="/job/2">Second job</a>',
        '<div data-x="<script>"><a href="/job/3">Third job</a></div><p title="<style>">x</p><a href="/job/4">Fourth job</a>',
        """<script data-a="x>y">'<a href="/job/no">no</a>'</script><!-- <a href="/job/no">no</a> --><a data-q='"' href="/job/5">Fifth job</a>""",
        '<style>a > b {}</style ><a href="/job/6">Sixth <!-- "> --> job</a><script>never closed <a href="/job/no">no</a>',
    ]
    df = pages(spark, *hard)
    got = links.page_links(df, ["/job/"], F.lit("https://a.com"), min_title_length=1).orderBy("page_id", "pos").select("page_id", "href", "job_title").collect()
    assert [tuple(r)[:2] for r in got] == [(0, "/job/1"), (0, "/job/2"), (1, "/job/3"), (1, "/job/4"), (2, "/job/5"), (3, "/job/6")]
    rules = cards.LinkRules(source="Other", base_url="https://a.com", patterns=("/job/",), climb=1, min_title_length=1, skip_own_url=True)
    by_cards = cards.page_cards(df, rules, AS_OF).orderBy("page_id", "pos").select("page_id", "posting_url").collect()
    assert [(r["page_id"], f"https://a.com{r['href']}") for r in got] == [tuple(r) for r in by_cards]
