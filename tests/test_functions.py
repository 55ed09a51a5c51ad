import random
import unicodedata
from datetime import datetime, timedelta
from html import unescape
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from rolelake.functions import dates, html, text, urls

AS_OF = datetime(2024, 2, 1, 12, 30)


@pytest.mark.parametrize(
    "given, expected",
    [
        ("  This   has    extra   spaces  ", "This has extra spaces"),
        ("  This   is  some\n\nmessy    text!!!  ", "This is some messy text!!!"),
        ("A & B", "A  B"),
        ("C++", "C"),
        ("R&D", "RD"),
        ("“quoted” text here", "quoted text here"),
        ("@@", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_clean_text(one, given, expected):
    assert one(text.clean_text, given) == expected


def test_clean_text_on_random_unicode(spark):
    import re

    rng = random.Random(7)
    # Letters that both sides' Unicode tables know.
    known = unicodedata.ucd_3_2_0.category
    alphabet = [chr(c) for c in range(1, 0x3100) if known(chr(c)) not in ("Cn", "Cs")]
    texts = ["".join(rng.choices(alphabet + [" ", "\n", "a", "-"] * 200, k=30)) for _ in range(500)]

    def expected(t):
        joined = " ".join(t.split())
        keep = set(".,!?;:()-'\"/ ")
        return "".join(c for c in joined if c in keep or c == "_" or c.isalnum() or re.match(r"\w", c)).strip()

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(text.clean_text("t")).collect()]
    assert got == [expected(t) for t in texts]


def test_truncate_text(one):
    assert one(text.truncate_text, "x" * 500) == "x" * 500
    assert one(text.truncate_text, "x" * 501) == "x" * 497 + "..."
    assert one(lambda c: text.truncate_text(c, 5), "\U0001f600" * 6) == "\U0001f600" * 2 + "..."
    assert one(text.truncate_text, None) is None


@pytest.mark.parametrize(
    "given, expected",
    [
        ("Salary: KES 80,000 - KES 120,000 per month", "KES 80,000 - KES 120,000"),
        ("Offering Ksh 50,000 to Ksh 75,000", "Ksh 50,000"),
        ("KES 80,000 - 120,000", "KES 80,000"),
        ("pay 10,000 - 20,000 kes", "10,000 - 20,000 kes"),
        ("pay ksh.5,000 - KSH. 6,000", "ksh.5,000 - KSH. 6,000"),
        ("30,000-40,000  per  month", "30,000-40,000 per month"),
        ("Ksh 1 then KES 2", "KES 2"),
        ("1 - 2 - 3 KES", "2 - 3 KES"),
        ("Competitive salary package", None),
        (None, None),
    ],
)
def test_extract_salary(one, given, expected):
    assert one(text.extract_salary, given) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        (None, "Kenya"),
        ("", "Kenya"),
        ("Westlands, Nairobi County", "Nairobi"),
        ("NAIROBI,  KENYA", "Nairobi"),
        ("remote - kenya", "Remote (Kenya)"),
        ("anywhere in Kenya", "Remote (Kenya)"),
        ("Thika", "Thika"),
        ("@@", ""),
    ],
)
def test_normalize_location(one, given, expected):
    assert one(text.normalize_location, given) == expected


def test_first_city(one):
    assert one(text.first_city, "kisumu or MOMBASA") == "Mombasa"
    assert one(text.first_city, "elsewhere") == "Nairobi"


@pytest.mark.parametrize(
    "given, title, company",
    [
        ("Officer at Large at Acme", "Officer at Large", "Acme"),
        ("Officer", "Officer", None),
        ("x at at y", "x at", "y"),
    ],
)
def test_split_title(one, given, title, company):
    assert one(lambda c: text.split_title(c)[0], given) == title
    assert one(lambda c: text.split_title(c)[1], given) == company


@pytest.mark.parametrize(
    "alt, rest, expected",
    [
        ("Acme Ltd logo", "Other", "Acme Ltd"),
        ("Acme Logo", None, "Acme"),
        (None, "Other", "Other"),
        ("", None, "N/A"),
        (" ", "Other", ""),
    ],
)
def test_organisation(one, alt, rest, expected):
    assert one(text.organisation, alt, rest) == expected


def test_first_filled(one):
    assert one(lambda a, b: text.first_filled(a, b, default="d"), "", "x") == "x"
    assert one(lambda a, b: text.first_filled(a, b, default="d"), "", None) == "d"


@pytest.mark.parametrize(
    "given, expected",
    [
        ("Today", AS_OF),
        ("just now", AS_OF),
        ("posted yesterday", AS_OF - timedelta(days=1)),
        ("2 days ago", AS_OF - timedelta(days=2)),
        ("3 weeks ago", AS_OF - timedelta(weeks=3)),
        ("2 months ago", AS_OF - timedelta(days=60)),
        ("5 hours ago", AS_OF - timedelta(hours=5)),
        ("2 weeks 3 days ago", AS_OF - timedelta(days=3)),
        ("30+ days ago", None),
        ("a day ago", None),
        ("10 minutes ago", None),
        ("999999999999 days", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_relative_date(one, given, expected):
    assert one(lambda c: dates.parse_relative_date(c, AS_OF), given) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("2024-01-15", datetime(2024, 1, 15)),
        ("5/1/2024", datetime(2024, 1, 5)),
        ("15-1-2024", datetime(2024, 1, 15)),
        ("january 5, 2024", datetime(2024, 1, 5)),
        ("5  March 2024", datetime(2024, 3, 5)),
        ("Jan 5, 2024", datetime(2024, 1, 5)),
        ("5 JAN 2024", datetime(2024, 1, 5)),
        ("2024-01-15T10:00:00Z", None),
        ("31/02/2024", None),
        ("29/02/2023", None),
        ("1/1/24", None),
        ("Sept 5, 2024", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_absolute_date(one, given, expected):
    assert one(dates.parse_absolute_date, given) == expected


def test_parse_date_order_and_default(one):
    assert one(lambda c: dates.parse_date(c, AS_OF), "2024-01-15") == datetime(2024, 1, 15)
    assert one(lambda c: dates.parse_date(c, AS_OF), "nothing") is None
    assert one(lambda c: dates.parse_date(c, AS_OF, default=AS_OF), "nothing") == AS_OF


@pytest.mark.parametrize(
    "given, expected",
    [
        ("https://www.example.com/job/123", True),
        ("http://example.com", True),
        ("https://a.com/x y", True),
        ("  https://a.com", True),
        ("not-a-url", False),
        ("http://", False),
        ("http://[::1", False),
        ("1http://a.com", False),
        ("", False),
        (None, False),
    ],
)
def test_is_valid_url(one, given, expected):
    assert one(urls.is_valid_url, given) is expected


def test_extract_domain(one):
    assert one(urls.extract_domain, "https://u@a.com:80/x?y") == "u@a.com:80"
    assert one(urls.extract_domain, "//a.com/x") == "a.com"
    assert one(urls.extract_domain, "a.com/x") == ""
    assert one(urls.extract_domain, None) == ""


def test_make_absolute_url_equals_the_standard_library(spark):
    bases = ["https://a.com", "https://a.com/", "https://a.com/b/c", "https://a.com/b/c/?q=1#f"]
    relatives = [
        "", "/x", "x", "x/y?z=1", "../x", "../../../x", "./x", "/a/./b/../c", "//b.org/p", "?q=2",
        "#top", "http://b.org/x", "mailto:a@b", "x//y", "/x//y", "..", ".", "/a/..", "d/", "x#f?g",
    ]
    rows = [(b, r) for b in bases for r in relatives]
    df = spark.createDataFrame(rows, "b string, r string")
    got = [r[0] for r in df.select(urls.make_absolute_url("b", "r")).collect()]
    assert got == [urljoin(b, r) for b, r in rows]


@pytest.mark.parametrize(
    "given",
    ["a &amp; b", "&lt;x&gt; &quot;", "caf&eacute; &#233; &#xE9; &#128512;", "no refs", "&bogus; &amp", "&NotEqualTilde;"],
)
def test_decode_references(one, given):
    expected = unescape(given)
    assert one(html.decode_references, given) == expected


def test_visible_text(one):
    assert one(html.visible_text, " Data <b>Engineer </b>&amp; <i>x</i>") == "DataEngineer&x"
    assert one(html.visible_text, None) is None


def test_metadata_json(spark):
    df = spark.createDataFrame([({"a": "1"},), (None,)], "m map<string,string>")
    assert [r[0] for r in df.select(text.metadata_json(F.col("m"))).collect()] == ['{"a":"1"}', None]
