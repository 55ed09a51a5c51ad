import random
import re

import pytest
from pyspark.sql import functions as F

from rolelake.dictionaries import BUILT_IN_KEYWORDS, CONFIGURED_KEYWORDS, KeywordDictionary
from rolelake.operators import matching, matching_join

BUILT_IN = KeywordDictionary.of()


def brute_force_spans(dictionary, keyword, text):
    """Occurrences by trying every variant at every position."""
    def fits(variant, at):
        end = at + len(variant)
        piece = text[at:end]
        same = piece == variant if dictionary.case_sensitive else piece.lower() == variant.lower()
        return same and re.compile(r"\b").match(text, at) and re.compile(r"\b").match(text, end)

    spans, at = [], 0
    while at <= len(text):
        variant = next((v for v in dictionary.variants[keyword] if fits(v, at)), None)
        if variant:
            spans.append((at, at + len(variant)))
            at += len(variant)
        else:
            at += 1
    return spans


def brute_force_match(dictionary, text):
    return sorted(k for k in dictionary.variants if brute_force_spans(dictionary, k, text))


def random_texts(dictionary, n, seed):
    rng = random.Random(seed)
    variants = sorted({v for forms in dictionary.variants.values() for v in forms})
    pieces = variants + [w for v in variants for w in re.findall(r"\w+", v)] + ["é", "x", "_", "1"]
    gaps = [" "] * 6 + ["  ", "", ", ", ".", "-", "\n", "/"]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 25)):
            piece = rng.choice(pieces)
            parts.append(rng.choice([piece, piece.upper(), piece.title()]))
            parts.append(rng.choice(gaps))
        texts.append("".join(parts))
    return texts


def matched(spark, dictionary, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").coalesce(2)
    rows = df.select("id", matching.match_keywords("t", dictionary).alias("k")).orderBy("id").collect()
    return [r["k"] for r in rows]


def test_dictionary_sizes():
    assert len(BUILT_IN_KEYWORDS) == 89
    assert set(CONFIGURED_KEYWORDS) - set(BUILT_IN_KEYWORDS) == {"Insight", "Apprentice"}
    assert len({v.lower() for forms in BUILT_IN.variants.values() for v in forms}) == 178


def test_match_literals(spark):
    cases = {
        "Looking for a Data Engineer with Python, PostgreSQL, and AWS experience": [
            "AWS", "Data Engineer", "PostgreSQL", "Python",
        ],
        "jr. analyst": ["Analyst", "Data Analyst"],
        "jr.x": ["Junior"],
        "data  engineer": [],
        "b.i.x": ["Business Intelligence"],
        "b.i. x": [],
        "sql server 2019": ["MSSQL", "SQL", "SQL Server"],
        "ésql": [],
        "extract, transform": ["ETL"],
        "": [],
        None: [],
        "Kafka ſql": ["Kafka", "SQL"],
    }
    assert matched(spark, BUILT_IN, list(cases)) == list(cases.values())


@pytest.mark.parametrize("case_sensitive", [False, True])
def test_match_equals_brute_force(spark, case_sensitive):
    dictionary = KeywordDictionary.of(case_sensitive=case_sensitive)
    texts = random_texts(dictionary, 300, seed=1)
    assert matched(spark, dictionary, texts) == [brute_force_match(dictionary, t) for t in texts]


def test_match_odd_dictionary_equals_brute_force(spark):
    dictionary = KeywordDictionary.of(
        ["C++", ".NET", "C", "C++ Builder", "a-b-c-d", "a-b", "é", "--", "x.y."], variants={}
    )
    texts = random_texts(dictionary, 300, seed=2)
    assert matched(spark, dictionary, texts) == [brute_force_match(dictionary, t) for t in texts]


@pytest.mark.parametrize("broadcast_rows", [100_000, 5])
def test_join_form_equals_inlined_form(spark, broadcast_rows):
    odd = KeywordDictionary.of(
        ["C++", ".NET", "C", "C++ Builder", "a-b-c-d", "a-b", "é", "--", "x.y."], variants={}
    )
    for dictionary in (BUILT_IN, odd):
        texts = random_texts(dictionary, 200, seed=3) + [None, ""]
        df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
        joined = matching_join.keywords_by_join(
            df, "id", "t", dictionary.variant_table(spark), broadcast_rows=broadcast_rows
        )
        got = {r["id"]: r["keywords_matched"] for r in joined.collect()}
        assert got == dict(enumerate(matched(spark, dictionary, texts)))


def test_frequency_and_context_equal_brute_force(spark):
    texts = random_texts(BUILT_IN, 120, seed=4) + [
        "apache airflow and airflow", "\U0001f600" * 60 + " sql " + "\U0001f600" * 60, "sql", "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").coalesce(2)
    df = df.withColumn("keywords_matched", matching.match_keywords("t", BUILT_IN))
    counts = matching.keyword_frequency(df, BUILT_IN, "t").collect()
    expected_counts, expected_contexts = {}, {}
    for i, text in enumerate(texts):
        for keyword in BUILT_IN.variants:
            spans = brute_force_spans(BUILT_IN, keyword, text)
            if spans:
                expected_counts[i, keyword] = len(spans)
            for n, (start, end) in enumerate(spans):
                expected_contexts[i, keyword, n] = text[max(0, start - 7): end + 7].strip()
    assert {(r["id"], r["keyword"]): r["occurrences"] for r in counts} == expected_counts
    contexts = matching.keyword_context(df, BUILT_IN, "t", context_chars=7).collect()
    assert {(r["id"], r["keyword"], r["occurrence"]): r["context"] for r in contexts} == expected_contexts

    regexes = matching.regex_table(BUILT_IN, spark)
    counts = matching_join.frequency_by_join(df, regexes, "id", "t").collect()
    assert {(r["id"], r["keyword"]): r["occurrences"] for r in counts} == expected_counts
    contexts = matching_join.context_by_join(df, regexes, "id", "t", context_chars=7).collect()
    assert {(r["id"], r["keyword"], r["occurrence"]): r["context"] for r in contexts} == expected_contexts


def test_occurrences_with_thousands_of_variants(spark):
    """Variants that overlap themselves and others, in a dictionary of 2,500 keywords, against brute force."""
    rng = random.Random(5)
    words = ["a", "b", "go", "x1", "é", "\U0001f600"]
    odd = {
        "Go go": ["go go", "go", "go go go"], "AB": ["a-b-a", "b-a", "a-b"], "Long first": ["go x1 go", "x1"], "Marks": ["--", "a--a", "b -- b"],
    }
    many = {f"Skill {i}": [f"skill{i}", f"skill {i}"] for i in range(2500)}
    dictionary = KeywordDictionary.of([*odd, *many], {**odd, **many}, {}, {}, {})
    assert dictionary.n_variants > 2000
    texts = []
    for _ in range(60):
        pick = [rng.choice([*words, *words, "GO", f"skill{rng.randrange(2600)}", f"Skill {rng.randrange(2600)}"]) for _ in range(rng.randint(0, 40))]
        texts.append("".join(p + rng.choice([" ", " ", "-", "--", "  ", " -- "]) for p in pick))
    df = spark.createDataFrame([*enumerate(texts), (90, None), (91, "")], "id int, t string").coalesce(2)
    labelled = df.withColumn("keywords_matched", matching.match_keywords(F.coalesce("t", F.lit("")), dictionary))
    plain = [*odd, *(k for k in many if any(k[6:] in t for t in texts))]
    counts, contexts = {}, {}
    for i, text in enumerate(texts):
        for keyword in plain:
            spans = brute_force_spans(dictionary, keyword, text)
            if spans:
                counts[i, keyword] = len(spans)
            for n, (start, end) in enumerate(spans):
                contexts[i, keyword, n] = text[max(0, start - 4): end + 4].strip()
    assert any(k == "Go go" and n > 2 for (_, k), n in counts.items())
    got = matching.keyword_frequency(labelled, dictionary, "t").collect()
    assert {(r["id"], r["keyword"]): r["occurrences"] for r in got} == counts and len(got) == len(counts)
    got = matching.keyword_context(labelled, dictionary, "t", context_chars=4).collect()
    assert {(r["id"], r["keyword"], r["occurrence"]): r["context"] for r in got} == contexts and len(got) == len(contexts)


def test_occurrences_in_a_text_of_many_starts(spark):
    df = spark.createDataFrame([(1, "go " * 30_000, ["Go", "SQL"])], "id int, t string, keywords_matched array<string>")
    dictionary = KeywordDictionary.of(["Go", "SQL"], {"Go": ["go go", "go"]}, {}, {}, {})
    got = matching.keyword_frequency(df, dictionary, "t").collect()
    # A keyword that is matched elsewhere has no occurrence here.
    assert {r["keyword"]: r["occurrences"] for r in got} == {"Go": 15_000, "SQL": 0}
    assert matching.keyword_context(df, dictionary, "t").count() == 15_000


def test_join_form_explodes_only_what_may_match(spark):
    texts = [(i, "some words that stand in no dictionary at all") for i in range(50)] + [(50, "needs sql here"), (51, None)]
    df = spark.createDataFrame(texts, "id int, t string")
    variants = BUILT_IN.variant_table(spark)
    assert matching_join.keyword_pairs(df, "id", "t", variants).collect() == [(50, "SQL")]
    assert matching_join.keywords_by_join(df, "id", "t", variants).count() == 52
    none = variants.where("false")
    assert {tuple(r["keywords_matched"]) for r in matching_join.keywords_by_join(df, "id", "t", none).collect()} == {()}


POSTINGS = [
    (1, "Senior Data Engineer", None, "Python and SQL on AWS with Docker"),
    (2, "Gardener", "", "Loves plants"),
    (3, "Data", None, "Engineer"),
]


def test_labelling(spark):
    df = spark.createDataFrame(
        POSTINGS, "id int, job_title string, description_snippet string, full_description string"
    )
    rows = {r["id"]: r for r in matching.with_keywords(df, BUILT_IN).collect()}
    assert rows[1]["keywords_matched"] == ["AWS", "Data Engineer", "Docker", "Python", "SQL"]
    assert rows[1]["keyword_count"] == 5
    assert rows[1]["keyword_score"] == 2.5 + 7.5 + 2.5 + 3 + 3
    assert (rows[2]["keywords_matched"], rows[2]["keyword_count"], rows[2]["keyword_score"]) == ([], 0, 0.0)
    # A match may not span the two blanks that an empty field leaves between two fields.
    assert rows[3]["keywords_matched"] == []
    spanning = matching.with_keywords(df, BUILT_IN, ["job_title", "full_description"])
    assert [r["keywords_matched"] for r in spanning.where("id = 3").collect()] == [["Data Engineer"]]


def test_categories_and_suggestions_in_both_forms(spark):
    df = spark.createDataFrame(
        [(1, ["AWS", "Data Engineer", "Docker", "Python", "SQL"]), (2, []), (3, ["Pandas"])],
        "id int, keywords_matched array<string>",
    )
    got = {
        r["id"]: (r["c"], r["s"])
        for r in df.select(
            "id",
            matching.skill_categories("keywords_matched", BUILT_IN).alias("c"),
            matching.suggest_missing_skills("keywords_matched", BUILT_IN).alias("s"),
        ).collect()
    }
    assert got[1] == (
        {"languages": ["Python", "SQL"], "cloud": ["AWS"], "tools": ["Docker"], "other": ["Data Engineer"]},
        ["CI/CD", "FastAPI", "Flask", "Kubernetes", "MySQL", "NumPy", "Pandas", "PostgreSQL"],
    )
    assert got[2] == ({}, [])
    assert got[3] == ({"frameworks": ["Pandas"]}, ["NumPy", "Python"])

    pairs = df.select("id", F.explode("keywords_matched").alias("keyword"))
    by_join = matching_join.categorize_pairs(pairs, BUILT_IN.category_table(spark), "id").collect()
    assert {(r["id"], r["category"]): r["keywords"] for r in by_join} == {
        (i, c): k for i, (cats, _) in got.items() for c, k in cats.items()
    }
    suggested = matching_join.suggest_for_pairs(pairs, BUILT_IN.pairing_table(spark), "id").collect()
    assert sorted((r["id"], r["suggested"]) for r in suggested) == [
        (i, s) for i, (_, skills) in sorted(got.items()) for s in skills
    ]
    scored = matching_join.score_pairs(
        pairs.withColumn("in_title", F.col("keyword") == "Data Engineer"), BUILT_IN.weight_table(spark), "id"
    ).collect()
    assert {r["id"]: r["keyword_score"] for r in scored} == {1: 18.5, 3: 1.0}


def test_labelling_needs_no_shuffle(spark):
    df = spark.createDataFrame(
        POSTINGS, "id int, job_title string, description_snippet string, full_description string"
    )
    plan = matching.with_keywords(df, BUILT_IN)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "EvalPython" not in plan and "InPandas" not in plan


def test_dictionary_of_thousands_of_variants(spark):
    from pyspark.sql import functions as F
    from rolelake.dictionaries import KeywordDictionary
    from rolelake.operators.matching import match_keywords

    words = KeywordDictionary.of([f"skill{i}" for i in range(5000)], {}, {}, {}, {})
    texts = spark.createDataFrame([("needs skill7 and Skill4999, not skill5000",), (None,)], "text string")
    got = texts.select(match_keywords(F.coalesce("text", F.lit("")), words).alias("found")).collect()
    assert [r["found"] for r in got] == [["skill4999", "skill7"], []]
