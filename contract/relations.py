"""Relations that the registered queries work on, derived from the given tables.

The same relations are written as SQL in :mod:`contract.oracle`.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rolelake.dictionaries import KeywordDictionary
from rolelake.functions.dates import timestamp_lit
from rolelake.operators.durable import cut_lineage
from rolelake.operators.matching import with_keywords
from rolelake.plans.records import keyword_count
from rolelake.sources.tables import read_table

AS_OF = datetime(2024, 2, 1)
EVENTS_AS_OF = datetime(2024, 1, 30, 12)

# Words that do occur in the documents, with invented weights, categories and pairings.
SAMPLE = KeywordDictionary.of(
    keywords=(
        "The Phrase", "Of", "Listing", "Und", "La", "Que", "Éa", "From", "Rewh", "Thatin",
        "License", "Token", "Mit",
    ),
    variants={
        "The Phrase": ("of the", "of that", "in the"),
        "Listing": ("of, the", "the, and"),
        "Und": ("und", "von der"),
        "La": ("la", "de la", "la de"),
        "Que": ("que", "qué"),
        "Éa": ("é",),
        "License": ("license", "apache license", "all rights reserved"),
    },
    weights={"The Phrase": 2, "Listing": 3, "Und": 2.5, "La": 1.5, "Éa": 4, "Rewh": 5, "License": 4},
    categories={
        "The Phrase": "english", "Of": "english", "From": "english", "La": "romance",
        "Que": "romance", "License": "legal",
    },
    pairings={
        "Of": ("From", "Rewh"), "La": ("Que", "Éa"), "Rewh": ("Thatin",),
        "License": ("Mit", "Token", "Legal Review"),
    },
)

# Keywords whose variants are single words, so that SQL can find their positions.
SINGLE_WORDS = KeywordDictionary.of(
    keywords=("From", "Que", "Rewh", "Thatin", "Token", "Mit", "License"),
    variants={"Que": ("que", "qué"), "License": ("license", "copyright")},
)

# Matched as written, capitals included.
CASED = KeywordDictionary.of(
    keywords=("The", "Of", "Que", "und", "In The", "License"),
    variants={"In The": ("in the",)},
    case_sensitive=True,
)


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", spread)


def stamp(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def joined(c: Column | str) -> Column:
    return F.array_join(c, "|")


def raw_postings(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Postings from documents: the first line is the title, the whole text the description."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents", spread).select(
        doc.alias("id"),
        doc.alias("seq"),
        F.substring_index("text", "\n", 1).alias("job_title"),
        F.when(doc % 11 != 0, F.concat(F.lit("co"), (doc % 37).cast("string"))).alias("company"),
        F.concat(F.lit("place "), F.col("lang")).alias("location"),
        F.lit(None).cast("string").alias("salary_text"),
        F.lit(None).cast("string").alias("description_snippet"),
        F.col("text").alias("full_description"),
        F.concat(
            F.lit("https://"), "source", F.lit(".example.com/"), (doc % 700).cast("string")
        ).alias("posting_url"),
        "source",
        F.to_date(days_before(AS_OF, doc % 90)).alias("posted_date"),
        days_before(AS_OF, doc % 200).alias("scrape_timestamp"),
        (doc % 7 != 3).alias("is_active"),
        (doc % 5 == 0).alias("is_notified"),
        F.create_map(F.lit("lang"), F.col("lang")).alias("metadata"),
    )


def days_before(moment: datetime, days: Column) -> Column:
    return timestamp_lit(moment) - F.make_dt_interval(days.cast("int"))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled postings, shaped like the stored table."""
    return with_keywords(
        raw_postings(spark, sf_dir, spread=True), SAMPLE, ["job_title", "full_description"]
    ).withColumn("keyword_match_count", keyword_count())


def stored_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled postings without their full texts, written once durably.

    For queries that filter on keywords, sort, or use their input twice: as with the stored
    table, texts are matched before, not while such a query runs.
    """
    return cut_lineage(postings(spark, sf_dir).drop("full_description"))


def event_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings from events: many rows with times of day, and no text to match."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("job "), F.col("event_id").cast("string")).alias("job_title"),
        F.concat(F.lit("co"), F.col("user_id").cast("string")).alias("company"),
        F.lit("Kenya").alias("location"),
        F.lit(None).cast("string").alias("salary_text"),
        F.concat(F.lit("https://example.com/"), F.col("event_id").cast("string")).alias("posting_url"),
        F.to_date("ts").alias("posted_date"),
        F.lit(None).cast("string").alias("description_snippet"),
        F.col("event_type").alias("source"),
        F.slice(F.array(*map(F.lit, "abc")), F.lit(1), k % 4).alias("keywords_matched"),
        (k % 4).alias("keyword_match_count"),
        F.col("ts").alias("scrape_timestamp"),
        (F.col("user_id") % 7 != 0).alias("is_active"),
        (F.col("event_id") % 3 == 0).alias("is_notified"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON payload per event, in six shapes."""
    n, kind = F.col("event_id").cast("string"), F.col("event_type")
    user, k = F.col("user_id").cast("string"), F.get_json_object("props", "$.k")

    def body(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    shapes = [
        body('[{"title":"', kind, '","url":"/e/', n, '","company":"u', user, '"}]'),
        body('{"jobs":[],"results":[{"name":"', kind, '","link":"https://x.org/', n, '","salary":', k, "}]}"),
        body('{"data":[{"title":"","position":"', kind, '","job_url":"/p/', n, '","city":"c', user, '"},5,{"title":"no url"}]}'),
        body("{broken ", n),
        body('{"listings":"text","items":[{"title":"t","url":"/never/', n, '"}]}'),
        body('{"items":[{"title":', k, ',"url":"/n/', n, '","salary_text":"","salary_range":"', k, 'k"}]}'),
    ]
    chosen = F
    for i, shape in enumerate(shapes):
        chosen = chosen.when(F.col("event_id") % 6 == i, shape)
    return table(spark, sf_dir, "events", spread=True).select("event_id", chosen.alias("body"))


def pick(key: Column | str, values: list[Column | str | None]) -> Column:
    """The value number ``key`` modulo the list's length."""
    number = F.col(key) if isinstance(key, str) else key
    chosen = F
    for i, value in enumerate(values):
        cell = value if isinstance(value, Column) else F.lit(value).cast("string")
        chosen = chosen.when(number % len(values) == i, cell)
    return chosen


def with_faults(rows: DataFrame) -> DataFrame:
    """Postings some of which lack a title, URL or source, or have a bad URL."""
    return rows.withColumns(
        {
            "job_title": F.when(F.col("id") % 19 != 0, F.col("job_title")),
            "posting_url": F.when(F.col("id") % 17 == 0, F.concat(F.lit("not a url "), F.col("id").cast("string")))
            .when(F.col("id") % 13 != 0, F.col("posting_url")),
            "source": F.when(F.col("id") % 23 != 0, F.col("source")),
        }
    )


TEST_SOURCES = tuple(f"src{i}" for i in range(0, 15))
