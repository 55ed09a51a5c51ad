"""Analytical views over the postings table.

Each function takes the postings and the reference time ``as_of``.  Where the table is
partitioned by ``scrape_date``, time limits are put on that column too, so that whole
partitions are skipped.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from rolelake.functions.dates import timestamp_lit
from rolelake.operators.durable import cut_lineage
from rolelake.operators.joins import rows_with_key_in
from rolelake.operators.matching import each_keyword
from rolelake.operators.ranking import best_first, global_rank

_DETAIL_COLUMNS = (
    "id", "job_title", "company", "location", "salary_text", "posting_url", "posted_date",
    "description_snippet", "source", "keywords_matched", "keyword_match_count", "scrape_timestamp",
)


def _since(jobs: DataFrame, as_of: datetime, span: timedelta, inclusive: bool = False) -> DataFrame:
    start = as_of - span
    stamp, limit = F.col("scrape_timestamp"), timestamp_lit(start)
    recent = jobs.where(stamp >= limit if inclusive else stamp > limit)
    if "scrape_date" in jobs.columns:
        recent = recent.where(F.col("scrape_date") >= F.lit(start.date()))
    return recent


def _count_if(condition: Column | str) -> Column:
    return F.count_if(F.col(condition) if isinstance(condition, str) else condition)


def _has_keywords() -> Column:
    return F.col("keyword_match_count") > 0


# -- selections -------------------------------------------------------------------------


def recent_matched(jobs: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Active postings with keywords from the last days, best first."""
    return (
        _since(jobs, as_of, timedelta(days=days))
        .where(F.col("is_active") & _has_keywords())
        .select(
            "id", "job_title", "company", "location", "salary_text", "posting_url", "source",
            "posted_date", "keywords_matched", "keyword_match_count", "scrape_timestamp",
            "is_notified",
        )
        .orderBy(*best_first())
    )


def new_with_keywords(
    jobs: DataFrame, as_of: datetime, hours: int = 24, min_keywords: int = 1
) -> DataFrame:
    """Active postings of the last hours with at least so many keywords, best first."""
    return (
        _since(jobs, as_of, timedelta(hours=hours), inclusive=True)
        .where(F.col("is_active") & (F.col("keyword_match_count") >= min_keywords))
        .select(*_DETAIL_COLUMNS)
        .orderBy(*best_first())
    )


def by_source(jobs: DataFrame, source: str, as_of: datetime, days: int = 7) -> DataFrame:
    """All postings of one source within the last days, newest first."""
    return (
        _since(jobs, as_of, timedelta(days=days), inclusive=True)
        .where(F.col("source") == source)
        .orderBy(F.desc_nulls_first("scrape_timestamp"), F.asc("id"))
    )


def unnotified(
    jobs: DataFrame, min_keywords: int = 1, notified: DataFrame | None = None
) -> DataFrame:
    """Active postings with keywords that were not reported yet, best first.

    ``notified`` is the append-only table of reported ids, if there is one.  Only ids are
    compared with it; the rows themselves are read again for the few ids that are left.
    """
    pending = jobs.where(
        F.col("is_active")
        & ~F.col("is_notified")
        & (F.col("keyword_match_count") >= min_keywords)
    ).select(*_DETAIL_COLUMNS)
    if notified is not None:
        fresh = cut_lineage(pending.select("id").join(notified.select("id"), "id", "left_anti"))
        pending = rows_with_key_in(pending, fresh, "id")
    return pending.orderBy(*best_first())


def unnotified_brief(jobs: DataFrame, notified: DataFrame | None = None) -> DataFrame:
    """The seven-column form of :func:`unnotified` with at least one keyword."""
    return unnotified(jobs, 1, notified).select(
        F.col("id").alias("job_id"), "job_title", "company", "location", "keywords_matched",
        "keyword_match_count", "posting_url",
    )


def keyword_search(jobs: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Active postings that have any of the keywords, best first."""
    wanted = F.array(*map(F.lit, keywords)).cast("array<string>")
    return (
        jobs.where(F.col("is_active") & F.arrays_overlap("keywords_matched", wanted))
        .orderBy(*best_first())
        .select(
            F.col("id").alias("job_id"), "job_title", "company", "keywords_matched", "posting_url"
        )
    )


# -- aggregates -------------------------------------------------------------------------


def daily_stats(jobs: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Volume per day and source."""
    return (
        _since(jobs, as_of, timedelta(days=days))
        .groupBy(F.to_date("scrape_timestamp").alias("scrape_date"), "source")
        .agg(
            F.count("*").alias("total_jobs"),
            _count_if(_has_keywords()).alias("matched_jobs"),
            F.avg("keyword_match_count").alias("avg_keywords"),
            _count_if("is_notified").alias("notified_jobs"),
        )
        .orderBy(F.desc("scrape_date"), "source")
    )


def trending_keywords(jobs: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Keywords by frequency, with the number of sources and the last time seen.

    Counted per keyword and source first: a hot keyword is already reduced to one row per
    source and task before it is brought together.
    """
    return (
        each_keyword(_since(jobs, as_of, timedelta(days=days)), "source", "scrape_timestamp")
        .groupBy("keyword", "source")
        .agg(F.count("*").alias("n"), F.max("scrape_timestamp").alias("latest"))
        .groupBy("keyword")
        .agg(
            F.sum("n").alias("frequency"),
            F.count("source").alias("sources_count"),
            F.max("latest").alias("last_seen"),
        )
        .orderBy(F.desc("frequency"), "keyword")
    )


def company_stats(
    jobs: DataFrame, as_of: datetime, days: int = 60, min_postings: int = 2
) -> DataFrame:
    """Hiring activity of companies with at least so many postings."""
    return (
        _since(jobs, as_of, timedelta(days=days))
        .where(F.col("company").isNotNull())
        .groupBy("company", "source")
        .agg(
            F.count("*").alias("n"),
            _count_if(_has_keywords()).alias("relevant"),
            F.min("scrape_timestamp").alias("earliest"),
            F.max("scrape_timestamp").alias("latest"),
        )
        .groupBy("company")
        .agg(
            F.sum("n").alias("total_postings"),
            F.sum("relevant").alias("relevant_postings"),
            F.min("earliest").alias("first_seen"),
            F.max("latest").alias("last_seen"),
            F.sort_array(F.collect_set("source")).alias("job_boards"),
        )
        .where(F.col("total_postings") >= min_postings)
        .orderBy(F.desc("total_postings"), "company")
    )


def global_stats(jobs: DataFrame, as_of: datetime) -> DataFrame:
    """One row of totals over the active postings."""
    def seen_within(**span: int) -> Column:
        return F.col("scrape_timestamp") >= timestamp_lit(as_of - timedelta(**span))

    return jobs.where("is_active").agg(
        F.count("*").alias("total_jobs"),
        F.countDistinct("source").alias("total_sources"),
        _count_if(_has_keywords()).alias("jobs_with_keywords"),
        _count_if(seen_within(hours=24)).alias("jobs_last_24h"),
        _count_if(seen_within(days=7)).alias("jobs_last_7d"),
        F.max("scrape_timestamp").alias("last_scrape"),
        F.avg("keyword_match_count").alias("avg_keyword_count"),
    )


def batch_analysis(labelled: DataFrame, k: int = 10) -> DataFrame:
    """One row about a labelled batch: scores, keyword counts, the k top keywords.

    Labelled rows are read once: every row counts under each of its keywords and once
    under null, whose group therefore carries the figures of the whole batch.
    """
    keywords = F.coalesce("keywords_matched", F.array().cast("array<string>"))
    per_keyword = (
        labelled.select(
            F.explode(F.array_append(keywords, F.lit(None).cast("string"))).alias("keyword"),
            "keyword_score",
            F.size(keywords).alias("_size"),
        )
        .groupBy("keyword")
        .agg(
            F.count("*").alias("n"),
            F.avg("keyword_score").alias("avg"),
            F.max("keyword_score").alias("max"),
            F.min("keyword_score").alias("min"),
            F.avg("_size").alias("avg_size"),
        )
    )
    entry = F.struct((-F.col("n")).alias("_order"), "keyword", "n")
    top = (
        per_keyword.where("keyword is not null")
        .orderBy(F.desc("n"), "keyword")
        .limit(k)
        .agg(F.sort_array(F.collect_list(entry)).alias("t"))
        .select(F.transform("t", lambda e: F.struct(e["keyword"].alias("keyword"), e["n"].alias("n"))))
    )

    def overall(name: str, default: Column) -> Column:
        return F.coalesce(F.max(F.when(F.col("keyword").isNull(), F.col(name))), default)

    return per_keyword.agg(
        overall("n", F.lit(0)).alias("total_jobs"),
        overall("avg", F.lit(0.0)).alias("avg_score"),
        overall("max", F.lit(0.0)).alias("max_score"),
        overall("min", F.lit(0.0)).alias("min_score"),
        F.count("keyword").alias("total_unique_keywords"),
        overall("avg_size", F.lit(0.0)).alias("avg_keywords_per_job"),
    ).select("*", top.scalar().alias("top_keywords"))


def digest_summary(jobs: DataFrame) -> DataFrame:
    """One row about a digest; all null values of a column count as one value."""
    def distinct_with_null(name: str) -> Column:
        has_null = F.max(F.col(name).isNull().cast("int"))
        return F.countDistinct(name) + F.coalesce(has_null, F.lit(0))

    n_keywords = F.coalesce(F.size("keywords_matched"), F.lit(0))
    return jobs.agg(
        F.count("*").alias("total_jobs"),
        F.coalesce(F.sum(n_keywords), F.lit(0)).alias("total_keywords"),
        distinct_with_null("company").alias("companies"),
        distinct_with_null("source").alias("sources"),
    )


def digest_rank(jobs: DataFrame) -> DataFrame:
    """Postings of a digest with their 1-based position, best first."""
    return global_rank(jobs, best_first(), "position")


def match_rate(labelled: DataFrame, count: str = "keyword_count") -> DataFrame:
    """How many of the processed rows matched any keyword."""
    return labelled.agg(
        _count_if(F.col(count) > 0).alias("matched"), F.count("*").alias("processed")
    )


# -- by name ----------------------------------------------------------------------------


def register_views(jobs: DataFrame, as_of: datetime) -> None:
    """Temporary views of the analyses, under the names that SQL users know, in the session of ``jobs``."""
    named = {
        "recent_matched_jobs": recent_matched(jobs, as_of),
        "daily_job_stats": daily_stats(jobs, as_of),
        "trending_keywords": trending_keywords(jobs, as_of),
        "company_hiring_stats": company_stats(jobs, as_of),
    }
    for name, view in named.items():
        view.createOrReplaceTempView(name)
