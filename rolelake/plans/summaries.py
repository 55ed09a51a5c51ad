"""Aggregate views merged from summaries of each day.

A summary holds what can be added up: counts, sums, least and latest times, one row for each day and source,
keyword or company.  A view takes the summaries of the days that lie wholly in its window, and the postings themselves
for the day that the window's start cuts and for days whose summary is out of date; so it equals the view of
the same name in ``views`` at any time, and reads few postings.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rolelake.operators.matching import each_keyword
from rolelake.plans.views import _has_keywords, _since

_SCHEMAS = {
    "source_days": "source string, jobs bigint, matched bigint, keywords bigint, counted bigint, notified bigint, active bigint, "
    "active_matched bigint, active_keywords bigint, active_counted bigint, active_latest timestamp_ntz, scrape_date date",
    "keyword_days": "keyword string, source string, n bigint, latest timestamp_ntz, scrape_date date",
    "company_days": "company string, source string, n bigint, relevant bigint, earliest timestamp_ntz, latest timestamp_ntz, scrape_date date",
}


def source_days(jobs: DataFrame) -> DataFrame:
    """Volume per day and source, of all postings and of active ones."""
    active, count = F.col("is_active"), F.col("keyword_match_count")
    return jobs.groupBy("scrape_date", "source").agg(
        F.count("*").alias("jobs"),
        F.count_if(_has_keywords()).alias("matched"),
        F.sum(count).alias("keywords"),
        F.count(count).alias("counted"),
        F.count_if("is_notified").alias("notified"),
        F.count_if(active).alias("active"),
        F.count_if(active & _has_keywords()).alias("active_matched"),
        F.sum(F.when(active, count)).alias("active_keywords"),
        F.count(F.when(active, count)).alias("active_counted"),
        F.max(F.when(active, F.col("scrape_timestamp"))).alias("active_latest"),
    )


def keyword_days(jobs: DataFrame) -> DataFrame:
    """How often a keyword was found on a day in a source, and when last."""
    found = each_keyword(jobs, "scrape_date", "source", "scrape_timestamp")
    return found.groupBy("scrape_date", "keyword", "source").agg(F.count("*").alias("n"), F.max("scrape_timestamp").alias("latest"))


def company_days(jobs: DataFrame) -> DataFrame:
    """A company's postings of a day in a source."""
    stamp = F.col("scrape_timestamp")
    return jobs.where("company is not null").groupBy("scrape_date", "company", "source").agg(
        F.count("*").alias("n"), F.count_if(_has_keywords()).alias("relevant"), F.min(stamp).alias("earliest"), F.max(stamp).alias("latest")
    )


_MAKE = {"source_days": source_days, "keyword_days": keyword_days, "company_days": company_days}


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


class DailySummaries:
    """Summaries of each day under one folder, partitioned by ``scrape_date``.

    ``jobs`` are always the current postings, with their ``scrape_date``; ``stale`` are days whose postings
    changed after they were summarised.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        for name in _MAKE:
            # Makes the folder where it is missing, and leaves existing summaries alone.
            self._write(name, spark.createDataFrame([], _SCHEMAS[name]), "ignore", "static")

    def _write(self, name: str, rows: DataFrame, mode: str, partitions: str) -> None:
        writer = rows.hint("rebalance", "scrape_date").write.mode(mode).option("partitionOverwriteMode", partitions)
        writer.partitionBy("scrape_date").parquet(f"{self.root}/{name}")

    def _made(self, name: str, jobs: DataFrame) -> DataFrame:
        return _MAKE[name](jobs).to(self.read(name).schema)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(_SCHEMAS[name]).parquet(f"{self.root}/{name}")

    def replace(self, jobs: DataFrame, days: Sequence[date] | None = None) -> None:
        """Summarise these days anew, without ``days`` all of them; the summaries of other days stay as they are."""
        rows = jobs if days is None else jobs.where(F.col("scrape_date").isin(*days))
        for name in _MAKE:
            self._write(name, self._made(name, rows), "overwrite", "static" if days is None else "dynamic")

    def _summed(
        self, name: str, jobs: DataFrame, stale: Sequence[date], as_of: datetime | None = None, span: timedelta | None = None, inclusive: bool = False
    ) -> DataFrame:
        """Summaries of the days within ``span`` before ``as_of`` (all days without one), of a day's part within it for the first."""
        day, fresh, live = F.col("scrape_date"), self.read(name), F.col("scrape_date").isin(*stale)
        if stale:
            fresh = fresh.where(day.isNull() | ~live)
        if span is not None:
            first = F.lit((as_of - span).date())
            fresh, live, jobs = fresh.where(day > first), live | (day == first), _since(jobs, as_of, span, inclusive)
        elif not stale:
            return fresh
        return fresh.unionByName(self._made(name, jobs.where(live)))

    def daily_stats(self, jobs: DataFrame, as_of: datetime, days: int = 30, stale: Sequence[date] = ()) -> DataFrame:
        """As ``views.daily_stats``."""
        return (
            self._summed("source_days", jobs, stale, as_of, timedelta(days=days))
            .groupBy("scrape_date", "source")
            .agg(
                F.sum("jobs").alias("total_jobs"),
                F.sum("matched").alias("matched_jobs"),
                F.try_divide(F.sum("keywords"), F.sum("counted")).alias("avg_keywords"),
                F.sum("notified").alias("notified_jobs"),
            )
            .orderBy(F.desc("scrape_date"), "source")
        )

    def trending_keywords(self, jobs: DataFrame, as_of: datetime, days: int = 30, stale: Sequence[date] = ()) -> DataFrame:
        """As ``views.trending_keywords``."""
        return (
            self._summed("keyword_days", jobs, stale, as_of, timedelta(days=days))
            .groupBy("keyword", "source")
            .agg(F.sum("n").alias("n"), F.max("latest").alias("latest"))
            .groupBy("keyword")
            .agg(F.sum("n").alias("frequency"), F.count("source").alias("sources_count"), F.max("latest").alias("last_seen"))
            .orderBy(F.desc("frequency"), "keyword")
        )

    def company_stats(
        self, jobs: DataFrame, as_of: datetime, days: int = 60, min_postings: int = 2, stale: Sequence[date] = ()
    ) -> DataFrame:
        """As ``views.company_stats``."""
        return (
            self._summed("company_days", jobs, stale, as_of, timedelta(days=days))
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

    def global_stats(self, jobs: DataFrame, as_of: datetime, stale: Sequence[date] = ()) -> DataFrame:
        """As ``views.global_stats``."""
        def seen_within(**span: int) -> Column:
            return self._summed("source_days", jobs, stale, as_of, timedelta(**span), inclusive=True).agg(_total("active")).scalar()

        return self._summed("source_days", jobs, stale).agg(
            _total("active").alias("total_jobs"),
            F.countDistinct(F.when(F.col("active") > 0, F.col("source"))).alias("total_sources"),
            _total("active_matched").alias("jobs_with_keywords"),
            F.max("active_latest").alias("last_scrape"),
            F.try_divide(F.sum("active_keywords"), F.sum("active_counted")).alias("avg_keyword_count"),
        ).select(
            "total_jobs", "total_sources", "jobs_with_keywords", seen_within(hours=24).alias("jobs_last_24h"),
            seen_within(days=7).alias("jobs_last_7d"), "last_scrape", "avg_keyword_count",
        )
