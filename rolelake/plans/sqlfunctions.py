"""The selections of the postings table as functions of SQL, called by name with arguments.

``register`` makes them for a session: table functions over the stored tables, so that
``SELECT * FROM get_jobs_by_keywords(array('SQL'))`` works in ``spark.sql``.  They last as long as the session does.

SQL functions can't change tables.  What the procedures ``archive_old_jobs`` and ``cleanup_old_logs`` would change is a
selection, too, and ``call`` runs such a statement by name on the store.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from rolelake.plans.store import NOTIFICATIONS, RUNS, PostingStore

_BRIEF = "job_id BIGINT, job_title STRING, company STRING, keywords_matched ARRAY<STRING>, posting_url STRING"
_UNNOTIFIED = (
    "job_id BIGINT, job_title STRING, company STRING, location STRING, keywords_matched ARRAY<STRING>, keyword_match_count INT, posting_url STRING"
)
_BEST_FIRST = "keyword_match_count DESC NULLS LAST, scrape_timestamp DESC NULLS LAST, id"


def register(spark: SparkSession, jobs: str, runs: str, notices: str) -> None:
    """Make the functions over three relations of the session, given by name.

    ``get_jobs_by_keywords(words)``: active postings with any of the words, best first.
    ``get_unnotified_jobs(min_keywords)``: active postings not reported yet, best first.
    ``get_jobs_to_archive(as_of, days)``: active postings older than so many days.
    ``get_old_logs(as_of, days)``: rows of both logs that retention drops.
    ``get_jobs_by_source(name, as_of, days)``: postings of one source within the last days, newest first.
    """

    def make(name: str, arguments: str, columns: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE ({columns}) RETURN {body}")

    make(
        "get_jobs_by_keywords", "words ARRAY<STRING>", _BRIEF,
        f"""SELECT id, job_title, company, keywords_matched, posting_url FROM {jobs}
            WHERE is_active AND arrays_overlap(keywords_matched, get_jobs_by_keywords.words) ORDER BY {_BEST_FIRST}""",
    )
    make(
        "get_unnotified_jobs", "min_keywords INT DEFAULT 1", _UNNOTIFIED,
        f"""SELECT id, job_title, company, location, keywords_matched, CAST(keyword_match_count AS INT), posting_url FROM {jobs}
            WHERE is_active AND NOT is_notified AND keyword_match_count >= get_unnotified_jobs.min_keywords ORDER BY {_BEST_FIRST}""",
    )
    make(
        "get_jobs_to_archive", "as_of TIMESTAMP_NTZ, days INT DEFAULT 180", "job_id BIGINT, scrape_timestamp TIMESTAMP_NTZ",
        f"""SELECT id, scrape_timestamp FROM {jobs}
            WHERE is_active AND scrape_timestamp < get_jobs_to_archive.as_of - make_dt_interval(get_jobs_to_archive.days)""",
    )
    make(
        "get_old_logs", "as_of TIMESTAMP_NTZ, days INT DEFAULT 90", "log STRING, logged_at TIMESTAMP_NTZ",
        f"""SELECT log, logged_at FROM (SELECT 'run' AS log, scrape_start AS logged_at FROM {runs}
                                        UNION ALL SELECT 'notification', sent_at FROM {notices})
            WHERE logged_at < get_old_logs.as_of - make_dt_interval(get_old_logs.days)""",
    )
    make(
        "get_jobs_by_source", "name STRING, as_of TIMESTAMP_NTZ, days INT DEFAULT 7", _BRIEF,
        f"""SELECT id, job_title, company, keywords_matched, posting_url FROM {jobs}
            WHERE source = get_jobs_by_source.name AND scrape_timestamp >= get_jobs_by_source.as_of - make_dt_interval(get_jobs_by_source.days)
            ORDER BY scrape_timestamp DESC NULLS FIRST, id""",
    )


def register_store(store: PostingStore) -> None:
    """Make the functions over a store's tables as they are when a query runs."""
    names = {"stored_jobs": store.postings(), "stored_runs": store.read(RUNS), "stored_notices": store.read(NOTIFICATIONS)}
    for name, df in names.items():
        df.createOrReplaceTempView(name)
    register(store.spark, *names)


_CALL = re.compile(r"\s*call\s+(\w+)\s*\(\s*(\d*)\s*\)\s*;?\s*", re.IGNORECASE)


def call(store: PostingStore, statement: str, as_of: datetime) -> DataFrame:
    """Run ``CALL archive_old_jobs(days)`` or ``CALL cleanup_old_logs(days)``; the result has one row with the number of rows changed.

    Without an argument the procedures take 180 and 90 days.  Any other statement is an error.
    """
    found = _CALL.fullmatch(statement)
    name = found and found[1].lower()
    if name == "archive_old_jobs":
        changed = store.archive(as_of, int(found[2] or 180))
    elif name == "cleanup_old_logs":
        days = int(found[2] or 90)
        register_store(store)
        stamp = as_of.isoformat(sep=" ")
        changed = store.spark.sql(f"SELECT * FROM get_old_logs(TIMESTAMP_NTZ '{stamp}', {days})").count()
        store.retain_logs(as_of, days)
    else:
        raise ValueError(f"no such procedure: {statement!r}")
    register_store(store)
    return store.spark.sql(f"SELECT '{name}' AS procedure, CAST({changed} AS BIGINT) AS changed")
