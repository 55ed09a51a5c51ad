"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Sources a posting may come from.
ALLOWED_SOURCES = ("BrighterMonday", "MyJobMag", "Fuzu", "Other")

# States of a run and of a notification.
RUN_STATES = ("success", "partial", "failed")
NOTIFICATION_STATES = ("sent", "failed")


_TEXT, _COUNT, _TIME, _FLAG = T.StringType(), T.LongType(), T.TimestampNTZType(), T.BooleanType()
_TEXTS = T.ArrayType(_TEXT)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


POSTING = _schema(
    id=_COUNT,
    job_title=_TEXT,
    company=_TEXT,
    location=_TEXT,
    salary_text=_TEXT,
    description_snippet=_TEXT,
    full_description=_TEXT,
    posting_url=_TEXT,
    source=_TEXT,
    posted_date=T.DateType(),
    scrape_timestamp=_TIME,
    keywords_matched=_TEXTS,
    keyword_match_count=T.IntegerType(),
    created_at=_TIME,
    updated_at=_TIME,
    is_active=_FLAG,
    is_notified=_FLAG,
    notification_sent_at=_TIME,
    metadata=T.MapType(_TEXT, _TEXT),
    scrape_date=T.DateType(),
)

RUN_LOG = _schema(
    source=_TEXT,
    scrape_start=_TIME,
    scrape_end=_TIME,
    jobs_found=_COUNT,
    jobs_new=_COUNT,
    jobs_updated=_COUNT,
    jobs_failed=_COUNT,
    status=_TEXT,
    error_message=_TEXT,
    duration_seconds=T.DecimalType(10, 2),
    created_at=_TIME,
    run_id=_TEXT,
)

# What happened to a source in a run, one row for each step that began, ended or failed.
RUN_EVENT = _schema(
    run_id=_TEXT, source=_TEXT, event_time=_TIME, status=_TEXT, step=_TEXT, jobs_found=_COUNT, jobs_new=_COUNT,
    jobs_updated=_COUNT, jobs_failed=_COUNT, error_message=_TEXT,
)

NOTIFICATION_LOG = _schema(
    recipient=_TEXT,
    subject=_TEXT,
    jobs_count=_COUNT,
    sent_at=_TIME,
    status=_TEXT,
    error_message=_TEXT,
    batch_id=_TEXT,
)

# The postings of a batch, one row each, so that a batch of any size has one row in the log.
NOTIFICATION_IDS = _schema(batch_id=_TEXT, id=_COUNT, sent_at=_TIME)

NOTIFIED = _schema(id=_COUNT, sent_at=_TIME, sent_day=T.DateType())

# Postings that wait to be reported, by the day that they came in or got keywords.
PENDING = _schema(id=_COUNT, scrape_date=T.DateType(), queue_day=T.DateType())

# Up to which day everything with so many keywords has been reported.
REPORTED_UPTO = _schema(min_keywords=T.IntegerType(), day=T.DateType())

# Begin and end of every insert, with the highest id that it gave.
INSERTS = _schema(state=_TEXT, high=_COUNT, at=_TIME)

# Days whose postings a change touches, noted before it, and the changes that the daily summaries hold.
CHANGED_DAYS = _schema(change=_TEXT, scrape_date=T.DateType())
SUMMARISED = _schema(change=_TEXT)

KEYWORD_PRIORITY = _schema(keyword=_TEXT, priority=T.IntegerType(), category=_TEXT)

REJECTED = _schema(
    job_title=_TEXT, posting_url=_TEXT, source=_TEXT, errors=_TEXTS, rejected_at=_TIME,
    # Where it was rejected, and the whole row as JSON.
    stage=_TEXT, record=_TEXT,
)
