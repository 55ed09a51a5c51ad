"""Rows as they are stored: mapping from collected postings and derived columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from rolelake.functions.dates import timestamp_lit
from rolelake.functions.text import metadata_json

_RECORD = (
    "job_title", "company", "location", "salary_text", "posting_url", "posted_date",
    "description_snippet", "full_description", "source", "keywords_matched",
    "keyword_match_count", "metadata",
)


def keyword_count(keywords: Column | str = "keywords_matched") -> Column:
    """Number of keywords; 0 for a null or empty array."""
    return F.coalesce(F.size(keywords), F.lit(0))


def stored_record(labelled: DataFrame, metadata_as_json: bool = False) -> DataFrame:
    """The columns that are inserted, by name; the count always follows the array."""
    keywords = F.coalesce("keywords_matched", F.array().cast("array<string>"))
    mapped = labelled.withColumn("keywords_matched", keywords).withColumn(
        "keyword_match_count", keyword_count()
    ).withColumn("posted_date", F.to_date("posted_date"))
    if metadata_as_json:
        mapped = mapped.withColumn("metadata", metadata_json("metadata"))
    carried = [c for c in ("seq",) if c in labelled.columns]
    return mapped.select(*_RECORD, *carried)


def touched(
    df: DataFrame, as_of: datetime | str | Column, changed: Column | None = None
) -> DataFrame:
    """Derived columns after a change: count from the array, ``updated_at`` where changed."""
    stamp = timestamp_lit(as_of)
    updated = stamp if changed is None else F.when(changed, stamp).otherwise(F.col("updated_at"))
    return df.withColumn("keyword_match_count", keyword_count()).withColumn("updated_at", updated)
