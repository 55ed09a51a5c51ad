"""Rows of the run log and the notification log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from rolelake.functions.dates import ago, timestamp_lit
from rolelake.schema import NOTIFICATION_IDS, NOTIFICATION_LOG, RUN_LOG


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def run_log_rows(
    batch: DataFrame,
    inserted: DataFrame,
    started: datetime | str,
    ended: datetime | str,
) -> DataFrame:
    """One finished run per source: found, new, and the rest as failed (duplicates).

    Source names differ in case between callers, so they are lowered.
    """
    def tally(rows: DataFrame, is_new: int) -> DataFrame:
        return rows.select(F.lower("source").alias("source"), F.lit(is_new).alias("_new"))

    start, end = timestamp_lit(started), timestamp_lit(ended)
    seconds = F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)
    counted = (
        tally(batch, 0)
        .unionByName(tally(inserted, 1))
        .groupBy("source")
        .agg(F.count_if(F.col("_new") == 0).alias("jobs_found"), F.count_if(F.col("_new") == 1).alias("jobs_new"))
    )
    return _conform(
        counted.withColumns(
            {
                "scrape_start": start,
                "scrape_end": end,
                "jobs_updated": F.lit(0),
                "jobs_failed": F.col("jobs_found") - F.col("jobs_new"),
                "status": F.lit("success"),
                "duration_seconds": seconds,
                "created_at": end,
            }
        ),
        RUN_LOG,
    )


def collapse_run_events(events: DataFrame, run: str = "run_id", at: str = "event_time") -> DataFrame:
    """One row per run from its start and end events.

    The first event gives the start; the latest event gives everything else, so a run
    that never ended stays 'partial'.  Of events with equal times the end is the later one.
    """
    carried = [c for c in events.columns if c not in (run, at)]
    return (
        events.groupBy(run)
        .agg(
            F.min(at).alias("scrape_start"),
            F.max_by(F.struct(at, *carried), F.struct(F.col(at), F.col("status") != "partial", "status")).alias("_last"),
        )
        .select(
            run,
            "scrape_start",
            F.when(F.col("_last.status") != "partial", F.col(f"_last.{at}")).alias("scrape_end"),
            *[F.col(f"_last.{c}").alias(c) for c in carried],
        )
    )


def notification_log_rows(
    jobs: DataFrame,
    recipient: str,
    as_of: datetime | str,
    status: str = "sent",
    error_message: str | None = None,
    batch_id: str = "",
) -> DataFrame:
    """Log of one batch: one row with its size, however large; an empty batch has one, too.

    Its ids are rows of a table of their own, see :func:`notification_id_rows`.
    """
    counted = jobs.agg(F.count("*").alias("jobs_count"))
    return _conform(
        counted.withColumns(
            {
                "recipient": F.lit(recipient),
                "subject": F.concat(F.col("jobs_count").cast("string"), F.lit(" New Job Matches")),
                "sent_at": timestamp_lit(as_of),
                "status": F.lit(status),
                "error_message": F.lit(error_message),
                "batch_id": F.lit(batch_id),
            }
        ),
        NOTIFICATION_LOG,
    )


def notification_id_rows(jobs: DataFrame, as_of: datetime | str, batch_id: str = "") -> DataFrame:
    """The ids of one batch."""
    return _conform(jobs.select("id").withColumns({"batch_id": F.lit(batch_id), "sent_at": timestamp_lit(as_of)}), NOTIFICATION_IDS)


def with_job_ids(log: DataFrame, ids: DataFrame) -> DataFrame:
    """The log with each batch's ids as an ordered array, for batches that a reader can hold."""
    listed = ids.groupBy("batch_id").agg(F.sort_array(F.collect_list("id")).alias("job_ids"))
    none = F.array().cast("array<bigint>")
    return log.join(listed, "batch_id", "left").withColumn("job_ids", F.coalesce("job_ids", none))


def job_alert_rows(
    jobs: DataFrame, recipient: str, as_of: datetime | str, status: str = "sent"
) -> DataFrame:
    """Log with one row, and one batch, per posting; its id stands beside it."""
    alerts = jobs.select(
        F.lit(recipient).alias("recipient"),
        F.concat(F.lit("Job alert: job "), F.col("id").cast("string")).alias("subject"),
        F.lit(1).alias("jobs_count"),
        timestamp_lit(as_of).alias("sent_at"),
        F.lit(status).alias("status"),
        F.concat(F.lit("job "), F.col("id").cast("string"), F.lit(f" {as_of}")).alias("batch_id"),
        F.col("id").cast("bigint").alias("id"),
    )
    return alerts.select("*", F.lit(None).cast("string").alias("error_message")).select(*[f.name for f in NOTIFICATION_LOG.fields], "id")


def keep_recent(log: DataFrame, time: str, as_of: datetime | str | Column, days: int = 90) -> DataFrame:
    """Rows that retention keeps: everything that is not older than so many days."""
    return log.where(~F.coalesce(F.col(time) < ago(as_of, days=days), F.lit(False)))
