"""Postings and their logs as Parquet tables that repeated runs can safely write to.

Postings are partitioned by ``scrape_date`` and inserted only where their URL is new.
Which postings were reported is kept in an append-only table and laid over the postings
on reading, so reporting rewrites nothing.  What is still to be reported waits in a queue by day.
Whether a URL is known is answered by a bucketed table of keys, which keywords a posting has by posting lists,
and the next id by a stored mark, so an insert never reads the postings of earlier days.  Archiving, re-labelling and log retention
rewrite only the partitions they affect; the new rows are cut off durably before the old
files are replaced.

One writer at a time: two inserts that run side by side can store one URL twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from rolelake.dictionaries import priority_seed
from rolelake.functions.dates import ago, timestamp_lit
from rolelake.operators.dedup import insert_if_absent, merge_update
from rolelake.operators.durable import cut_lineage
from rolelake.operators.joins import absent_rows, rows_with_key_in
from rolelake.operators.quality import POSTING_CONSTRAINTS, constraint_errors
from rolelake.plans.index import KeywordIndex, UrlKeys
from rolelake.plans.logs import keep_recent
from rolelake.plans.records import keyword_count, touched
from rolelake.plans.summaries import DailySummaries
from rolelake.schema import CHANGED_DAYS, INSERTS, KEYWORD_PRIORITY, NOTIFICATION_IDS, NOTIFICATION_LOG, NOTIFIED, PENDING, POSTING, REJECTED, REPORTED_UPTO, RUN_EVENT, RUN_LOG, SUMMARISED

POSTINGS, RUNS, NOTIFICATIONS = "postings", "run_log", "notification_log"
REPORTED, REJECTED_ROWS, PRIORITIES = "notified", "rejected", "keyword_priorities"
NOTIFIED_IDS, EVENTS = "notification_ids", "run_events"
QUEUE, UPTO, INSERT_MARKS = "pending", "reported_upto", "inserts"
CHANGES, SUMMED_CHANGES = "changed_days", "summarised"

_SCHEMAS = {
    POSTINGS: POSTING,
    RUNS: RUN_LOG,
    NOTIFICATIONS: NOTIFICATION_LOG,
    NOTIFIED_IDS: NOTIFICATION_IDS,
    REPORTED: NOTIFIED,
    REJECTED_ROWS: REJECTED,
    PRIORITIES: KEYWORD_PRIORITY,
    QUEUE: PENDING,
    UPTO: REPORTED_UPTO,
    EVENTS: RUN_EVENT,
    INSERT_MARKS: INSERTS,
    CHANGES: CHANGED_DAYS,
    SUMMED_CHANGES: SUMMARISED,
}
# Tables partitioned by a day of their own.
_DAY_OF = {POSTINGS: "scrape_date", REPORTED: "sent_day", QUEUE: "queue_day"}
# Log tables are partitioned by the month of this column.
_LOG_TIME = {RUNS: "scrape_start", NOTIFICATIONS: "sent_at", NOTIFIED_IDS: "sent_at"}


# -- changes as plain DataFrame functions -------------------------------------------------


def new_postings(batch: DataFrame, existing: DataFrame, as_of: datetime) -> DataFrame:
    """Valid rows of the batch with a new URL, with the defaults of a fresh posting.

    Ids continue after the highest existing id; they are unique but have gaps.
    """
    last_id = existing.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return as_new(insert_if_absent(batch, existing, "posting_url", "seq"), last_id, as_of)


def as_new(rows: DataFrame, last_id: Column, as_of: datetime) -> DataFrame:
    """Rows with new URLs as fresh postings, with ids after ``last_id``."""
    stamp = timestamp_lit(as_of)
    fresh = rows.drop("seq")
    null_time = F.lit(None).cast("timestamp_ntz")
    return fresh.withColumns(
        {
            "id": last_id + 1 + F.monotonically_increasing_id(),
            "scrape_timestamp": stamp,
            "keyword_match_count": keyword_count(),
            "created_at": stamp,
            "updated_at": stamp,
            "is_active": F.lit(True),
            "is_notified": F.lit(False),
            "notification_sent_at": null_time,
            "scrape_date": F.to_date(stamp),
        }
    ).select(*[F.col(f.name).cast(f.dataType) for f in POSTING.fields])


def with_notifications(postings: DataFrame, notified: DataFrame) -> DataFrame:
    """Postings with the reported state laid over them."""
    state = notified.groupBy("id").agg(F.max("sent_at").alias("_sent_at"))
    joined = postings.join(state, "id", "left")
    return joined.withColumns(
        {
            "is_notified": F.col("is_notified") | F.col("_sent_at").isNotNull(),
            "notification_sent_at": F.coalesce("_sent_at", "notification_sent_at"),
            "updated_at": F.greatest("updated_at", "_sent_at"),
        }
    ).select(*postings.columns)


def mark_notified(postings: DataFrame, sent: DataFrame, as_of: datetime | str) -> DataFrame:
    """Postings with the given ids set to reported, everything else unchanged."""
    marked = sent.select("id", timestamp_lit(as_of).alias("sent_at"))
    return with_notifications(postings, marked)


def is_due_for_archive(as_of: datetime | str, days: int):
    """Active and older than so many days."""
    return F.coalesce(
        F.col("is_active") & (F.col("scrape_timestamp") < ago(as_of, days=days)), F.lit(False)
    )


def archived(postings: DataFrame, as_of: datetime | str, days: int = 180) -> DataFrame:
    """Postings with old active rows set to inactive."""
    due = is_due_for_archive(as_of, days)
    changed = postings.withColumn("_due", due)
    if "updated_at" in postings.columns:
        stamp = F.when(F.col("_due"), timestamp_lit(as_of)).otherwise(F.col("updated_at"))
        changed = changed.withColumn("updated_at", stamp)
    return changed.withColumn("is_active", F.col("is_active") & ~F.col("_due")).drop("_due")


def relabelled(
    postings: DataFrame, updates: DataFrame, as_of: datetime | str | None = None, seq: str | None = None
) -> DataFrame:
    """Postings with the keywords of ``updates`` (id, keywords_matched) put in by id; of several, those with the highest ``seq``."""
    flagged = updates.withColumn("_changed", F.lit(True))
    merged = merge_update(
        postings.withColumn("_changed", F.lit(False)), flagged, "id", ["keywords_matched", "_changed"], seq
    )
    if as_of is None or "updated_at" not in postings.columns:
        return merged.withColumn("keyword_match_count", keyword_count()).drop("_changed")
    return touched(merged, as_of, F.col("_changed")).drop("_changed")


def seeded(dimension: DataFrame, seed: DataFrame, key: str = "keyword") -> DataFrame:
    """The dimension plus those seed rows whose key it lacks."""
    return dimension.unionByName(absent_rows(seed, dimension, key))


# -- stored tables --------------------------------------------------------------------------


@dataclass(frozen=True)
class Inserted:
    """What an insert did: the whole batch, the rows that were new, and counts."""

    batch: DataFrame
    rows: DataFrame
    inserted: int
    duplicates: int
    invalid: int


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(*columns)


class PostingStore:
    """The tables under one folder of a file system that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        for name, schema in _SCHEMAS.items():
            # Makes the folder where it is missing, and leaves an existing table alone.
            writer = _empty(spark, self._stored_schema(name)).write.mode("ignore")
            partition = self._partition(name)
            (writer.partitionBy(partition) if partition else writer).parquet(self._path(name))
        self.keywords = KeywordIndex(spark, self._path("keyword_index"))
        self.urls = UrlKeys(spark, self._path("url_keys"))
        self.summaries = DailySummaries(spark, self._path("summaries"))

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def collected_path(self, run_id: str, source: str) -> str:
        """Where a run keeps what a source gave."""
        return f"{self._path('collected')}/{quote(run_id, safe='')}/{quote(source, safe='')}"

    def _partition(self, name: str) -> str | None:
        if name in _DAY_OF:
            return _DAY_OF[name]
        return "log_month" if name in _LOG_TIME else None

    def _stored_schema(self, name: str) -> StructType:
        schema = StructType(list(_SCHEMAS[name].fields))
        return schema.add("log_month", "string") if name in _LOG_TIME else schema

    def _writer(self, df: DataFrame, name: str):
        partition = self._partition(name)
        # The rebalance hint splits a hot partition over several files and merges small ones.
        if partition is None:
            return df.hint("rebalance").write
        return df.hint("rebalance", partition).write.partitionBy(partition)

    def _stored(self, name: str) -> DataFrame:
        return self.spark.read.schema(self._stored_schema(name)).parquet(self._path(name))

    def read(self, name: str) -> DataFrame:
        return self._stored(name).select(*[f.name for f in _SCHEMAS[name].fields])

    def _with_partition(self, df: DataFrame, name: str) -> DataFrame:
        if name in _LOG_TIME:
            return df.withColumn("log_month", F.date_format(_LOG_TIME[name], "yyyy-MM"))
        return df

    def append(self, name: str, rows: DataFrame) -> None:
        fields = _SCHEMAS[name].fields
        # A column that the rows lack is null; logs that are made without a run have no run id.
        columns = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
        shaped = self._with_partition(rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, fields, strict=True)]), name)
        self._writer(shaped, name).mode("append").parquet(self._path(name))

    def _replace_partitions(self, name: str, rows: DataFrame) -> None:
        """Replace the partitions that occur in ``rows``; all others stay as they are."""
        fixed = cut_lineage(rows)
        self._writer(fixed, name).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(self._path(name))

    def postings(self) -> DataFrame:
        """Current postings, with the reported state laid over them."""
        return with_notifications(self.read(POSTINGS), self.read(REPORTED))

    def insert(self, batch: DataFrame, as_of: datetime) -> "Inserted":
        """Insert rows with new URLs; rows that break a constraint are kept apart.

        ``batch`` has the stored record's columns and ``seq``.  Ids continue after the stored mark.  Posting lists and the queue
        are written before the postings, where entries without a posting do no harm; keys after them, and if an
        insert stopped in between, the next one makes the keys anew.
        """
        self._settle_keys()
        checked = cut_lineage(batch.withColumn("errors", constraint_errors(POSTING_CONSTRAINTS)))
        good = checked.where(F.size("errors") == 0).drop("errors")
        bad = checked.where(F.size("errors") > 0)
        last_id = self.read(INSERT_MARKS).agg(F.coalesce(F.max("high"), F.lit(0))).scalar()
        fresh = cut_lineage(as_new(self.urls.absent(good), last_id, as_of))
        high = fresh.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        self._mark_insert("begun", high, as_of)
        self.keywords.add(fresh)
        self._enqueue(fresh, as_of)
        self._changing(fresh)
        # All of one day and already in tasks of a good size, so written without a shuffle.
        fresh.write.partitionBy("scrape_date").mode("append").parquet(self._path(POSTINGS))
        self.urls.add(fresh)
        self._mark_insert("done", high, as_of)
        whole = F.to_json(F.struct(*batch.columns))
        self.append(REJECTED_ROWS, bad.withColumns({"rejected_at": timestamp_lit(as_of), "stage": F.lit("constraint"), "record": whole}))
        found, invalid = checked.agg(F.count("*"), F.count_if(F.size("errors") > 0)).first()
        inserted = fresh.count()
        return Inserted(checked, fresh, inserted, found - invalid - inserted, invalid)

    def _mark_insert(self, state: str, high: int, as_of: datetime) -> None:
        row = self.spark.range(1).select(F.lit(state).alias("state"), F.lit(high).cast("bigint").alias("high"), timestamp_lit(as_of).alias("at"))
        self.append(INSERT_MARKS, row)

    def _settle_keys(self) -> None:
        """Make keys and mark from the postings themselves if the store has none yet or an insert was cut short."""
        begun, done = self.read(INSERT_MARKS).agg(F.count_if(F.col("state") == "begun"), F.count_if(F.col("state") == "done")).first()
        if begun == done and done > 0:
            return
        postings = self.read(POSTINGS)
        self.urls.rebuild(postings)
        high, at = postings.agg(F.coalesce(F.max("id"), F.lit(0)), F.max("created_at")).first()
        for state in ("begun",) * max(0, done + 1 - begun) + ("done",) * max(1, begun - done):
            self._mark_insert(state, high, at or datetime(1970, 1, 1))

    def _queue_day(self, as_of: datetime) -> Column:
        """The day of ``as_of``, but none before the days that are closed, for a run that catches up on an earlier time."""
        closed = self.read(UPTO).agg(F.max("day")).first()[0]
        return F.lit(max(as_of.date(), closed) if closed else as_of.date())

    def _enqueue(self, rows: DataFrame, as_of: datetime) -> None:
        """Rows with keywords wait to be reported under the day that they came in."""
        waiting = rows.where("keyword_match_count > 0").select("id", "scrape_date", self._queue_day(as_of).alias("queue_day"))
        self.append(QUEUE, waiting)

    def waiting(self, min_keywords: int = 1) -> DataFrame:
        """Active postings with so many keywords that were not reported yet.

        Starts at the last day up to which everything with so many keywords has been reported: queue and reports are read
        from that day on, postings only on the days that the queue names.
        """
        upto = self.read(UPTO).where(F.col("min_keywords") <= min_keywords).agg(F.max("day")).first()[0]
        queue, reported = self.read(QUEUE), self.read(REPORTED)
        if upto is not None:
            queue, reported = queue.where(F.col("queue_day") >= F.lit(upto)), reported.where(F.col("sent_day") >= F.lit(upto))
        left = cut_lineage(queue.select("id", "scrape_date").distinct().join(reported.select("id"), "id", "left_anti"))
        # One row for each day.
        days = [r["scrape_date"] for r in left.select("scrape_date").distinct().collect()]
        rows = rows_with_key_in(self.read(POSTINGS).where(F.col("scrape_date").isin(*days)), left, "id")
        return rows.where(F.col("is_active") & ~F.col("is_notified") & (F.col("keyword_match_count") >= min_keywords))

    def search(self, keywords: Sequence[str]) -> DataFrame:
        """Active postings that have any of the keywords, best first, by posting lists."""
        return self.keywords.search(self.read(POSTINGS), keywords)

    def archive(self, as_of: datetime, days: int = 180) -> int:
        """Set old active postings inactive, rewriting only their days; returns how many."""
        stored = self.read(POSTINGS)
        last_day = F.to_date(ago(as_of, days=days))
        old = stored.where(F.col("scrape_date") <= last_day)
        due = old.where(is_due_for_archive(as_of, days)).groupBy("scrape_date").agg(F.count("*").alias("n"))
        # One row per affected day.
        days_due = {r["scrape_date"]: r["n"] for r in due.collect()}
        if days_due:
            affected = old.where(F.col("scrape_date").isin(*days_due))
            self._changing(affected)
            self._replace_partitions(POSTINGS, archived(affected, as_of, days))
        return sum(days_due.values())

    def relabel(self, updates: DataFrame, as_of: datetime, seq: str | None = None) -> None:
        """Put new keywords into stored postings by id, rewriting only their days; of several updates the one with the highest ``seq``.

        Posting lists and the queue get entries for the new keywords first; a posting that got keywords and
        wasn't reported yet waits under the day of the re-labelling.
        """
        stored = self.read(POSTINGS)
        hit = stored.select("id", "scrape_date").join(updates.select("id").distinct(), "id", "left_semi")
        days = [r["scrape_date"] for r in hit.select("scrape_date").distinct().collect()]
        if days:
            affected = stored.where(F.col("scrape_date").isin(*days))
            changed = cut_lineage(relabelled(affected, updates, as_of, seq))
            own = changed.join(updates.select("id").distinct(), "id", "left_semi")
            self.keywords.add(own)
            self._enqueue(own.join(self.read(REPORTED).select("id"), "id", "left_anti"), as_of)
            self._changing(changed)
            self._replace_partitions(POSTINGS, changed)

    def _changing(self, rows: DataFrame) -> None:
        """Note the days of rows that are about to change."""
        self.append(CHANGES, rows.select(F.lit(uuid.uuid4().hex).alias("change"), "scrape_date").distinct())

    def _unsummarised(self) -> tuple[list[date] | None, DataFrame]:
        """Days that changed since they were summarised, None for all before the first time; and the changes."""
        done = self.read(SUMMED_CHANGES)
        open_ = self.read(CHANGES).join(done, "change", "left_anti")
        if done.isEmpty():
            return None, open_
        # One row for each day.
        return [r["scrape_date"] for r in open_.select("scrape_date").distinct().collect()], open_

    def summarise(self) -> None:
        """Bring the daily summaries up to date; reads and rewrites only days that changed."""
        days, changes = self._unsummarised()
        if days == []:
            return
        held = cut_lineage(changes.select("change").distinct().union(self.spark.range(1).select(F.lit("made"))))
        self.summaries.replace(self.postings(), days)
        self.append(SUMMED_CHANGES, held)

    def analysis(self, view: str, as_of: datetime, **options: int) -> DataFrame:
        """``daily_stats``, ``trending_keywords``, ``company_stats`` or ``global_stats`` as of now, from the daily summaries.

        Days that changed since the last ``summarise`` are read from the postings.
        """
        days, _ = self._unsummarised()
        if days is None:
            days = [r["scrape_date"] for r in self.read(POSTINGS).select("scrape_date").distinct().collect()]
        return getattr(self.summaries, view)(self.postings(), as_of, stale=days, **options)

    def report(self, jobs: DataFrame, as_of: datetime, min_keywords: int | None = None) -> None:
        """Note that these postings were reported; with ``min_keywords``, that nothing with so many keywords is left up to today."""
        day = self._queue_day(as_of)
        self._changing(self.read(POSTINGS).select("id", "scrape_date").join(jobs.select("id"), "id", "left_semi"))
        self.append(REPORTED, jobs.select("id", timestamp_lit(as_of).alias("sent_at"), day.alias("sent_day")))
        if min_keywords is not None:
            row = self.spark.range(1).select(F.lit(min_keywords).cast("int").alias("min_keywords"), day.alias("day"))
            self.append(UPTO, row)

    def seed_priorities(self, seed: DataFrame | None = None) -> None:
        """Add seed rows to the keyword dimension where their keyword is missing."""
        rows = priority_seed(self.spark) if seed is None else seed
        self.append(PRIORITIES, cut_lineage(absent_rows(rows, self.read(PRIORITIES), "keyword")))

    def retain_logs(self, as_of: datetime, days: int = 90) -> None:
        """Drop log rows older than so many days, rewriting only months that hold any."""
        for name, time in _LOG_TIME.items():
            log = self._stored(name)
            old = log.where(F.col(time) < ago(as_of, days=days))
            months = [r["log_month"] for r in old.select("log_month").distinct().collect()]
            if not months:
                continue
            affected = log.where(F.col("log_month").isin(*months))
            kept = cut_lineage(keep_recent(affected, time, as_of, days))
            self._replace_months(name, months, kept)

    def _replace_months(self, name: str, months: list[str], kept: DataFrame) -> None:
        remaining = {r["log_month"] for r in kept.select("log_month").distinct().collect()}
        if remaining:
            self._replace_partitions(name, kept)
        for month in set(months) - remaining:
            self._empty_partition(name, month)

    def _empty_partition(self, name: str, month: str) -> None:
        """Overwrite one month's folder with an empty file set."""
        schema = self._stored_schema(name)
        inner = StructType([f for f in schema.fields if f.name != "log_month"])
        _empty(self.spark, inner).write.mode("overwrite").parquet(
            f"{self._path(name)}/log_month={month}"
        )
