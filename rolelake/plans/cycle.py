"""The daily cycle: collect, label, insert, report once, keep house."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from rolelake.dictionaries import KeywordDictionary
from rolelake.operators.dedup import last_wins, union_sources
from rolelake.operators.durable import cut_lineage
from rolelake.operators.matching import DEFAULT_TEXT_COLUMNS, with_keywords
from rolelake.operators.quality import valid_rows
from rolelake.operators.ranking import top_matches
from rolelake.plans.logs import notification_id_rows, notification_log_rows, run_log_rows
from rolelake.plans.records import stored_record
from rolelake.plans.store import NOTIFICATIONS, NOTIFIED_IDS, POSTINGS, RUNS, PostingStore
from rolelake.plans.views import global_stats, unnotified
from rolelake.schema import ALLOWED_SOURCES


def collect_batch(
    sources: Sequence[DataFrame],
    only_source: str | None = None,
    allowed_sources: Sequence[str] = ALLOWED_SOURCES,
) -> DataFrame:
    """Valid rows of all sources, one per source and URL: the last, at the first's position.

    Every source has the posting columns and ``seq``, which orders the rows of all sources.
    """
    rows = union_sources(sources)
    if only_source is not None:
        rows = rows.where(F.lower("source") == only_source.lower())
    unique = last_wins(valid_rows(rows, allowed_sources), ["source", "posting_url"], "seq")
    return unique.drop("seq").withColumnRenamed("position", "seq")


def labelled_batch(
    sources: Sequence[DataFrame],
    dictionary: KeywordDictionary,
    only_source: str | None = None,
    allowed_sources: Sequence[str] = ALLOWED_SOURCES,
    text_columns: Sequence[str] = DEFAULT_TEXT_COLUMNS,
) -> DataFrame:
    """The collected batch with its keywords."""
    batch = collect_batch(sources, only_source, allowed_sources)
    return with_keywords(batch, dictionary, text_columns)


def notify_once(
    store: PostingStore,
    deliver: Callable[[DataFrame], bool],
    recipient: str,
    as_of: datetime,
    min_keywords: int = 1,
) -> int:
    """Deliver postings that were not reported yet; on success mark and log them.

    A failed delivery is logged only, so that the next run tries again.  Returns how many
    were reported.
    """
    batch = cut_lineage(unnotified(store.waiting(min_keywords), min_keywords))
    n = batch.count()
    if n == 0:
        return 0
    sent = bool(deliver(batch))
    if sent:
        store.report(batch, as_of, min_keywords)
    batch_id = uuid.uuid4().hex
    status, error = ("sent", None) if sent else ("failed", "Email send failed")
    store.append(NOTIFIED_IDS, notification_id_rows(batch, as_of, batch_id))
    store.append(NOTIFICATIONS, notification_log_rows(batch, recipient, as_of, status, error, batch_id))
    return n if sent else 0


def incremental_run(
    store: PostingStore,
    sources: Sequence[DataFrame],
    dictionary: KeywordDictionary,
    as_of: datetime,
    deliver: Callable[[DataFrame], bool] | None = None,
    recipient: str = "",
    dry_run: bool = False,
    only_source: str | None = None,
    min_keywords: int = 1,
    ended: datetime | None = None,
) -> DataFrame:
    """One run.  A dry run gives the top matches and writes nothing; otherwise the totals."""
    labelled = labelled_batch(sources, dictionary, only_source)
    if dry_run:
        return top_matches(labelled)
    done = store.insert(stored_record(labelled), as_of)
    store.append(RUNS, run_log_rows(done.batch, done.rows, as_of, ended or as_of))
    if deliver is not None:
        notify_once(store, deliver, recipient, as_of, min_keywords)
    return global_stats(store.read(POSTINGS), as_of)


def keep_house(
    store: PostingStore, as_of: datetime, archive_days: int = 180, log_days: int = 90
) -> int:
    """Archive old postings and drop old log rows; returns how many were archived."""
    n = store.archive(as_of, archive_days)
    store.retain_logs(as_of, log_days)
    return n
