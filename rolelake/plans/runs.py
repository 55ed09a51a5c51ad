"""One run over several sources, each with a state of its own.

Every source goes through ``collect``, ``collected`` and ``inserted``; each step is an event in an append-only table, and
so is a failure.  A source that fails leaves the others alone.  What a source gave is stored before anything is made of it, so
a run that was cut short goes on, under the same run id, from the last step that ended: collected sources aren't
asked again, inserted ones are left out.  Rows that don't pass validation are kept whole, with their errors.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from rolelake.dictionaries import KeywordDictionary
from rolelake.functions.dates import timestamp_lit
from rolelake.operators.dedup import last_wins, union_sources
from rolelake.operators.durable import cut_lineage
from rolelake.operators.matching import DEFAULT_TEXT_COLUMNS, with_keywords
from rolelake.operators.quality import posting_errors
from rolelake.plans.logs import collapse_run_events
from rolelake.plans.records import stored_record
from rolelake.plans.store import EVENTS, REJECTED_ROWS, RUNS, PostingStore
from rolelake.schema import ALLOWED_SOURCES

COLLECT, COLLECTED, INSERTED = "collect", "collected", "inserted"
_RUN_SOURCE = "_run_source"


def _event(store: PostingStore, run_id: str, source: str, at: datetime, status: str, step: str, **values) -> None:
    row = store.spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.lit(source).alias("source"), timestamp_lit(at).alias("event_time"), F.lit(status).alias("status"), F.lit(step).alias("step"),
        *[F.lit(values.get(c, 0)).cast("bigint").alias(c) for c in ("jobs_found", "jobs_new", "jobs_updated", "jobs_failed")],
        F.lit(values.get("error_message")).cast("string").alias("error_message"),
    )
    store.append(EVENTS, row)


def _reached(store: PostingStore, run_id: str) -> dict[str, tuple[str, int]]:
    """The furthest step of each source that ended, and the rows found; a few rows for each source."""
    events = store.read(EVENTS).where((F.col("run_id") == run_id) & (F.col("status") != "failed") & (F.col("step") != COLLECT))
    furthest: dict[str, tuple[str, int]] = {}
    for r in events.select("source", "step", "jobs_found").collect():
        if furthest.get(r["source"], ("", 0))[0] != INSERTED:
            furthest[r["source"]] = (r["step"], r["jobs_found"])
    return furthest


def _collect(store: PostingStore, run_id: str, sources: Mapping[str, Callable[[], DataFrame]], clock: Callable[[], datetime]) -> dict[str, DataFrame]:
    """What the sources gave, read from where it is stored; sources that fail are logged and left out."""
    reached, given = _reached(store, run_id), {}
    for name, load in sources.items():
        step, _ = reached.get(name, ("", 0))
        if step == INSERTED:
            continue
        path = store.collected_path(run_id, name)
        if step != COLLECTED:
            _event(store, run_id, name, clock(), "partial", COLLECT)
            try:
                load().write.mode("overwrite").parquet(path)
                found = store.spark.read.parquet(path).count()
            except Exception as problem:  # whatever a source runs into is its own failure
                _event(store, run_id, name, clock(), "failed", COLLECT, error_message=str(problem).strip().splitlines()[0][:500])
                continue
            _event(store, run_id, name, clock(), "partial", COLLECTED, jobs_found=found)
        given[name] = store.spark.read.parquet(path).withColumn(_RUN_SOURCE, F.lit(name))
    return given


def rejected_rows(checked: DataFrame, columns: Sequence[str], stage: str, as_of: datetime) -> DataFrame:
    """Rows that have errors, in the shape of the table of rejected rows; ``record`` is the whole row as JSON."""
    bad = checked.where(F.size("errors") > 0)
    whole = F.to_json(F.struct(*columns))
    return bad.select("job_title", "posting_url", "source", "errors", timestamp_lit(as_of).alias("rejected_at"), F.lit(stage).alias("stage"), whole.alias("record"))


def run_sources(
    store: PostingStore,
    run_id: str,
    sources: Mapping[str, Callable[[], DataFrame]],
    dictionary: KeywordDictionary,
    as_of: datetime,
    clock: Callable[[], datetime] = datetime.now,
    allowed_sources: Sequence[str] = ALLOWED_SOURCES,
    text_columns: Sequence[str] = DEFAULT_TEXT_COLUMNS,
) -> DataFrame:
    """Run all sources that this run hasn't finished; returns the run's row for each source.

    ``sources``: name to a function that gives rows with the posting columns and ``seq``.  A source without rows is
    a success with none found.  jobs_failed counts rows that validation or a constraint rejected, not duplicates.
    """
    given = _collect(store, run_id, sources, clock)
    if given:
        rows = union_sources(list(given.values()))
        checked = cut_lineage(rows.withColumn("errors", posting_errors(allowed_sources)))
        own = [c for c in rows.columns if c != _RUN_SOURCE]
        store.append(REJECTED_ROWS, rejected_rows(checked, own, "validation", as_of))
        good = checked.where(F.size("errors") == 0).drop("errors")
        unique = last_wins(good, ["source", "posting_url"], "seq").drop("seq").withColumnRenamed("position", "seq")
        labelled = cut_lineage(with_keywords(unique, dictionary, text_columns))
        done = store.insert(stored_record(labelled), as_of)
        from_source = labelled.select("seq", _RUN_SOURCE)
        fresh = done.batch.join(done.rows.select("posting_url"), "posting_url", "left_semi").where(F.size("errors") == 0)
        # Of one URL in two sources only the first row was stored.
        fresh = fresh.groupBy("posting_url").agg(F.min("seq").alias("seq"))
        broken = done.batch.where(F.size("errors") > 0)
        counts = (
            checked.select(_RUN_SOURCE, F.lit(1).alias("found"), F.lit(0).alias("new"), (F.size("errors") > 0).cast("int").alias("failed"))
            .unionByName(fresh.join(from_source, "seq").select(_RUN_SOURCE, F.lit(0).alias("found"), F.lit(1).alias("new"), F.lit(0).alias("failed")))
            .unionByName(broken.join(from_source, "seq").select(_RUN_SOURCE, F.lit(0).alias("found"), F.lit(0).alias("new"), F.lit(1).alias("failed")))
            .groupBy(_RUN_SOURCE).agg(F.sum("found").alias("found"), F.sum("new").alias("new"), F.sum("failed").alias("failed"))
        )
        # One row for each source.
        by_source = {r[_RUN_SOURCE]: r for r in counts.collect()}
        for name in given:
            r = by_source.get(name)
            found, new, failed = (r["found"], r["new"], r["failed"]) if r else (0, 0, 0)
            _event(store, run_id, name, clock(), "success", INSERTED, jobs_found=found, jobs_new=new, jobs_failed=failed)
    log = cut_lineage(run_rows(store.read(EVENTS).where(F.col("run_id") == run_id)))
    ended = log.where("status <> 'partial'")
    store.append(RUNS, ended.join(store.read(RUNS).select("run_id", "source", "status"), ["run_id", "source", "status"], "left_anti"))
    return log


def run_rows(events: DataFrame) -> DataFrame:
    """One row for each run and source from its events; one that never ended is partial."""
    keyed = events.withColumn("_run", F.struct("run_id", "source")).drop("run_id", "source", "step")
    rows = collapse_run_events(keyed, run="_run").select("_run.run_id", "_run.source", "*").drop("_run")
    seconds = F.timestamp_diff("MICROSECOND", F.col("scrape_start"), F.col("scrape_end")) / F.lit(1e6)
    return rows.withColumns({"duration_seconds": seconds, "created_at": F.coalesce("scrape_end", "scrape_start")})
