from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rolelake.dictionaries import KeywordDictionary
from rolelake.plans import cycle, logs, records, store as st

AS_OF = datetime(2024, 2, 1, 12, 0)
BUILT_IN = KeywordDictionary.of()


def batch(spark, rows):
    """rows: (seq, url, title, source, keywords)"""
    schema = "seq long, posting_url string, job_title string, source string, keywords_matched array<string>"
    empty = {c: F.lit(None).cast("string") for c in (
        "company", "location", "salary_text", "description_snippet", "full_description")}
    return spark.createDataFrame(rows, schema).withColumns(
        {**empty, "posted_date": F.lit(AS_OF.isoformat()).cast("timestamp_ntz"),
         "metadata": F.create_map(F.lit("k"), F.lit("v"))}
    )


@pytest.fixture
def store(spark, tmp_path):
    return st.PostingStore(spark, str(tmp_path / "tables"))


ROWS = [
    (1, "https://a.com/1", "Data Engineer", "Fuzu", ["Data Engineer"]),
    (2, "https://a.com/2", "Gardener", "Fuzu", []),
    (3, "https://a.com/1", "Duplicate", "MyJobMag", ["SQL"]),
    (4, "https://a.com/4", "T" * 501, "Fuzu", ["SQL"]),
    (5, None, "No URL", "Fuzu", None),
]


def test_insert_is_idempotent(spark, store):
    rows = records.stored_record(batch(spark, ROWS))
    first = store.insert(rows, AS_OF)
    assert (first.inserted, first.duplicates, first.invalid) == (2, 1, 2)
    again = store.insert(rows, AS_OF + timedelta(days=1))
    assert (again.inserted, again.duplicates, again.invalid) == (0, 3, 2)
    kept = {r["posting_url"]: r for r in store.postings().collect()}
    assert set(kept) == {"https://a.com/1", "https://a.com/2"}
    one = kept["https://a.com/1"]
    assert (one["job_title"], one["keyword_match_count"], one["posted_date"]) == (
        "Data Engineer", 1, date(2024, 2, 1))
    assert one["is_active"] and not one["is_notified"] and one["created_at"] == AS_OF
    third = store.insert(records.stored_record(batch(spark, [
        (1, "https://a.com/9", "New", "Other", None)])), AS_OF)
    assert third.inserted == 1
    assert store.read(st.POSTINGS).select("id").distinct().count() == 3
    errors = [r["errors"] for r in store.read(st.REJECTED_ROWS).collect()]
    assert ["posting_url is null"] in errors and ["job_title is longer than 500"] in errors


def test_notify_once(spark, store):
    store.insert(records.stored_record(batch(spark, ROWS)), AS_OF)
    seen = []

    def deliver(ok):
        def send(df):
            seen.append([r["posting_url"] for r in df.collect()])
            return ok
        return send

    assert cycle.notify_once(store, deliver(False), "a@b.c", AS_OF) == 0
    assert cycle.notify_once(store, deliver(True), "a@b.c", AS_OF) == 1
    assert cycle.notify_once(store, deliver(True), "a@b.c", AS_OF) == 0
    assert seen == [["https://a.com/1"], ["https://a.com/1"]]
    log = logs.with_job_ids(store.read(st.NOTIFICATIONS), store.read(st.NOTIFIED_IDS)).orderBy("status").collect()
    assert [(r["status"], r["jobs_count"], r["subject"], len(r["job_ids"])) for r in log] == [
        ("failed", 1, "1 New Job Matches", 1), ("sent", 1, "1 New Job Matches", 1)]
    reported = store.postings().where("is_notified").collect()
    assert [r["notification_sent_at"] for r in reported] == [AS_OF]


def test_archive_rewrites_only_old_days(spark, store):
    old = AS_OF - timedelta(days=200)
    store.insert(records.stored_record(batch(spark, ROWS[:1])), old)
    store.insert(records.stored_record(batch(spark, ROWS[1:2])), AS_OF)
    assert store.archive(AS_OF, 180) == 1
    assert store.archive(AS_OF, 180) == 0
    assert [(r["posting_url"], r["is_active"]) for r in store.postings().orderBy("posting_url").collect()] == [
        ("https://a.com/1", False), ("https://a.com/2", True)]


def test_relabel(spark, store):
    store.insert(records.stored_record(batch(spark, ROWS[:2])), AS_OF)
    target = store.read(st.POSTINGS).where("posting_url = 'https://a.com/2'").first()["id"]
    updates = spark.createDataFrame([(target, ["Linux", "SQL"])], "id long, keywords_matched array<string>")
    store.relabel(updates, AS_OF + timedelta(days=1))
    got = {r["posting_url"]: r for r in store.postings().collect()}
    assert got["https://a.com/2"]["keyword_match_count"] == 2
    assert got["https://a.com/2"]["updated_at"] == AS_OF + timedelta(days=1)
    assert got["https://a.com/1"]["updated_at"] == AS_OF
    assert len(got) == 2


def test_log_retention(spark, store):
    rows = batch(spark, ROWS)
    for days in (400, 91, 89, 0):
        when = AS_OF - timedelta(days=days)
        store.append(st.RUNS, logs.run_log_rows(rows, rows.limit(1), when, when + timedelta(seconds=1.5)))
    assert store.read(st.RUNS).count() == 8
    store.retain_logs(AS_OF, 90)
    left = store.read(st.RUNS).collect()
    assert {(AS_OF - r["scrape_start"]).days for r in left} == {89, 0}
    assert len(left) == 4
    assert {str(r["duration_seconds"]) for r in left} == {"1.50"}
    store.retain_logs(AS_OF, 90)
    assert store.read(st.RUNS).count() == 4


def test_seed_ignores_known_keys(spark, store):
    store.seed_priorities()
    store.seed_priorities()
    assert store.read(st.PRIORITIES).count() == 20
    extra = spark.createDataFrame([("SQL", 1, "x"), ("COBOL", 1, "y")], "keyword string, priority int, category string")
    store.seed_priorities(extra)
    got = {r["keyword"]: r["priority"] for r in store.read(st.PRIORITIES).collect()}
    assert (len(got), got["SQL"], got["COBOL"]) == (21, 5, 1)


def test_a_batch_has_one_row_at_any_size(spark):
    for n in (0, 1, 250_000):
        jobs = spark.range(n)
        (row,) = logs.notification_log_rows(jobs, "a@b.c", AS_OF, batch_id="x").collect()
        assert (row["jobs_count"], row["subject"], row["batch_id"]) == (n, f"{n} New Job Matches", "x")
        ids = logs.notification_id_rows(jobs, AS_OF, "x")
        assert ids.count() == n and ids.where("batch_id = 'x'").select("id").distinct().count() == n
    log = logs.notification_log_rows(spark.range(0), "a@b.c", AS_OF, batch_id="x")
    assert logs.with_job_ids(log, logs.notification_id_rows(spark.range(0), AS_OF, "x")).first()["job_ids"] == []
    alerts = logs.job_alert_rows(spark.range(2), "a@b.c", AS_OF).orderBy("subject").collect()
    assert [(r["subject"], r["jobs_count"], r["id"]) for r in alerts] == [("Job alert: job 0", 1, 0), ("Job alert: job 1", 1, 1)]
    assert len({r["batch_id"] for r in alerts}) == 2


def test_run_events_at_one_time_end_the_run(spark):
    at = datetime(2024, 1, 1, 1)
    for rows in ([(1, at, "partial"), (1, at, "success")], [(1, at, "success"), (1, at, "partial")]):
        got = logs.collapse_run_events(spark.createDataFrame(rows, "run_id int, event_time timestamp_ntz, status string")).first()
        assert (got["status"], got["scrape_end"]) == ("success", at)


def test_run_events_collapse(spark):
    rows = [
        (1, datetime(2024, 1, 1, 1), "fuzu", "partial", None),
        (1, datetime(2024, 1, 1, 2), "fuzu", "success", 7),
        (2, datetime(2024, 1, 1, 1), "fuzu", "partial", None),
    ]
    events = spark.createDataFrame(rows, "run_id int, event_time timestamp_ntz, source string, status string, jobs_found int")
    got = logs.collapse_run_events(events).orderBy("run_id").collect()
    assert [(r["run_id"], r["scrape_start"], r["scrape_end"], r["status"], r["jobs_found"]) for r in got] == [
        (1, datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2), "success", 7),
        (2, datetime(2024, 1, 1, 1), None, "partial", None)]


def test_whole_cycle_twice(spark, store):
    def source(name, rows):
        return batch(spark, [(seq, url, title, name, None) for seq, url, title in rows]).drop("keywords_matched")

    sources = [
        source("Fuzu", [(1, "https://f.com/1", "Data Engineer, SQL"), (2, "https://f.com/1", "SQL DBA")]),
        source("MyJobMag", [(3, "https://m.com/1", "Gardener"), (4, "bad", "SQL")]),
    ]
    dry = cycle.incremental_run(store, sources, BUILT_IN, AS_OF, dry_run=True).collect()
    assert [(r["job_title"], r["keywords_shown"]) for r in dry] == [
        ("SQL DBA", ["DBA", "Database Administrator", "SQL"]), ("Gardener", [])]
    assert store.postings().count() == 0

    delivered = []
    send = lambda df: delivered.append(df.count()) or True
    for days in (0, 1):
        when = AS_OF + timedelta(days=days)
        totals = cycle.incremental_run(store, sources, BUILT_IN, when, send, "a@b.c").first()
        assert (totals["total_jobs"], totals["jobs_with_keywords"], totals["total_sources"]) == (2, 1, 2)
    assert delivered == [1]
    runs = store.read(st.RUNS).orderBy("scrape_start", "source").collect()
    assert [(r["source"], r["jobs_found"], r["jobs_new"], r["jobs_failed"]) for r in runs] == [
        ("fuzu", 1, 1, 0), ("myjobmag", 1, 1, 0), ("fuzu", 1, 0, 1), ("myjobmag", 1, 0, 1)]
    only = cycle.collect_batch(sources, "fuzu").collect()
    assert [(r["posting_url"], r["seq"]) for r in only] == [("https://f.com/1", 1)]
    assert cycle.keep_house(store, AS_OF + timedelta(days=365)) == 2


def test_mark_notified_and_archived_as_frames(spark):
    rows = [(1, True, False, None, AS_OF, AS_OF - timedelta(days=181)), (2, True, False, None, AS_OF, AS_OF - timedelta(days=180))]
    df = spark.createDataFrame(
        rows, "id long, is_active boolean, is_notified boolean, notification_sent_at timestamp_ntz, "
        "updated_at timestamp_ntz, scrape_timestamp timestamp_ntz")
    later = AS_OF + timedelta(hours=1)
    marked = st.mark_notified(df, spark.createDataFrame([(2,)], "id long"), later).orderBy("id").collect()
    assert [(r["is_notified"], r["notification_sent_at"], r["updated_at"]) for r in marked] == [
        (False, None, AS_OF), (True, later, later)]
    assert [r["is_active"] for r in st.archived(df, AS_OF).orderBy("id").collect()] == [False, True]
