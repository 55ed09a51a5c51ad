"""Posting lists, URL keys, the queue of what is to be reported, and SQL functions over the stored tables."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rolelake.plans import cycle, index, records, sqlfunctions, store as st, views
from test_store import batch

AS_OF = datetime(2024, 2, 1, 12, 0)


@pytest.fixture
def store(spark, tmp_path):
    return st.PostingStore(spark, str(tmp_path / "tables"))


def stored_rows(spark, rows, source="Fuzu"):
    """rows: (url, keywords)"""
    return records.stored_record(batch(spark, [(k, url, f"title {k}", source, words) for k, (url, words) in enumerate(rows)]))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def urls(df):
    return sorted(r["posting_url"] for r in df.collect())


def test_search_reads_only_the_lists_and_days_it_needs(spark, store):
    for day in range(3):
        rows = [(f"https://a.com/{day}/{k}", [["SQL"], ["Python", "SQL"], [], None, [f"Only{day}"]][k % 5]) for k in range(10)]
        store.insert(stored_rows(spark, rows), AS_OF + timedelta(days=day))
    for words in (["SQL"], ["Python", "Only1"], ["Only2"], ["Absent"], []):
        want = views.keyword_search(store.read(st.POSTINGS), words).collect()
        assert store.search(words).collect() == want
    lists = plan_of(store.keywords.candidates(["Only1"]))
    (buckets,) = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", lists)
    assert re.search(r"bucket#\d+ = \d+|bucket#\d+ IN \(\d+\)", buckets) and "PushedFilters: [" in lists and "keyword" in lists
    assert "scrape_date" in re.findall(r"PartitionFilters: \[(.*?)\]", plan_of(store.search(["Only1"])))[0]


def test_search_after_relabelling_and_compaction(spark, store):
    store.insert(stored_rows(spark, [(f"https://a.com/{k}", ["SQL"] if k % 2 else []) for k in range(8)]), AS_OF)
    ids = [r["id"] for r in store.read(st.POSTINGS).orderBy("id").collect()]
    updates = [(ids[0], ["New"], 1), (ids[0], ["Newer"], 2), (ids[1], ["Newer"], 1), (ids[1], [], 0)]
    store.relabel(spark.createDataFrame(updates, "id long, keywords_matched array<string>, step int"), AS_OF, "step")
    now = store.read(st.POSTINGS)
    assert {r["id"]: r["keywords_matched"] for r in now.where(F.col("id").isin(ids[:2])).collect()} == {ids[0]: ["Newer"], ids[1]: ["Newer"]}
    for words in (["SQL"], ["New"], ["Newer"], ["Newer", "SQL"]):
        assert store.search(words).collect() == views.keyword_search(now, words).collect()
    before = store.keywords.read().count()
    store.keywords.compact(now)
    assert store.keywords.read().count() < before
    assert store.search(["Newer", "SQL"]).collect() == views.keyword_search(now, ["Newer", "SQL"]).collect()


def test_keys_are_joined_where_they_lie(spark, tmp_path):
    keys = index.UrlKeys(spark, str(tmp_path / "keys"), buckets=8)
    keys.rebuild(spark.range(500).select(F.concat(F.lit("u"), "id").alias("posting_url")))
    keys.add(spark.createDataFrame([("x",), (None,)], "posting_url string"))
    rows = spark.createDataFrame([("u1", 1, "a"), ("new", 3, "late"), ("new", 2, "first"), ("x", 4, "b"), (None, 5, "no url")], "posting_url string, seq long, k string")
    found = keys.absent(rows)
    assert sorted(map(tuple, found.where("posting_url is not null").collect())) == [("new", 2, "first")]
    # Below the join, the side of the stored keys has a scan and no exchange.
    plan = plan_of(found)
    history = plan[: plan.index("url_keys_")].splitlines()[-1:] + plan[plan.index("Join") :].split("url_keys_")[0].splitlines()[-6:]
    assert "Bucketed: true" in plan and not any("Exchange" in line for line in history[-3:])
    # Another session of the same files finds them.
    spark.sql(f"DROP TABLE {keys.table}")
    assert index.UrlKeys(spark, str(tmp_path / "keys"), buckets=8).read().count() == 501


def test_insert_after_an_interrupted_one(spark, store, monkeypatch):
    first = stored_rows(spark, [("https://a.com/1", ["SQL"]), ("https://a.com/2", [])])

    def lost(rows):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(store.urls, "add", lost)
    with pytest.raises(RuntimeError):
        store.insert(first, AS_OF)
    monkeypatch.undo()
    done = store.insert(first, AS_OF)
    assert (done.inserted, done.duplicates) == (0, 2)
    more = store.insert(stored_rows(spark, [("https://a.com/3", ["SQL"])]), AS_OF)
    assert more.inserted == 1 and store.read(st.POSTINGS).select("id").distinct().count() == 3
    assert urls(store.search(["SQL"])) == ["https://a.com/1", "https://a.com/3"]


def test_ids_continue_after_the_stored_mark(spark, store):
    highs = []
    for day in range(3):
        done = store.insert(stored_rows(spark, [(f"https://a.com/{day}", [])]), AS_OF + timedelta(days=day))
        highs.append(done.rows.first()["id"])
    assert highs == sorted(set(highs))
    assert "postings" not in "".join(re.findall(r"Location: \S+ ?\[([^\]]*)\]", plan_of(store.urls.absent(stored_rows(spark, [("https://a.com/9", [])])))))


def test_queue(spark, store):
    sent = []

    def run(as_of, least=1):
        sent.clear()
        return cycle.notify_once(store, lambda df: sent.extend(urls(df)) or True, "a@b.c", as_of, least)

    day = timedelta(days=1)
    store.insert(stored_rows(spark, [("https://a.com/1", ["A"]), ("https://a.com/2", ["A", "B"]), ("https://a.com/3", [])]), AS_OF)
    assert run(AS_OF, 2) == 1 and sent == ["https://a.com/2"]
    store.insert(stored_rows(spark, [("https://a.com/4", ["A", "B"]), ("https://a.com/5", ["B"])]), AS_OF + day)
    assert run(AS_OF + day, 2) == 1 and sent == ["https://a.com/4"]
    # With a lower limit what was left from earlier days comes up.
    assert run(AS_OF + day) == 2 and sent == ["https://a.com/1", "https://a.com/5"]
    # A run that catches up on an earlier day is not overlooked.
    store.insert(stored_rows(spark, [("https://a.com/6", ["A"])]), AS_OF - 3 * day)
    assert run(AS_OF - 3 * day) == 1 and sent == ["https://a.com/6"] and run(AS_OF + day) == 0
    # What gets keywords later waits again, what was reported doesn't.
    ids = {r["posting_url"]: r["id"] for r in store.read(st.POSTINGS).collect()}
    updates = [(ids["https://a.com/3"], ["C"]), (ids["https://a.com/1"], ["C"])]
    store.relabel(spark.createDataFrame(updates, "id long, keywords_matched array<string>"), AS_OF + 2 * day)
    assert run(AS_OF + 2 * day) == 1 and sent == ["https://a.com/3"]
    assert run(AS_OF + 9 * day) == 0
    assert views.unnotified(store.postings()).count() == 0


def test_functions_by_name(spark, store):
    old = AS_OF - timedelta(days=200)
    store.insert(stored_rows(spark, [("https://a.com/1", ["SQL"]), ("https://a.com/2", ["Python"])]), old)
    store.insert(stored_rows(spark, [("https://a.com/3", ["SQL", "Python"])], "Other"), AS_OF)
    cycle.notify_once(store, lambda df: True, "a@b.c", old, 1)
    sqlfunctions.register_store(store)
    found = spark.sql("SELECT posting_url FROM get_jobs_by_keywords(array('SQL'))").collect()
    assert sorted(r[0] for r in found) == ["https://a.com/1", "https://a.com/3"]
    assert spark.sql("SELECT * FROM get_unnotified_jobs()").count() == 0
    assert spark.sql("SELECT * FROM get_jobs_by_source('Other', TIMESTAMP_NTZ '2024-02-01 12:00:00', 1)").count() == 1
    assert sqlfunctions.call(store, "CALL archive_old_jobs(90)", AS_OF).first()["changed"] == 2
    assert sqlfunctions.call(store, "call archive_old_jobs();", AS_OF).first()["changed"] == 0
    assert spark.sql("SELECT * FROM get_jobs_by_keywords(array('SQL'))").count() == 1
    assert sqlfunctions.call(store, "CALL cleanup_old_logs(90)", AS_OF).first()["changed"] == 1
    assert store.read(st.NOTIFICATIONS).count() == 0
    with pytest.raises(ValueError):
        sqlfunctions.call(store, "CALL drop_everything(1)", AS_OF)


def test_run_goes_on_where_it_stopped(spark, store, monkeypatch):
    from rolelake.dictionaries import KeywordDictionary
    from rolelake.plans import runs

    moments = iter(AS_OF + timedelta(seconds=k) for k in range(100))
    asked = []

    def source(name, rows):
        def load():
            asked.append(name)
            if rows is None:
                raise OSError(f"{name} didn't answer\nsecond line")
            return batch(spark, rows)
        return load

    good = [(1, "https://a.com/1", "Data Engineer", "Fuzu", None), (2, "no url", "Bad", "Fuzu", None), (3, "https://a.com/3", "T" * 501, "Fuzu", None)]
    sources = {"good": source("good", good), "down": source("down", None), "empty": source("empty", [])}

    def run():
        log = runs.run_sources(store, "r1", sources, KeywordDictionary.of(), AS_OF, lambda: next(moments))
        return {r["source"]: (r["status"], r["jobs_found"], r["jobs_new"], r["jobs_failed"], r["error_message"]) for r in log.collect()}

    def broken(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(store, "insert", broken)
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.undo()
    partial = {r["source"]: (r["status"], r["scrape_end"]) for r in runs.run_rows(store.read(st.EVENTS)).collect()}
    assert partial["good"] == ("partial", None) and partial["down"][0] == "failed"
    assert run() == {
        "good": ("success", 3, 1, 2, None), "empty": ("success", 0, 0, 0, None), "down": ("failed", 0, 0, 0, "down didn't answer"),
    }
    # What was collected wasn't asked for again, what failed was.
    assert asked == ["good", "down", "empty", "down"]
    sources["down"] = source("down", [(1, "https://a.com/1", "Known", "Fuzu", None), (2, "https://a.com/9", "SQL Clerk", "Other", None)])
    assert run()["down"] == ("success", 2, 1, 0, None) and urls(store.read(st.POSTINGS)) == ["https://a.com/1", "https://a.com/9"]
    rejected = {(r["stage"], r["posting_url"], tuple(r["errors"])) for r in store.read(st.REJECTED_ROWS).collect()}
    assert rejected == {("validation", "no url", ("Invalid posting URL",)), ("constraint", "https://a.com/3", ("job_title is longer than 500",))}
    assert {(r["source"], r["status"]) for r in store.read(st.RUNS).collect()} >= {("good", "success"), ("empty", "success"), ("down", "failed"), ("down", "success")}
