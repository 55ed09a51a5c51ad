import os
from datetime import date, timedelta

from pyspark.sql import functions as F

from rolelake.plans import records, store as st, views
from test_store import AS_OF, batch

VIEWS = ("daily_stats", "trending_keywords", "company_stats", "global_stats")


def same(store, as_of):
    for name in VIEWS:
        want = getattr(views, name)(store.postings(), as_of)
        got = store.analysis(name, as_of)
        assert got.columns == want.columns
        assert got.collect() == want.collect(), name


def test_views_from_summaries_equal_those_from_postings(spark, tmp_path):
    store = st.PostingStore(spark, str(tmp_path / "tables"))
    def insert(first, at):
        rows = [(k, f"https://a.com/{k}", "Job", "Fuzu" if k % 3 else "Other", [None, [], ["SQL"], ["SQL", "Python"]][k % 4]) for k in range(first, first + 6)]
        company = F.when(F.col("seq") % 5 > 0, F.concat(F.lit("c"), (F.col("seq") % 2).cast("string")))
        store.insert(records.stored_record(batch(spark, rows).withColumn("company", company)), at)

    for k, (days, hours) in enumerate(((200, 0), (30, 3), (0, 0))):
        insert(k * 10, AS_OF - timedelta(days=days, hours=hours))
        if k == 1:
            store.summarise()
    same(store, AS_OF)
    store.summarise()
    some = store.waiting().orderBy("id").limit(4)
    store.report(some, AS_OF)
    assert store.archive(AS_OF) == 6
    first = store.read(st.POSTINGS).where(F.col("scrape_date") == date(2024, 1, 2)).select("id")
    store.relabel(first.withColumn("keywords_matched", F.array(F.lit("Rust"))), AS_OF)
    same(store, AS_OF)
    folder = tmp_path / "tables" / "summaries" / "source_days"
    before = {d: sorted(os.listdir(folder / d)) for d in os.listdir(folder) if d.startswith("scrape_date")}
    store.summarise()
    after = {d: sorted(os.listdir(folder / d)) for d in before}
    changed = {d[12:] for d in before if before[d] != after[d]}
    assert {"2023-07-16", "2024-01-02"} <= changed and "2024-02-01" not in changed
    same(store, AS_OF)
    assert store._unsummarised()[0] == []
