from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rolelake.plans import records, views

AS_OF = datetime(2024, 2, 1, 12, 0)
SCHEMA = (
    "id long, company string, source string, scrape_timestamp timestamp_ntz, "
    "keywords_matched array<string>, is_active boolean, is_notified boolean"
)


def jobs(spark, rows):
    texts = ("job_title", "location", "salary_text", "posting_url", "description_snippet")
    return (
        spark.createDataFrame(rows, SCHEMA)
        .withColumns({c: F.lit("x") for c in texts})
        .withColumn("posted_date", F.to_date("scrape_timestamp"))
        .withColumn("keyword_match_count", records.keyword_count())
        .withColumn("scrape_date", F.to_date("scrape_timestamp"))
    )


def ago(**span):
    return AS_OF - timedelta(**span)


@pytest.fixture
def table(spark):
    return jobs(spark, [
        (1, "a", "Fuzu", ago(hours=1), ["SQL"], True, False),
        (2, "a", "Other", ago(hours=24), ["AWS", "SQL"], True, True),
        (3, None, "Fuzu", ago(days=7), ["SQL", "R"], True, False),
        (4, "b", "Fuzu", ago(days=30), ["AWS"], True, False),
        (5, "b", "Fuzu", ago(days=60), ["AWS"], False, False),
        (6, "c", "Fuzu", ago(hours=2), None, True, False),
        (7, "a", "Fuzu", ago(days=8), [], False, True),
        (8, "c", "Other", None, ["SQL", "AWS"], True, False),
    ])


def ids(df, column="id"):
    return [r[column] for r in df.collect()]


def test_time_limits_and_order(table):
    # "within 7 days" leaves out the row exactly 7 days old; "last 24 hours" keeps its edge.
    assert ids(views.recent_matched(table, AS_OF)) == [2, 1]
    assert ids(views.new_with_keywords(table, AS_OF)) == [2, 1]
    assert ids(views.new_with_keywords(table, AS_OF, 24, 2)) == [2]
    assert ids(views.by_source(table, "Fuzu", AS_OF)) == [1, 6, 3]
    # A null time sorts first among equal counts.
    assert ids(views.unnotified(table)) == [8, 3, 1, 4]
    assert ids(views.unnotified(table, 2)) == [8, 3]
    assert ids(views.unnotified_brief(table), "job_id") == [8, 3, 1, 4]
    assert ids(views.keyword_search(table, ["AWS", "nothing"]), "job_id") == [8, 2, 4]
    assert views.keyword_search(table, []).count() == 0


def test_unnotified_respects_the_state_table(spark, table):
    reported = spark.createDataFrame([(8, AS_OF), (4, AS_OF), (4, AS_OF)], "id long, sent_at timestamp_ntz")
    assert ids(views.unnotified(table, 1, reported)) == [3, 1]


def test_partition_filter_reaches_the_scan(spark, table, tmp_path):
    path = str(tmp_path / "jobs")
    table.where("scrape_date is not null").write.partitionBy("scrape_date").parquet(path)
    stored = spark.read.parquet(path)
    plan = views.recent_matched(stored, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scrape_date" in plan
    assert ids(views.recent_matched(stored, AS_OF)) == [2, 1]


def test_aggregates(table):
    daily = {(str(r["scrape_date"]), r["source"]): r for r in views.daily_stats(table, AS_OF).collect()}
    assert ("2024-01-02", "Fuzu") not in daily  # exactly 30 days old
    today = daily["2024-02-01", "Fuzu"]
    assert (today["total_jobs"], today["matched_jobs"], today["avg_keywords"], today["notified_jobs"]) == (2, 1, 0.5, 0)

    trending = [tuple(r) for r in views.trending_keywords(table, AS_OF).collect()]
    assert trending == [("SQL", 3, 2, ago(hours=1)), ("AWS", 1, 1, ago(hours=24)), ("R", 1, 1, ago(days=7))]

    assert [tuple(r) for r in views.company_stats(table, AS_OF).collect()] == [
        ("a", 3, 2, ago(days=8), ago(hours=1), ["Fuzu", "Other"])]

    stats = views.global_stats(table, AS_OF).first()
    assert (stats["total_jobs"], stats["total_sources"], stats["jobs_with_keywords"], stats["jobs_last_24h"],
            stats["jobs_last_7d"], stats["last_scrape"]) == (6, 2, 5, 3, 4, ago(hours=1))

    assert tuple(views.digest_summary(table.where("id in (1, 2, 3)")).first()) == (3, 5, 2, 2)
    assert [(r["id"], r["position"]) for r in views.digest_rank(table.where("id < 4")).orderBy("position").collect()] == [
        (2, 1), (3, 2), (1, 3)]


def test_batch_analysis(spark, table):
    scored = table.withColumn("keyword_score", F.size("keywords_matched") * F.lit(1.5))
    got = views.batch_analysis(scored.where("id in (1, 2, 3, 7)"), k=2).first()
    assert (got["total_jobs"], got["avg_score"], got["max_score"], got["min_score"]) == (4, 1.875, 3.0, 0.0)
    assert (got["total_unique_keywords"], got["avg_keywords_per_job"]) == (3, 1.25)
    assert [tuple(k) for k in got["top_keywords"]] == [("SQL", 3), ("AWS", 1)]


def test_empty_inputs(table):
    none = table.where("id < 0")
    stats = views.global_stats(none, AS_OF).first()
    assert (stats["total_jobs"], stats["last_scrape"], stats["avg_keyword_count"]) == (0, None, None)
    empty = views.batch_analysis(none.withColumn("keyword_score", F.lit(0.0))).first()
    assert tuple(empty) == (0, 0.0, 0.0, 0.0, 0, 0.0, [])
    assert tuple(views.digest_summary(none).first()) == (0, 0, 0, 0)
    assert tuple(views.match_rate(none, "keyword_match_count").first()) == (0, 0)
    assert views.digest_rank(none).count() == 0
    assert views.trending_keywords(none, AS_OF).count() == 0


def test_views_by_name(spark, table):
    views.register_views(table, AS_OF)
    direct = views.trending_keywords(table, AS_OF)
    assert spark.sql("SELECT * FROM trending_keywords").collect() == direct.collect()
    for name in ("recent_matched_jobs", "daily_job_stats", "company_hiring_stats"):
        assert spark.table(name).count() > 0
