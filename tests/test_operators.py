from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rolelake.operators import dedup, joins, quality, ranking


def test_validation(spark):
    rows = [
        ("t", "https://a.com/1", "Fuzu"),
        ("t", None, None),
        ("", "nope", "Fuzu"),
        ("t", "https://a.com/1", "Elsewhere"),
    ]
    df = spark.createDataFrame(rows, "job_title string, posting_url string, source string")
    got = quality.with_validation(df).collect()
    assert [r["valid"] for r in got] == [True, False, False, False]
    assert [r["errors"] for r in got] == [
        [],
        ["Missing required field: posting_url", "Missing required field: source", "Invalid source: None"],
        ["Missing required field: job_title", "Invalid posting URL"],
        ["Invalid source: Elsewhere"],
    ]
    assert quality.valid_rows(df).count() == 1


def test_constraints(spark):
    rows = [("k", 3, None), (None, 6, "c" * 51), ("k" * 101, None, "c")]
    df = spark.createDataFrame(rows, "keyword string, priority int, category string")
    errors = [
        r[0] for r in df.select(quality.constraint_errors(quality.KEYWORD_PRIORITY_CONSTRAINTS)).collect()
    ]
    assert errors == [
        [],
        ["keyword is null", "priority is not in 1..5", "category is longer than 50"],
        ["keyword is longer than 100"],
    ]


def test_first_and_last_wins(spark):
    rows = [("u1", 1, "a"), ("u2", 2, "b"), ("u1", 3, "c")]
    df = spark.createDataFrame(rows, "url string, seq int, v string")
    assert sorted(map(tuple, dedup.first_wins(df, "url", "seq").collect())) == [
        ("u1", 1, "a"), ("u2", 2, "b"),
    ]
    last = dedup.last_wins(df, "url", "seq").orderBy("position").collect()
    assert [tuple(r) for r in last] == [("u1", 3, "c", 1), ("u2", 2, "b", 2)]


def test_first_wins_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.first_wins(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_key_dedup(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("u"), "id"
    )
    assert dedup.first_wins(df, "u", "id").count() == 20_001
    assert dedup.last_wins(df, "u", "id").where("u = 'hot'").first()["id"] == 29_997


def test_union_sources(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2,), (2,)], "a int")
    got = dedup.union_sources([a, b]).collect()
    assert sorted(map(tuple, got), key=str) == [(1, "x"), (2, None), (2, None)]


def test_union_with_fallback(spark):
    fast = spark.createDataFrame([("q1", 1), ("q1", 2)], "q string, v int")
    slow = spark.createDataFrame([("q1", 3), ("q1", 4), ("q1", 5), ("q2", 6), (None, 7)], "q string, v int")
    last = spark.createDataFrame([("q2", 8), ("q3", 9), (None, 10)], "q string, v int")
    got = dedup.union_with_fallback([fast, slow, last], "q").collect()
    assert sorted(r["v"] for r in got) == [1, 2, 6, 7, 9]
    overall = dedup.union_with_fallback([fast.where("false"), slow, last], None).collect()
    assert sorted(r["v"] for r in overall) == [3, 4, 5, 6, 7]
    assert dedup.union_with_fallback([fast, slow], None).count() == 2


def test_insert_if_absent(spark):
    batch = spark.createDataFrame([("u1", 1, "a"), ("u2", 2, "b"), ("u2", 3, "c")], "u string, seq int, v string")
    existing = spark.createDataFrame([("u1", "old")], "u string, v string")
    got = dedup.insert_if_absent(batch, existing, "u", "seq").collect()
    assert [tuple(r) for r in got] == [("u2", 2, "b")]
    assert dedup.insert_if_absent(batch, batch, "u", "seq").count() == 0


def test_merge_update(spark):
    base = spark.createDataFrame([(1, ["a"]), (2, ["b"])], "id int, k array<string>")
    updates = spark.createDataFrame([(2, [])], "id int, k array<string>")
    got = dedup.merge_update(base, updates, "id", ["k"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, ["a"]), (2, [])]


@pytest.mark.parametrize("limit", [10, 1])
def test_lookup_join(spark, limit):
    facts = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("k"))
    lookup = spark.createDataFrame([("0", "x"), ("0", "y"), ("1", "z")], "k string, v string")
    got = joins.lookup_join(facts, lookup, "k", "id", "left", broadcast_rows=limit)
    assert got.groupBy("v").count().orderBy("v").collect() == [(None, 33), ("x", 34), ("y", 34), ("z", 33)]
    inner = joins.lookup_join(facts, lookup, "k", "id", "inner", broadcast_rows=limit)
    assert inner.count() == 101


def test_top_matches_is_stable(spark):
    rows = [(i, n, [str(k) for k in range(n)]) for i, n in enumerate([2, 6, 2, 0, 6, 1, 3])]
    df = spark.createDataFrame(rows, "seq int, keyword_count int, keywords_matched array<string>")
    got = ranking.top_matches(df, k=5).collect()
    assert [r["seq"] for r in got] == [1, 4, 6, 0, 2]
    assert got[0]["keywords_shown"] == ["0", "1", "2", "3"]


def test_top_keywords_breaks_ties_by_keyword(spark):
    df = spark.createDataFrame([(["b", "a"],), (["c", "a"],), (None,), ([],)], "keywords_matched array<string>")
    assert [tuple(r) for r in ranking.top_keywords(df, 2).collect()] == [("a", 2), ("b", 1)]


def test_newest_unlabelled(spark):
    rows = [
        (1, datetime(2024, 1, 1), ["a"], 1), (2, datetime(2024, 1, 2), None, None),
        (3, datetime(2024, 1, 3), [], 0), (4, None, [], 0),
    ]
    df = spark.createDataFrame(
        rows, "id int, scrape_timestamp timestamp_ntz, keywords_matched array<string>, keyword_match_count int"
    ).withColumns({c: F.lit("x") for c in ("job_title", "description_snippet", "full_description")})
    assert [r["id"] for r in ranking.newest_unlabelled(df, 2).collect()] == [4, 3]


def test_global_rank_over_many_partitions(spark):
    df = spark.range(5_000).select("id", (F.col("id") * 7919 % 5_003).alias("v")).repartition(7)
    got = ranking.global_rank(df, [F.desc("v"), F.asc("id")], "pos").orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(1, 5_001))
    assert [r["v"] for r in got] == sorted((r["v"] for r in got), reverse=True)
    assert ranking.global_rank(df.where("false"), [F.desc("v")], "pos").count() == 0
