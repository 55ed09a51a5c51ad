import shutil
from collections import Counter, defaultdict

import pytest

from rolelake.llm import sharding


def shards(docs, n=7, buckets=5, **more):
    return sharding.shuffled_shards(docs.select("doc_id", "text", "lang"), n, buckets, **more)


@pytest.mark.parametrize("rows", [0, 1, 3, 200])
def test_counts_slots_and_reruns(documents, prose, rows):
    docs = documents([(i if i % 5 else None, prose(i % 20, 3) if i % 7 else None, "en", "s") for i in range(rows)])
    got = shards(docs).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert len(got) == rows and all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(7))
    key = lambda r: (str(r["_row"]), r["shard"], r["slot"])
    assert sorted(map(key, got)) == sorted(map(key, shards(docs).collect()))
    assert Counter(tuple(r["_row"]) for r in got) == Counter(tuple(r) for r in docs.select("doc_id", "text", "lang").collect())


def test_order_is_shuffled_in_each_bucket(documents):
    docs = documents([(i, "t", "en", "s") for i in range(3000)])
    got = sorted(shards(docs, 1, 3).collect(), key=lambda r: r["slot"])
    ids = [r["_row"]["doc_id"] for r in got]
    rising = sum(a < b for a, b in zip(ids, ids[1:])) / len(ids)
    assert 0.45 < rising < 0.55 and [r["bucket"] for r in got] == sorted(r["bucket"] for r in got)
    other = sorted(shards(docs, 1, 3, seed=2).collect(), key=lambda r: r["slot"])
    assert ids != [r["_row"]["doc_id"] for r in other]


def test_every_place_is_as_likely(documents):
    docs = documents([(i, "t", "en", "s") for i in range(40)])
    places = [next(r["slot"] for r in shards(docs, 1, 1, seed=s).collect() if r["_row"]["doc_id"] == 0) for s in range(12)]
    assert len(set(places)) > 6


def test_written_shards(spark, documents, prose, tmp_path):
    docs = documents([(i, prose(i, 5), "en", "s") for i in range(50)])
    sharding.write_shards(shards(docs, 4, 3), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and back.groupBy("_shard").count().filter("count between 12 and 13").count() == 4


def test_bucket_count(documents):
    from pyspark.sql import functions as F

    docs = documents([(i, "x" * 100, "en", "s") for i in range(50)])
    assert sharding.bucket_count(docs, F.length("text"), 1000) == 5
    assert sharding.bucket_count(documents([]), F.length("text"), 1000) == 1


def test_query_shards_whole_rows_and_spreads_equal_ones(spark, documents, tmp_path, monkeypatch):
    from rolelake.llm import queries

    rows = [(1, "the same text " * 10, "en", "s")] * 300 + [(i, f"text {i}", "en", "s") for i in range(2, 102)] + [(None, None, None, None)]
    docs = documents(rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries, "BUCKET_BYTES", 6_000)
    monkeypatch.setattr(queries, "shared_folder", lambda spark: str(tmp_path / "shards"))
    got = queries.op9_two_pass_shards(spark, str(tmp_path)).collect()
    assert len(got) == 401 and sorted(r["size"] for r in got) == sorted(len(r[1] or "") + 1 for r in rows)
    assert len({r["bucket"] for r in got if r["doc_id"] == 1}) > 4
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter((r["doc_id"], r["text"], r["lang"], r["source"]) for r in back.collect()) == Counter(rows)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(by) == 16


def test_query_stands_clashing_columns_and_another_path(spark, tmp_path, monkeypatch):
    from rolelake.llm import queries

    rows = [(i, None if i == 3 else f"text {i % 40}", "b", "s", "S", "f", "p", "h", "i", "m", "r") for i in range(90)]
    named = "doc_id long, text string, bucket string, _slot string, _Shard string, _file string, _place string, _hash string, _items string, _metadata string, _row string"
    spark.createDataFrame(rows, named).coalesce(1).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    shutil.copytree(tmp_path / "a", tmp_path / "b")
    monkeypatch.setattr(queries, "BUCKET_BYTES", 200)
    got = []
    for name in ("a", "b"):
        monkeypatch.setattr(queries, "shared_folder", lambda spark, name=name: str(tmp_path / f"shards-{name}"))
        got.append(sorted(map(tuple, queries.op9_two_pass_shards(spark, str(tmp_path / name)).collect())))
    assert got[0] == got[1] and len(got[0]) == 90
    back = spark.read.parquet(str(tmp_path / "shards-a")).select("doc_id", "text", "bucket", "_slot", "_Shard", "_file", "_metadata").collect()
    assert sorted(tuple(r) for r in back if r["text"]) == sorted((r[0], r[1], "b", "s", "S", "f", "m") for r in rows if r[1])
