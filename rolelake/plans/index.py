"""Stored access paths to the postings table: posting lists by keyword, and URL keys by bucket.

Both are hints that may say too much, never too little: a search checks the rows that it finds, and
they are written before, or rebuilt after, what they point to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rolelake.operators.dedup import first_wins
from rolelake.operators.joins import rows_with_key_in
from rolelake.plans.views import keyword_search


class KeywordIndex:
    """Posting lists (keyword, id, scrape_date) under one folder, partitioned by the keyword's hash.

    A search reads the buckets of its keywords, then only the days and ids that they name, and checks those rows
    themselves; so entries may be left over from before a re-labelling, and entries repeated.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        # Makes the folder where it is missing, and leaves an existing index alone.
        self._write(self._shape(spark.range(0).select(F.lit("").alias("keyword"), "id", F.lit(None).cast("date").alias("scrape_date"))), "ignore")

    def _bucket(self, keyword: Column) -> Column:
        return F.pmod(F.xxhash64(keyword), F.lit(self.buckets)).cast("int")

    def _shape(self, entries: DataFrame) -> DataFrame:
        return entries.select("keyword", "id", "scrape_date", self._bucket(F.col("keyword")).alias("bucket"))

    def _write(self, entries: DataFrame, mode: str) -> None:
        # The rebalance splits the list of a frequent keyword over several files.
        ordered = entries.hint("rebalance", "bucket").sortWithinPartitions("bucket", "keyword", "scrape_date")
        ordered.write.mode(mode).partitionBy("bucket").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema("keyword string, id bigint, scrape_date date, bucket int").parquet(self.path)

    def add(self, postings: DataFrame) -> None:
        """Add the keywords of these postings (id, scrape_date, keywords_matched).  A null or empty list adds nothing."""
        listed = postings.select(F.explode(F.array_distinct("keywords_matched")).alias("keyword"), "id", "scrape_date")
        self._write(self._shape(listed.where("keyword is not null")), "append")

    def candidates(self, keywords: Sequence[str]) -> DataFrame:
        """Days and ids that have, or had, any of the keywords; reads no other buckets."""
        wanted = [F.lit(k).cast("string") for k in keywords]
        if not wanted:
            return self.read().where(F.lit(False)).select("scrape_date", "id")
        lists = self.read().where(F.col("bucket").isin(*[self._bucket(k) for k in wanted]) & F.col("keyword").isin(*wanted))
        return lists.select("scrape_date", "id").distinct()

    def search(self, postings: DataFrame, keywords: Sequence[str]) -> DataFrame:
        """Active postings that have any of the keywords, best first, as :func:`views.keyword_search` on all of them."""
        found = self.candidates(keywords)
        # One row for each day; postings are partitioned by it.
        days = [r["scrape_date"] for r in found.select("scrape_date").distinct().collect()]
        named = F.col("scrape_date").isin(*[d for d in days if d is not None])
        of_days = postings.where(named | F.col("scrape_date").isNull() if None in days else named)
        return keyword_search(rows_with_key_in(of_days, found.select("id").distinct(), "id"), keywords)

    def compact(self, postings: DataFrame) -> None:
        """Write the lists anew from the postings as they are, without entries that no longer hold."""
        listed = postings.select(F.explode(F.array_distinct("keywords_matched")).alias("keyword"), "id", "scrape_date")
        self._write(self._shape(listed.where("keyword is not null")), "overwrite")


class UrlKeys:
    """The URLs of all stored postings, in files by hash bucket, so that a join with them shuffles only the other side.

    A table of the session's catalog whose files lie in a folder of ours; another session finds the files again.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"url_keys_{hashlib.md5(path.encode()).hexdigest()[:16]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (posting_url STRING) USING parquet "
            f"CLUSTERED BY (posting_url) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, rows: DataFrame) -> None:
        """Add the URLs of these rows; those without one have no key."""
        keys = rows.where("posting_url is not null").select("posting_url")
        keys.repartition(self.buckets, "posting_url").write.mode("append").insertInto(self.table)

    def rebuild(self, rows: DataFrame) -> None:
        """Write the keys anew from all rows."""
        keys = rows.where("posting_url is not null").select("posting_url").distinct()
        keys.repartition(self.buckets, "posting_url").write.mode("overwrite").insertInto(self.table)

    def absent(self, batch: DataFrame, seq: str = "seq") -> DataFrame:
        """The first row of each URL in the batch whose URL isn't stored.

        The batch is dealt out as the files are; the stored keys stay where they are.
        """
        first = first_wins(batch, "posting_url", seq).repartition(self.buckets, "posting_url")
        return first.join(self.read().hint("merge"), "posting_url", "left_anti").select(*batch.columns)
