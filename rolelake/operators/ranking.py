"""Sorting, top-k and global ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rolelake.operators.durable import cut_lineage
from rolelake.operators.matching import each_keyword

_PARTITION_BITS = 33  # monotonically_increasing_id keeps the row's number in the lower bits


def best_first(
    count: str = "keyword_match_count",
    newest: str = "scrape_timestamp",
    tie_break: str = "id",
) -> list[Column]:
    """Most keywords first, then newest; nulls first as in the original ordering."""
    return [F.desc_nulls_first(count), F.desc_nulls_first(newest), F.asc(tie_break)]


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of the order; each task keeps its own k rows."""
    return df.orderBy(*order).limit(k)


def top_matches(
    labelled: DataFrame, k: int = 5, shown_keywords: int = 4, count: str = "keyword_count", seq: str = "seq"
) -> DataFrame:
    """The k rows with most keywords, stable by ``seq``, with their first few keywords."""
    shown = labelled.withColumn("keywords_shown", F.slice("keywords_matched", 1, shown_keywords))
    return top_k(shown, [F.desc(count), F.asc(seq)], k)


def top_keywords(df: DataFrame, k: int = 10, keywords: str = "keywords_matched") -> DataFrame:
    """The k most frequent keywords; equal counts are ordered by keyword."""
    counts = each_keyword(df, keywords=keywords).groupBy("keyword").agg(F.count("*").alias("n"))
    return top_k(counts, [F.desc("n"), F.asc("keyword")], k)


def newest_unlabelled(df: DataFrame, k: int = 100) -> DataFrame:
    """The newest k rows that have no keywords yet."""
    lacking = df.where("keywords_matched is null or keyword_match_count = 0")
    return top_k(
        lacking.select(
            "id", "job_title", "description_snippet", "full_description", "scrape_timestamp"
        ),
        [F.desc_nulls_first("scrape_timestamp"), F.asc("id")],
        k,
    )


def global_rank(df: DataFrame, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """1-based position of every row in a total order, without one task seeing all rows.

    Rows are range-partitioned and sorted by the order, which must not have ties; the
    result is cut off durably, so that partition numbers cannot change.  A row's rank is
    its number in its partition plus the sizes of the partitions before it.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ordered.withColumn("_id", F.monotonically_increasing_id())
    fixed = cut_lineage(
        numbered.withColumn("_part", F.shiftright("_id", _PARTITION_BITS)).withColumn(
            "_row", F.col("_id").bitwiseAND((1 << _PARTITION_BITS) - 1)
        ).drop("_id")
    )
    sizes = fixed.groupBy("_part").agg(F.count("*").alias("_size"))
    # One row per partition, so this window and the broadcast are small whatever the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return (
        fixed.join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_before") + F.col("_row") + 1)
        .drop("_part", "_row", "_before")
    )
