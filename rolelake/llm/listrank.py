"""Distributed list ranking: how far each element of a linked list is from its end.

In each round the elements whose hash is less than those of both neighbours leave the list, a third of it on average
and never two in a row, and the element before takes over their length.  When few are left, one task ranks them; then
the rounds are undone from the last to the first.  All rounds together handle some three times the list.  An element
is one row with two neighbours, so no key is ever hot.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rolelake.operators.durable import stored
from rolelake.shipping import ship

#: Elements that one task ranks.
FEW = 1 << 15


def _drawn(element: Column, turn: int) -> Column:
    """A number that has nothing to do with the order of elements, another one in each round."""
    return F.xxhash64(F.lit(turn), element)


def _ranked(left: pa.Table) -> pa.Table:
    """Ranks of at most FEW elements, from the ends backward."""
    ids, following, lengths = (left.column(c).to_pylist() for c in ("id", "next", "length"))
    before = {n: (i, length) for i, n, length in zip(ids, following, lengths, strict=True) if n is not None}
    ranks = {i: length for i, n, length in zip(ids, following, lengths, strict=True) if n is None}
    for end in list(ranks):
        at = end
        while at in before:
            earlier, length = before[at]
            ranks[earlier] = ranks[at] + length
            at = earlier
    return pa.table({"id": pa.array(ranks.keys(), pa.int64()), "rank": pa.array(ranks.values(), pa.int64())})


def ranked(links: DataFrame) -> DataFrame:
    """Columns id and rank: the number of elements from an element to the end of its list, itself included.

    ``links``: id and next, one row for each element, both long; next is null at the end of a list.  An element is
    the next of one other at most, and there is no circle.  An empty table has no ranks.
    """
    ship(links.sparkSession)
    ends = links.select("id", "next", F.lit(None).cast("long").alias("prev")).unionByName(
        links.filter("next is not null").select(F.col("next").alias("id"), F.lit(None).cast("long").alias("next"), F.col("id").alias("prev"))
    )
    current = stored(ends.groupBy("id").agg(F.max("next").alias("next"), F.max("prev").alias("prev"), F.lit(1).cast("long").alias("length")))
    removed: list[DataFrame] = []
    while current.count() > FEW:
        turn = len(removed)
        own = _drawn(F.col("id"), turn)
        leaves = F.coalesce((own < _drawn(F.col("prev"), turn)) & (own < _drawn(F.col("next"), turn)) & F.col("prev").isNotNull() & F.col("next").isNotNull(), F.lit(False))
        removed.append(current.filter(leaves).select("id", "next", "length"))
        none = F.lit(None).cast("long")
        rest = current.filter(~leaves).select("id", "next", "prev", "length", none.alias("_next"), none.alias("_prev"))
        to_earlier = current.filter(leaves).select(F.col("prev").alias("id"), none.alias("next"), none.alias("prev"), "length", F.col("next").alias("_next"), none.alias("_prev"))
        to_later = current.filter(leaves).select(F.col("next").alias("id"), none.alias("next"), none.alias("prev"), F.lit(0).cast("long").alias("length"), none.alias("_next"), F.col("prev").alias("_prev"))
        met = rest.unionByName(to_earlier).unionByName(to_later).groupBy("id")
        current = stored(
            met.agg(
                F.coalesce(F.max("_next"), F.max("next")).alias("next"), F.coalesce(F.max("_prev"), F.max("prev")).alias("prev"), F.sum("length").alias("length")
            )
        )
    known = stored(current.groupBy(F.lit(0).alias("_all")).applyInArrow(_ranked, "id long, rank long"))
    for gone in reversed(removed):
        later = known.select(F.col("id").alias("_id"), F.col("rank").alias("_rank"))
        found = gone.join(later, F.col("next") == F.col("_id")).select("id", (F.col("length") + F.col("_rank")).alias("rank"))
        known = known.unionByName(stored(found))
    return known
