"""Duplicates and unions.  Row order is never implied: ``seq`` states it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rolelake.operators.joins import rows_already_in


def _tie_break(df: DataFrame) -> Column:
    """Makes a choice among rows with equal ``seq`` that is the same in every run."""
    return F.xxhash64(*[F.col(c) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def first_wins(df: DataFrame, key: str | Sequence[str], seq: str) -> DataFrame:
    """The row with the lowest ``seq`` per key; of equals always the same one.

    Spark applies a row-number limit before the shuffle too, so of a hot key only one row
    per map task travels.
    """
    keys = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*keys).orderBy(F.col(seq).asc_nulls_last(), _tie_break(df))
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def last_wins(
    df: DataFrame, key: str | Sequence[str], seq: str, position: str = "position"
) -> DataFrame:
    """The row with the highest ``seq`` per key, at the position of the key's lowest ``seq``.

    An aggregate with map-side combine, so a hot key does not gather in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    carried = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.max_by(F.struct(*carried), F.struct(F.col(seq), _tie_break(df))).alias("_row"), F.min(seq).alias(position)
    )
    return best.select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns], position
    )


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns that a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def union_with_fallback(methods: Sequence[DataFrame], group: str | None) -> DataFrame:
    """Per group, the rows of the first method that has any; without a group, overall.

    Written as anti joins against the groups that earlier methods cover.  A hot group's rows may
    meet in one partition of a join, which the engine's skew handling splits.
    """
    if group is None:
        kept = [methods[0]]
        for i, method in enumerate(methods[1:], start=1):
            for earlier in methods[:i]:
                method = method.where(~earlier.exists())
            kept.append(method)
        return union_sources(kept)
    kept, covered = [methods[0]], methods[0].select(group).distinct()
    for method in methods[1:]:
        kept.append(absent_groups(method, covered, group))
        covered = covered.union(method.select(group)).distinct()
    return union_sources(kept)


def absent_groups(rows: DataFrame, covered: DataFrame, group: str) -> DataFrame:
    """Rows whose group is not covered; a null group counts as a group of its own."""
    other = covered.select(F.col(group).alias("_covered"))
    return rows.join(other, F.col(group).eqNullSafe(F.col("_covered")), "left_anti")


def insert_if_absent(batch: DataFrame, existing: DataFrame, key: str, seq: str) -> DataFrame:
    """Rows to add: the first of each key in the batch, unless the key exists already.

    Duplicates go first: that thins out hot keys before rows meet in the join, and leaves
    the rows partitioned by the key that the join needs.
    """
    present = rows_already_in(batch, existing, key)
    return first_wins(batch, key, seq).join(present, key, "left_anti")


def merge_update(
    base: DataFrame, updates: DataFrame, key: str, columns: Sequence[str], seq: str | None = None
) -> DataFrame:
    """Left update join: ``columns`` take the update's value where there is one.

    Of several updates for one key the one with the highest ``seq`` is taken, as if they were applied
    in turn; without ``seq``, or among equals, always the same one.  No base row is ever repeated.
    """
    order = F.struct(*([seq] if seq else []), _tie_break(updates).alias("_tie"))
    last = updates.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("_last"))
    changes = last.select(key, *[F.col("_last")[c].alias(f"_new_{c}") for c in columns])
    joined = base.join(changes, key, "left")
    return joined.select(
        *[
            F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c)
            for c in base.columns
        ]
    )
