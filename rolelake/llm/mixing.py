"""Mixing sources to target weights by weighted fair queueing.

Every document of a source gets a virtual finish time: the tokens of its source up to and with
it, in a seeded shuffled order, divided by the source's target.  Sources are repeated up to
``max_passes`` times, and a later pass goes on where the earlier one ended.  All (document,
pass) pairs are sorted by finish time over ranges of it and cut where the total budget is used
up, so at the cut every source has had its share.

Nothing is gathered: running totals are taken in two levels.  A source's documents are dealt
to about sqrt(rows) blocks by their shuffle key, blocks are totalled with map-side combine, and
only the totals are summed up in order.  Finish times are cut into about sqrt(rows) bins the
same way.  Tokens per bin are nearly equal by construction, as each source spreads its target
evenly over finish times 0 to 1.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from rolelake.operators.durable import stored

_PAYLOAD = "_row"


def source_targets(sources: DataFrame, max_passes: int = 3) -> DataFrame:
    """Add ``target`` to a table with one row per source: ``source_size`` and ``weight``.

    Targets share the total of all sizes by weight.  A target stops at ``max_passes`` times its
    source's size, and the excess goes to the others by weight until none is above.  Sorted by
    size over weight, the stopped sources come first, so one pass over the source table finds
    the level at which the rest share.  The source table has one row per source, not per document.
    """
    limit = F.col("source_size") * max_passes
    # A source without weight is never reached.
    order = Window.orderBy(F.when(F.col("weight") > 0, limit / F.col("weight")).asc_nulls_last(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    levels = (
        sources.withColumn("_left", F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
        .withColumn("_weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    # If a stopped source were left among the sharing ones, the level would be lower; so the highest level is right.
    level = F.max(
        F.when(F.col("_weights") > 0, F.struct((F.col("_left") / F.col("_weights")).alias("level"), "_left", "_weights"))
    ).over(everything)
    share = F.col("weight") * F.col("_level._left") / F.col("_level._weights")
    return (
        levels.withColumn("_level", level)
        .withColumn("target", F.coalesce(F.least(limit.cast("double"), share.cast("double")), F.lit(0.0)))
        .drop("_left", "_weights", "_level")
    )


def _passes(finished: Column, max_passes: int) -> Column:
    """Struct array: one element per pass with its finish time."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(max_passes - 1)),
        lambda p: F.struct(((F.col("source_size") * p + finished) / F.col("target")).alias("time"), p.alias("turn")),
    )


def _shuffled(docs: DataFrame, source: str, size: Column, key: Column, tie: Column, seed: int) -> DataFrame:
    """Narrow columns of the method beside the whole row: source, size, shuffle key, tie-break."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(_PAYLOAD), F.col(f"`{source}`").cast("string").alias("source"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"), digest.alias("key"), F.coalesce(tie.cast("string"), F.lit("")).alias("tie"),
    )


def _running(rows: DataFrame, blocks: int, targets: DataFrame) -> DataFrame:
    """Add ``source_size``, ``target`` and ``finished``: the source's tokens up to and with the row."""
    block = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * blocks / F.lit(1 << 32)).cast("long")
    placed = rows.withColumn("block", block)
    sums = placed.groupBy("source", "block").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    starts = starts.alias("s").join(
        targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))
    ).select(F.col("s.source").alias("_source"), F.col("block").alias("_block"), "_start", "source_size", "target")
    within = Window.partitionBy("source", "block").orderBy("key", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("_within", F.sum("size").over(within))
        .join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
        .withColumn("finished", F.col("_start") + F.col("_within"))
        .drop("_source", "_block", "_start", "_within", "block")
    )


def _entry(time: Column, turn: Column) -> Column:
    """Place in the global order, as a struct that compares by its fields."""
    return F.struct(
        time.alias("time"), turn.alias("turn"), F.col("source").isNull().alias("last"), F.coalesce("source", F.lit("")).alias("source"),
        F.col("key").alias("key"), F.col("size").alias("size"), F.col("tie").alias("tie"),
    )


def _bin(time: Column, bins: int) -> Column:
    """Range of finish times; half of the bins lie below 1, where the cut is expected."""
    return F.floor(time / (time + 1) * bins)


def _cut(running: DataFrame, bins: int, max_passes: int) -> tuple[int, Row | None] | None:
    """Where the total budget is used up: the bin, and the last entry in it that still fits.

    Two rows come to the driver, whatever the size of the table.
    """
    timed = (
        running.filter((F.col("size") > 0) & (F.col("target") > 0))
        .withColumn("_pass", F.explode(_passes(F.col("finished"), max_passes)))
        .select("size", _bin(F.col("_pass.time"), bins).alias("bin"), _entry(F.col("_pass.time"), F.col("_pass.turn")).alias("entry"))
    )
    budget = running.agg(F.sum("size")).first()[0] or 0
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bin, so this order is short.
    at = (
        timed.groupBy("bin").agg(F.sum("size").alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .filter(F.col("_before") < budget)
        .agg(F.max(F.struct("bin", "_before")).alias("at"))
        .first()["at"]
    )
    if at is None:
        return None
    # Only the rows of that bin, about 1/bins of all, are put in exact order.
    order = Window.partitionBy("bin").orderBy("entry").rowsBetween(Window.unboundedPreceding, 0)
    inside = timed.filter(F.col("bin") == at["bin"]).withColumn("_total", F.sum("size").over(order) + at["_before"])
    return at["bin"], inside.filter(F.col("_total") <= budget).agg(F.max("entry").alias("e")).first()["e"]


def mix(
    docs: DataFrame, weights: DataFrame, size: Column, key: Column, tie: Column,
    source: str = "source", max_passes: int = 3, seed: int = 1,
) -> DataFrame:
    """Every document with how often the mix takes it.

    ``weights``: columns source and weight, one row for each source.  Returns ``_row`` (struct: the whole
    input row), source, size, source_size, target and ``passes`` (0 to ``max_passes``).

    Null source: a source of its own.  Null or empty text: size 0, passes 0.  Equal rows: each is a
    document, order among them is immaterial.  Repeated keys: told apart by ``tie``.  Empty table: no rows.
    Columns of the input stay inside ``_row``, so no name can clash.
    """
    rows = _shuffled(docs, source, size, key, tie, seed)
    # Sizes are counted once; every later step reads this narrow table.
    narrow = stored(rows.select("source", "size", "key", "tie"))
    blocks = max(1, math.isqrt(narrow.count()))
    totals = narrow.groupBy("source").agg(F.sum("size").alias("source_size")).alias("n")
    named = weights.select(F.col("source").alias("_w_source"), F.col("weight"))
    sized = totals.join(named, F.col("n.source").eqNullSafe(F.col("_w_source")), "left").select(
        F.col("n.source").alias("source"), "source_size", F.coalesce("weight", F.lit(0)).alias("weight")
    )
    # Both are read several times; stored, the driver plans each of their steps once.
    targets = stored(source_targets(sized, max_passes))
    cut = _cut(stored(_running(narrow, blocks, targets)), blocks, max_passes)

    def is_taken(turn: int) -> Column:
        if cut is None:
            return F.lit(0)
        time = (F.col("source_size") * turn + F.col("finished")) / F.col("target")
        place, (at, last) = _bin(time, blocks), cut
        taken = place < at
        if last is not None:
            taken |= (place == at) & (_entry(time, F.lit(turn)) <= F.struct(*[F.lit(last[f]).alias(f) for f in last.asDict()]))
        return F.when(taken, 1).otherwise(0)

    taken = reduce(Column.__add__, map(is_taken, range(max_passes)))
    passes = F.when((F.col("size") > 0) & (F.col("target") > 0), taken).otherwise(0)
    return _running(rows, blocks, targets).select(
        _PAYLOAD, "source", "size", "source_size", "target", passes.cast("int").alias("passes")
    )


def cyclic_weights(docs: DataFrame, source: str = "source", cycle: int = 3) -> DataFrame:
    """Weights 1, 2, .. ``cycle``, repeating, over the sources by code point, null last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    names = docs.select(F.col(f"`{source}`").cast("string").alias("source")).distinct()
    return names.withColumn("weight", F.pmod(F.row_number().over(order) - 1, F.lit(cycle)) + 1)
