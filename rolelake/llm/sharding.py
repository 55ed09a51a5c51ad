"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass one scatters the rows by a seeded hash over buckets that fit in a task's memory.  Pass two
shuffles each bucket with Spark's ``shuffle``, an inside-out Fisher-Yates, and hands the rows to
shards.  The shuffled buckets one after another are one uniform random order of all rows; shard
boundaries cut that order into parts whose row counts differ by one at most (law ``rows``), so
a bucket feeds one or two shards and is written sequentially.

Every bucket is exactly one partition, and ``shuffle`` seeds itself from seed and partition
number, so a task that is run again, or the whole job, gives the same order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

LAW = "rows"


def bucket_count(rows: DataFrame, size: Column, bucket_bytes: int) -> int:
    """Buckets of about ``bucket_bytes`` each; at least one."""
    total = rows.agg(F.sum(size)).first()[0] or 0
    return max(1, -(-int(total) // bucket_bytes))


def shuffled_shards(
    rows: DataFrame, shards: int, buckets: int, seed: int = 1, by: list[Column] | None = None
) -> DataFrame:
    """Every row with its shard and its slot in it.

    Returns ``_row`` (struct: the whole input row), ``bucket``, ``shard`` (0 to shards - 1) and ``slot``
    (0, 1, 2 .. in every shard, in the order to write).  ``by``: what is hashed, all columns by default;
    it should tell rows apart, since rows equal in all of it share a bucket.

    Nulls in any column: hashed like any value.  Equal rows: all kept.  Fewer rows than shards: some
    shards stay empty.  Empty table: no rows.  Input columns stay inside ``_row``, so no name can clash.
    """
    hashed = by or [F.col(f"`{c}`") for c in rows.columns]
    # Seeded by a leading column: the hash of later columns starts from it.
    scattered = rows.select(
        F.xxhash64(F.lit(seed), *hashed).alias("_hash"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
    ).withColumn("bucket", F.pmod("_hash", F.lit(buckets)).cast("int"))
    counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket: where its rows begin in the global order, and how many rows there are in all.
    starts = counts.select(
        "bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_total"),
    )
    item = F.struct("_hash", "_row")
    both = scattered.select("bucket", item.alias("_item"), F.lit(None).cast("long").alias("_start"), F.lit(None).cast("long").alias("_total"))
    both = both.unionByName(starts.select("bucket", F.lit(None).cast(both.schema["_item"].dataType).alias("_item"), "_start", "_total"))
    # The bucket's start comes along as one more row, so no join has to move the rows again.
    gathered = (
        both.repartitionById(buckets, F.col("bucket"))
        .groupBy("bucket")
        .agg(F.collect_list("_item").alias("_items"), F.max("_start").alias("_start"), F.max("_total").alias("_total"))
    )
    # Sorted first: rows arrive in any order.
    ordered = gathered.withColumn("_items", F.shuffle(F.sort_array("_items"), F.lit(seed)))
    placed = ordered.select("bucket", "_start", "_total", F.posexplode("_items").alias("_place", "_item"))
    # Shard s begins at floor(s * total / shards).
    shard = F.expr(f"cast(((_start + _place + 1) * {shards} - 1) div _total as int)")
    return (
        placed.withColumn("shard", shard)
        .withColumn("slot", F.expr(f"_start + _place - (cast(shard as bigint) * _total) div {shards}"))
        .select("_item._row", "bucket", "shard", "slot")
    )


def _own_names(columns: list[str]) -> tuple[str, str, str]:
    """Names for bucket, slot and shard that no column of the rows has; more underscores where one has."""
    taken = {c.lower() for c in columns}
    found = []
    for name in ("_bucket", "_slot", "_shard"):
        while name in taken:
            name = "_" + name
        found.append(name)
    return tuple(found)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard; each bucket's task writes its rows in slot order.

    Files hold the rows' columns, ``_bucket`` and ``_slot``, folders are named by ``_shard``; a name that the rows
    have themselves gets another underscore.
    """
    bucket, slot, shard = _own_names(sharded.schema["_row"].dataType.names)
    sharded.select("_row.*", F.col("bucket").alias(bucket), F.col("slot").alias(slot), F.col("shard").alias(shard)).write.partitionBy(shard).parquet(path)


def written_shards(sharded: DataFrame, path: str) -> DataFrame:
    """Write the shards and read them back: ``_row`` (struct: the whole row), ``bucket``, ``shard`` and ``slot``."""
    write_shards(sharded, path)
    names = sharded.schema["_row"].dataType.names
    bucket, slot, shard = _own_names(names)
    layout = sharded.select("_row.*", F.col("bucket").alias(bucket), F.col("slot").alias(slot), F.col("shard").alias(shard)).schema
    back = sharded.sparkSession.read.schema(layout).parquet(path)
    return back.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(bucket).alias("bucket"), F.col(shard).alias("shard"), F.col(slot).alias("slot"))
