"""Places of rows in a global order, running totals over them, and digests of long runs of text.

All of it works on ranges of rows, so that one key with very many rows is spread over many tasks.
"""

from __future__ import annotations

import gc
import hashlib
import time
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rolelake.operators.durable import stored
from rolelake.shipping import ship

#: monotonically_increasing_id has the partition above these bits and the row below.
_ROW_BITS = 33


def numbered(df: DataFrame, *order: Column | str, keep: Sequence[str] | None = None) -> DataFrame:
    """The rows, stored, with ``number``: their place from 0 in the order of these columns, without gaps.

    ``keep``: columns to go on with, all by default.

    Spark sorts the rows by ranges; a row's number is its place in its range and the size of the
    ranges before.  Rows equal in all columns of the order may lie in any order among themselves.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ranged.select(*(keep or df.columns), F.monotonically_increasing_id().alias("_place")))
    placed = placed.withColumn("_range", F.shiftright("_place", _ROW_BITS))
    # One row for each range: as many as the shuffle has partitions.
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    number = F.col("_offset") + F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    return placed.join(F.broadcast(offsets), "_range").withColumn("number", number).drop("_place", "_range", "_offset")


def running(df: DataFrame, keys: Sequence[str], place: str, totals: dict[str, str], rows: int, block: int = 1 << 12) -> DataFrame:
    """The rows with running totals of each key up to and including themselves, in place of the columns summed.

    ``totals``: column to ``sum`` or ``bit_xor``.  ``place``: numbers from 0 or 1 without gaps in each key, ``rows`` the largest of
    them at most.  A block of ``block`` places is summed by itself; totals of blocks are run over in the same way.
    """
    made = {name: getattr(F, kind) for name, kind in totals.items()}
    own = Window.partitionBy(*keys, "_block").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    blocks = df.withColumn("_block", F.floor(F.col(place) / block))
    inside = blocks.withColumns({f"_own_{name}": total(name).over(own) for name, total in made.items()})
    kept = [c for c in df.columns if c not in totals]
    if rows < block:
        return inside.select(*kept, *[F.col(f"_own_{name}").alias(name) for name in totals])
    sums = blocks.groupBy(*keys, "_block").agg(*[total(name).alias(name) for name, total in made.items()])
    # The total up to a block, under the number of the next one.
    upto = running(sums.withColumnRenamed("_block", "_at"), keys, "_at", totals, rows // block, block)
    upto = upto.select(*[F.col(k).alias(f"_key_{k}") for k in keys], (F.col("_at") + 1).alias("_next"), *[F.col(n).alias(f"_upto_{n}") for n in totals])
    same = F.col("_block") == F.col("_next")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_key_{k}"))
    both = inside.join(upto, same, "left")
    joined = {"sum": lambda a, b: a + b, "bit_xor": lambda a, b: a.bitwiseXOR(b)}
    return both.select(
        *kept, *[joined[kind](F.coalesce(F.col(f"_upto_{name}"), F.lit(0)), F.col(f"_own_{name}")).alias(name) for name, kind in totals.items()]
    )


def freed(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of steps whose result is stored; it does so once the driver collects garbage.

    What listeners still hold of a step that has just ended goes with the second collection.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` has written, once everything made from them is stored itself."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def _digested(width: int, between: bytes):
    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The digest of each run of rows with one key; texts come in order."""
        key, digest = None, None
        for batch in batches:
            keys = list(zip(*[batch.column(k).to_pylist() for k in range(width)], strict=True))
            done = []
            for k, text in zip(keys, batch.column(width), strict=True):
                if k != key:
                    if digest is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256()
                else:
                    digest.update(between)
                digest.update(text.as_buffer())
            yield _rows(batch, width, done)
        if digest is not None:
            yield _rows(batch, width, [(*key, digest.hexdigest())])

    return digested


def _rows(batch: pa.RecordBatch, width: int, rows: list[tuple]) -> pa.RecordBatch:
    names = batch.schema.names[:width]
    arrays = [pa.array([r[k] for r in rows], batch.schema.field(k).type) for k in range(width)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array([r[width] for r in rows], pa.string())], [*names, "sha256"])


def chained_sha256(df: DataFrame, keys: Sequence[str], order: str, text: str, between: str = "") -> DataFrame:
    """Columns ``keys`` and sha256: the digest (lower-case hex) of each key's texts in this order, with ``between`` between them.

    A digest is made from front to back, so a key's texts pass through one task; they pass, and are held nowhere.
    """
    ship(df.sparkSession)
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    dealt = df.select(*keys, order, F.col(text).alias("_text")).repartition(*keys).sortWithinPartitions(*keys, order)
    return dealt.select(*keys, "_text").mapInArrow(_digested(len(keys), between.encode()), f"{kinds}, sha256 string")
