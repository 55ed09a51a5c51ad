"""Reading stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_BYTES_PER_TASK = 128 * 1024 * 1024


def read_table(spark: SparkSession, path: str, spread: bool = False) -> DataFrame:
    """A Parquet table; ``spread`` is for work that is heavy per row."""
    rows = spark.read.parquet(path)
    return spread_small(rows) if spread else rows


def spread_small(df: DataFrame) -> DataFrame:
    """Deal the rows of a small scan to all cores; leave every other scan as it is.

    A few small files give fewer tasks than there are cores, which only matters when the
    work per row is heavy.  A scan that can fill the cores by itself is never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= cores * _BYTES_PER_TASK or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)
