"""Durable cut of a plan: results that are used twice survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the session's checkpoint folder; only a local session may do without a named one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    single_machine = context.master == "local" or context.master.startswith("local[")
    if named is None and not single_machine:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="rolelake-checkpoint-"))


def shared_folder(spark: SparkSession) -> str:
    """A new path below the session's checkpoint folder, which all executors reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet below the checkpoint folder and read them back.

    Unlike a checkpoint, the table keeps column pruning and filter push-down for its readers.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Go on from a stored copy of the rows, so that they are computed once."""
    return stored(df)
