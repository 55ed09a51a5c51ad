"""The document pipeline: each stage reads the documents that the stage before it kept.

Language, quality, near duplicates, mixing, encoding.  Every stage is written as Parquet below the
session's checkpoint folder and read back, so a lost executor never sets the run back by more
than a stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rolelake.llm import jaccard, language, lines, mixing, pieces, words
from rolelake.llm.queries import MIX_PASSES, MODEL_FILE
from rolelake.operators.durable import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return df.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known, with the predicted language; rejected ones go.

    A document without text or without a letter has no language and goes.
    """
    model = language.fit(language.learnable(docs))
    known = language.predict(docs.select(*COLUMNS), model).filter(~F.col("prediction.rejected"))
    return _documents(known.withColumn("lang", F.col("prediction.lang_pred")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't depleted, without the lines that their host repeats."""
    return _documents(lines.cleaned(docs.select(*COLUMNS)))


def _identity() -> Column:
    """A key in the order of the ids, null last, then of a digest; rows with one key are equal in all columns."""
    ids = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    rest = F.concat_ws("\0", *[F.coalesce(c, F.lit("\1")) for c in ("text", "lang", "source")])
    return F.concat(F.coalesce(ids, F.lit("null")), F.md5(rest.cast("binary")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the smallest id; without an id only if none has one.

    Rows equal in id, text, language and source count as one.  Rows that share an id but not the text are documents
    of their own, and so are rows without an id.
    """
    keyed = docs.select(*COLUMNS).withColumn("_key", _identity())
    found = jaccard.near_duplicates(keyed, key="_key").filter(F.col("key") == F.col("component")).select(F.col("key").alias("_kept"))
    kept = keyed.join(found, F.col("_key") == F.col("_kept"), "left_semi").dropDuplicates(["_key"])
    return _documents(kept)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    size = words.word_count(F.col("text"))
    mixed = mixing.mix(docs.select(*COLUMNS), mixing.cyclic_weights(docs), size, F.col("doc_id"), F.xxhash64("text"), max_passes=MIX_PASSES)
    repeated = mixed.filter("passes > 0").withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("passes"))))
    return _documents(repeated.select("_row.*"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as piece numbers."""
    done = pieces.with_ids(docs.select("doc_id", "lang", "source", "text"), MODEL_FILE)
    return done.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("encoding", encoding),
]

#: Nearest centroids and piece encoding can't be said in SQL; the tests hold every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
