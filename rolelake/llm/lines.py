"""Quality rules: lines that many documents of a host share, and documents that consist of them.

Lines are normalised and hashed; for each host and line the distinct documents are counted, and
lines above the limits are removed.  A document that loses more than ``max_lost`` of its words is
depleted and rejected.  Copies with the same text count as one document, so a document isn't
rejected for having been copied.

Hashes have 64 bits and are compared within a host only: with 10 million frequent lines a line
is taken for a frequent one by chance about once in 10**12 lines.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rolelake.llm.words import word_count
from rolelake.operators.durable import stored
from rolelake.shipping import ship

#: Line breaks inside a line can only be the ones that the text isn't split at.
_SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """A line is removed if more documents have it than ``documents`` and than ``share`` of the host's."""

    documents: int = 20
    share: float = 0.1
    max_lost: float = 0.5


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, white space runs as one space, trimmed."""
    digits = F.translate(F.lower(line), "123456789", "000000000")
    return F.trim(F.regexp_replace(digits, _SPACE, " "))


def _line_facts(text: Column) -> Column:
    """Array of (hash, words) of the lines that have a word."""
    facts = F.transform(
        F.split(text, "\n"), lambda line: F.struct(F.xxhash64(normalised(line)).alias("line"), word_count(line).alias("words"))
    )
    return F.filter(facts, lambda f: f["words"] > 0)


def _repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1_000_000:  # keep the product below 2**63
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    if len(times) == len(windows):
        return 0
    again = np.flatnonzero(times[which] > 1)
    covered = np.zeros(len(words), dtype=bool)
    for offset in range(3):
        covered[again + offset] = True
    return int(covered.sum())


def _counts(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    # bytes.split() splits at exactly U+0020 and U+0009 to U+000D.
    words = text.encode("utf-8", "replace").split()
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), _repeated_words(words)


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in COUNTS]))
def base_counts(texts: pd.Series) -> pd.DataFrame:
    """Counts of each whole text; null counts as empty."""
    return pd.DataFrame([_counts(t) for t in texts], columns=list(COUNTS))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    """Under 50 words, or more than half of the words in repeated windows."""
    return (n_words < 50) | (n_repeat_words * 100 > n_words * 50)


def _facts(docs: DataFrame, key: str, host: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{host}`").cast("string").alias("host"), F.md5(body.cast("binary")).alias("digest"),
        _line_facts(body).alias("lines"), base_counts(body).alias("counts"),
    )


def frequent_lines(facts: DataFrame, limits: Limits) -> DataFrame:
    """Columns host and line of the lines above the limits, each once."""
    # Distinct first, then counted with map-side combine: a line of every document meets no single task.
    shown = facts.select("host", "digest", F.explode(F.array_distinct(F.transform("lines", lambda f: f["line"]))).alias("line")).distinct()
    counts = shown.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limits.documents)
    hosts = facts.select("host", "digest").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("_documents"))
    hosts = hosts.withColumnRenamed("host", "_host")
    return (
        counts.join(hosts, F.col("host").eqNullSafe(F.col("_host")))
        .filter(F.col("n") > F.col("_documents") * limits.share)
        .select("host", "line")
    )


def verdicts(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """One row per document: key, host, digest, counts (struct), n_lost, removed (line hashes), depleted.

    Null text: no lines, nothing lost, not depleted.  Null host: a host of its own.  Repeated or null keys:
    every row gets its verdict; rows equal in key, host and text get equal ones.  Empty table: no rows.
    Other columns are not read.
    """
    ship(docs.sparkSession)
    # The texts are read once; the numbered facts are what later steps use.
    facts = stored(_facts(docs, key, host, text).withColumn("row", F.monotonically_increasing_id()))
    frequent = frequent_lines(facts, limits).withColumnRenamed("host", "_host").withColumnRenamed("line", "_line")
    lines = facts.select("row", "host", F.explode("lines").alias("f")).select("row", "host", "f.line", "f.words")
    # Both sides are exchanged by the join itself, so Spark can split the partition of a frequent line.
    lost = (
        lines.join(frequent, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")))
        .groupBy("row")
        .agg(F.sum("words").alias("n_lost"), F.collect_set("line").alias("removed"))
    )
    n_lost = F.coalesce("n_lost", F.lit(0)).cast("long")
    return facts.join(lost, "row", "left").select(
        "key", "host", "digest", "counts", n_lost.alias("n_lost"), F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed"),
        (n_lost > F.col("counts.n_words") * limits.max_lost).alias("depleted"),
    )


def without_lines(text: Column, removed: Column) -> Column:
    """The text without the lines whose hash is among ``removed``; other lines stay as they are."""
    kept = F.filter(F.split(text, "\n"), lambda line: ~F.array_contains(removed, F.xxhash64(normalised(line))))
    return F.when(F.size(removed) > 0, F.array_join(kept, "\n")).otherwise(text)


def cleaned(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """The documents that pass, without their frequent lines; columns of ``docs``.

    A document goes if it fails the base rules or is depleted.
    """
    passed = (
        verdicts(docs, limits, key, host, text)
        .filter(~F.col("depleted") & ~base_failed(F.col("counts.n_words"), F.col("counts.n_repeat_words")))
        .select(F.struct("key", "host", "digest").alias("_id"), "removed")
        .groupBy("_id")  # rows equal in all three have equal verdicts
        .agg(F.first("removed").alias("_removed"))
    )
    body = F.col(f"`{text}`").cast("string")
    names = {"key": F.col(f"`{key}`"), "host": F.col(f"`{host}`").cast("string"), "digest": F.md5(F.coalesce(body, F.lit("")).cast("binary"))}
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[c.alias(f"_{n}") for n, c in names.items()])
    same = [F.col(f"_{n}").eqNullSafe(F.col(f"_id.{n}")) for n in names]
    return rows.join(passed, same[0] & same[1] & same[2]).select(
        *[without_lines(F.col(f"_row.`{c}`"), F.col("_removed")).alias(c) if c == text else F.col(f"_row.`{c}`") for c in docs.columns]
    )
