"""Keyword matching as joins, for dictionaries kept in tables of any size.

A text is cut into alternating word and separator runs.  A variant occurs at word
boundaries exactly where its own runs equal consecutive runs of the text, provided that a
separator run at either end of the variant has a word run beyond it.  So the texts' run
sequences of the lengths that occur in the dictionary are exploded and equi-joined, those at
least that begin with a run that some variant begins with: a bitmap of fixed size says so inside the
text's own row.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from rolelake.dictionaries import DEFAULT_CATEGORY, DEFAULT_WEIGHT, TITLE_BOOST
from rolelake.functions.text import WORD
from rolelake.operators.joins import BROADCAST_ROWS, lookup_join
from rolelake.operators.matching import each_keyword, fold_case_column, occurrences_in_context

# Of the bitmap over the dictionary's first runs: 128 KB in the plan, whatever the dictionary's size.
BITMAP_BITS = 1 << 20
_SEPARATOR = r"[^\p{L}\p{N}_]"
_RUNS = rf"{WORD}+|{_SEPARATOR}+"


def _runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_RUNS), F.lit(0))


def _starts_with_word(runs: Column) -> Column:
    return F.coalesce(F.get(runs, F.lit(0)).rlike(f"^{WORD}"), F.lit(False))


def _shapes(variants: DataFrame) -> list[tuple[bool, int]]:
    """(starts with a word run, number of runs) of the variants: a handful of pairs."""
    runs = _runs(F.col("variant"))
    shapes = variants.select(_starts_with_word(runs).alias("word"), F.size(runs).alias("n"))
    return sorted((r["word"], r["n"]) for r in shapes.where("n > 0").distinct().collect())


def _bit(run: Column) -> Column:
    return F.pmod(F.xxhash64(run), F.lit(BITMAP_BITS))


def _bitmap(variants: DataFrame) -> Column:
    """The first runs of all variants as bits by hash: words of 64 bits, folded into one literal."""
    bits = variants.select(_bit(F.get(_runs(F.col("variant")), F.lit(0))).alias("bit")).where("bit is not null")
    word = bits.select(
        F.floor(F.col("bit") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("set")
    )
    words = [0] * (BITMAP_BITS // 64)
    for row in word.groupBy("word").agg(F.bit_or("set").alias("set")).collect():
        words[row["word"]] = row["set"]
    return F.from_json(F.lit(json.dumps(words)), "array<bigint>")


def _sequences(runs: str, places: str, shapes: list[tuple[bool, int]]) -> Column:
    """Distinct run sequences of the given shapes that begin at the given places.

    A separator run at either end needs a word run beyond it.
    """

    def at(place: Column) -> Column:
        word_here = _starts_with_word(F.col(runs)) == (place % 2 == 0)
        found = []
        for word, n in shapes:
            ends_with_word = word == (n % 2 == 1)
            fits = (word_here if word else ~word_here & (place > 0)) & (
                place + n + (0 if ends_with_word else 1) <= F.size(runs)
            )
            found.append(F.when(fits, F.array_join(F.slice(runs, place + 1, F.lit(n)), "")))
        return F.array(*found)

    return F.array_distinct(F.array_compact(F.flatten(F.transform(places, at))))


def keyword_pairs(
    docs: DataFrame,
    key: str,
    text: str,
    variants: DataFrame,
    case_sensitive: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(key, keyword) per match from a dictionary table; a pair may come more than once.

    ``key`` identifies a row of ``docs``; ``variants`` holds keyword and variant.
    """
    fold = (lambda c: c) if case_sensitive else fold_case_column
    folded = variants.select("keyword", fold(F.col("variant")).alias("variant"))
    lookup = folded.withColumnRenamed("variant", "_gram").distinct()
    shapes = _shapes(folded)
    if not shapes:
        return docs.select(key, F.lit(None).cast("string").alias("keyword")).where("false")
    bitmap = _bitmap(folded)
    cut = docs.select(key, _runs(fold(F.coalesce(text, F.lit("")))).alias("_runs"))
    maybe = F.transform("_runs", lambda run, i: F.when(F.getbit(F.get(bitmap, F.floor(_bit(run) / 64).cast("int")), _bit(run) % 64) == 1, i))
    # A generator keeps what it makes from being computed again for every place.
    placed = cut.select(key, F.inline(F.array(F.struct("_runs", F.array_compact(maybe).alias("_places")))))
    grams = placed.select(key, F.explode(_sequences("_runs", "_places", shapes)).alias("_gram"))
    joined = lookup_join(
        grams, lookup, "_gram", spread_by=key, how="inner", broadcast_rows=broadcast_rows
    )
    return joined.select(key, "keyword")


def keywords_by_join(
    docs: DataFrame,
    key: str,
    text: str,
    variants: DataFrame,
    case_sensitive: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(key, keywords_matched), one row per text, equal to the inlined matching.

    A text's sequences sit in one task, so the set is built before the shuffle.  Texts without a
    match come from a second look at the keys alone.
    """
    pairs = keyword_pairs(docs, key, text, variants, case_sensitive, broadcast_rows)
    everyone = docs.select(key, F.lit(None).cast("string").alias("keyword"))
    return pairs.unionByName(everyone).groupBy(key).agg(
        F.sort_array(F.collect_set("keyword")).alias("keywords_matched")
    )


def score_pairs(pairs: DataFrame, weights: DataFrame, key: str, in_title: str = "in_title") -> DataFrame:
    """Score per key from (key, keyword, in_title) and a weight table, default 1.0."""
    weighted = lookup_join(pairs, weights, "keyword", spread_by=key)
    boost = F.when(F.col(in_title), F.lit(TITLE_BOOST)).otherwise(F.lit(1.0))
    weight = F.coalesce("weight", F.lit(DEFAULT_WEIGHT))
    return weighted.groupBy(key).agg(F.sum(weight * boost).alias("keyword_score"))


def categorize_pairs(pairs: DataFrame, categories: DataFrame, key: str) -> DataFrame:
    """(key, category, keywords) from (key, keyword) and a category table."""
    named = lookup_join(pairs, categories, "keyword", spread_by=key)
    category = F.coalesce("category", F.lit(DEFAULT_CATEGORY)).alias("category")
    return named.groupBy(key, category).agg(
        F.sort_array(F.collect_set("keyword")).alias("keywords")
    )


def suggest_for_pairs(pairs: DataFrame, pairings: DataFrame, key: str) -> DataFrame:
    """Distinct (key, suggested): paired skills that the key does not have already."""
    candidates = lookup_join(pairs, pairings, "keyword", spread_by=key, how="inner")
    present = pairs.select(key, F.col("keyword").alias("suggested"))
    return (
        candidates.select(key, "suggested").distinct().join(present, [key, "suggested"], "left_anti")
    )


def _with_regexes(docs: DataFrame, regexes: DataFrame, key: str, text: str, matched: str) -> DataFrame:
    rows = each_keyword(docs, key, text, keywords=matched)
    return lookup_join(rows, regexes, "keyword", spread_by=key, how="inner")


def frequency_by_join(
    docs: DataFrame, regexes: DataFrame, key: str, text: str, matched: str = "keywords_matched"
) -> DataFrame:
    """(key, keyword, occurrences) with the keywords' regexes from a table."""
    rows = _with_regexes(docs, regexes, key, text, matched)
    return rows.select(key, "keyword", F.regexp_count(text, F.col("regex")).alias("occurrences"))


def context_by_join(
    docs: DataFrame,
    regexes: DataFrame,
    key: str,
    text: str,
    matched: str = "keywords_matched",
    context_chars: int = 50,
) -> DataFrame:
    """(key, keyword, occurrence, context) with the keywords' regexes from a table."""
    cuts = _with_regexes(docs, regexes, key, text, matched).select(
        key,
        "keyword",
        F.split(text, F.col("regex"), -1).alias("_between"),
        F.regexp_extract_all(text, F.col("regex"), F.lit(0)).alias("_hits"),
    )
    return cuts.select(
        key, "keyword", occurrences_in_context("_between", "_hits", context_chars)
    )
