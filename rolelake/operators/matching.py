"""Keyword matching with a bounded dictionary inlined into the plan.

A keyword matches where one of its variants stands at word boundaries.  The whole
dictionary becomes one regular expression with shared prefixes, so a text is read once
however many keywords there are, and labelling is a narrow projection: no explode, no
shuffle, no Python.  Dictionaries that are kept in tables, too large for the driver, go through
:mod:`rolelake.operators.matching_join`, which gives the same results.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rolelake.dictionaries import (
    DEFAULT_CATEGORY,
    DEFAULT_WEIGHT,
    TITLE_BOOST,
    KeywordDictionary,
)
from rolelake.functions.constants import constant_map
from rolelake.functions.text import WORD, _col, strip_ws

DEFAULT_TEXT_COLUMNS = ("job_title", "description_snippet", "full_description")

# Letters that equal an ASCII letter when case is ignored, but do not lower to it.
_ODD_LETTERS, _THEIR_ASCII = "ſıİK", "siik"

_NOT_AFTER_WORD, _AFTER_WORD = f"(?<!{WORD})", f"(?<={WORD})"
_NOT_BEFORE_WORD, _BEFORE_WORD = f"(?!{WORD})", f"(?={WORD})"


def fold_case(text: str) -> str:
    return text.translate(str.maketrans(_ODD_LETTERS, _THEIR_ASCII)).lower()


def fold_case_column(c: Column) -> Column:
    return F.lower(F.translate(c, _ODD_LETTERS, _THEIR_ASCII))


def _is_word(char: str) -> bool:
    return char == "_" or char.isalnum()


def _literal(text: str) -> str:
    return "".join(c if _is_word(c) else "\\" + c for c in text)


def _opening(variant: str) -> str:
    return _NOT_AFTER_WORD if _is_word(variant[0]) else _AFTER_WORD


def _closing(variant: str) -> str:
    return _NOT_BEFORE_WORD if _is_word(variant[-1]) else _BEFORE_WORD


def _flags(dictionary: KeywordDictionary) -> str:
    return "" if dictionary.case_sensitive else "(?iu)"


def _folded(dictionary: KeywordDictionary, variant: str) -> str:
    return variant if dictionary.case_sensitive else fold_case(variant)


def _shared_prefix_regex(variants: Sequence[str]) -> str:
    """Alternation over variants with shared prefixes, longest fitting variant first."""
    heads: dict[str, list[str]] = {}
    for variant in variants:
        if variant:
            heads.setdefault(variant[0], []).append(variant[1:])
    return "|".join(
        _literal(head) + _tail_regex(head, tails) for head, tails in sorted(heads.items())
    )


def _tail_regex(so_far: str, tails: list[str]) -> str:
    longer = [t for t in tails if t]
    options = [_shared_prefix_regex(longer)] if longer else []
    if len(longer) < len(tails):
        options.append(_closing(so_far))
    body = "|".join(options)
    return f"(?:{body})" if "|" in body else body


def _longest_ahead(dictionary: KeywordDictionary) -> str:
    """Lookahead whose group 1 is the longest variant standing there."""
    variants = sorted({_folded(dictionary, v) for forms in dictionary.variants.values() for v in forms})
    branches = [
        f"{opening}(?:{_shared_prefix_regex(group)})"
        for opening in (_NOT_AFTER_WORD, _AFTER_WORD)
        if (group := [v for v in variants if _opening(v) == opening])
    ]
    return f"(?=({'|'.join(branches)}))"


def all_variants_regex(dictionary: KeywordDictionary) -> str:
    """Regex whose group 1 is, at each start, the longest variant standing there."""
    return _flags(dictionary) + _longest_ahead(dictionary)


def _pieces_regex(dictionary: KeywordDictionary) -> str:
    """Regex that cuts a text after the first character of every start of a variant; group 1 is the variant.

    What follows the last start is one more piece, without a variant.
    """
    return f"(?s){_flags(dictionary)}.*?{_longest_ahead(dictionary)}.|.+"


def keyword_regex(dictionary: KeywordDictionary, keyword: str) -> str:
    """Regex of one keyword: its variants in the given order, the first that fits wins."""
    forms = [_opening(v) + _literal(v) + _closing(v) for v in dictionary.variants[keyword]]
    return f"{_flags(dictionary)}(?:{'|'.join(forms)})"


def _heads(dictionary: KeywordDictionary) -> dict[str, list[str]]:
    """Variant -> the variants that stand wherever it stands.

    Besides itself these are the shorter variants that it starts with and that end at a
    word boundary inside it.
    """
    known = {_folded(dictionary, form) for forms in dictionary.variants.values() for form in forms}
    return {
        variant: [
            variant[:end]
            for end in range(1, len(variant))
            if variant[:end] in known and _is_word(variant[end - 1]) != _is_word(variant[end])
        ] + [variant]
        for variant in known
    }


def _owners(dictionary: KeywordDictionary) -> dict[str, dict[str, int]]:
    """Variant -> its keywords, each with the variant's place in the keyword's list."""
    owners: dict[str, dict[str, int]] = {}
    for keyword, forms in dictionary.variants.items():
        for place, form in enumerate(forms):
            owners.setdefault(_folded(dictionary, form), {}).setdefault(keyword, place)
    return owners


def _implied_keywords(dictionary: KeywordDictionary) -> dict[str, list[str]]:
    """Variant -> keywords that match wherever that variant stands."""
    owners = _owners(dictionary)
    return {v: sorted({k for head in heads for k in owners[head]}) for v, heads in _heads(dictionary).items()}


def _implied_occurrences(dictionary: KeywordDictionary) -> dict[str, list[dict]]:
    """Variant -> the keywords that match there, each with the length of its first variant that stands there."""
    owners = _owners(dictionary)
    found = {}
    for variant, heads in _heads(dictionary).items():
        first: dict[str, tuple[int, int]] = {}
        for head in heads:
            for keyword, place in owners[head].items():
                first[keyword] = min(first.get(keyword, (place, len(head))), (place, len(head)))
        found[variant] = [{"keyword": k, "size": size} for k, (_, size) in sorted(first.items())]
    return found


def _no_keywords() -> Column:
    return F.array().cast("array<string>")


def each_keyword(df: DataFrame, *kept: str, keywords: str = "keywords_matched") -> DataFrame:
    """One row per keyword with the kept columns; null and empty arrays give none.

    An outer explode on purpose: for an inner one Spark infers a filter on the array's size
    and pushes it down, so that matching computed below would run twice.
    """
    rows = df.select(*kept, F.explode_outer(keywords).alias("keyword"))
    return rows.where("keyword is not null")


def combined_text(*columns: Column | str) -> Column:
    """The text that is matched: all columns joined by one blank, null as ''."""
    return F.concat_ws(" ", *[F.coalesce(_col(c), F.lit("")) for c in columns])


def match_keywords(text: Column | str, dictionary: KeywordDictionary) -> Column:
    """Sorted distinct keywords found in the text; an empty array where none is."""
    if dictionary.n_variants == 0:
        return _no_keywords()
    hits = F.array_distinct(
        F.regexp_extract_all(_col(text), F.lit(all_variants_regex(dictionary)), F.lit(1))
    )
    if not dictionary.case_sensitive:
        hits = F.array_distinct(F.transform(hits, fold_case_column))
    implied = constant_map(_implied_keywords(dictionary), "array<string>")
    found = F.flatten(
        F.transform(hits, lambda h: F.coalesce(F.try_element_at(implied, h), _no_keywords()))
    )
    return F.coalesce(F.sort_array(F.array_distinct(found)), _no_keywords())


def keyword_score(
    matched: Column | str,
    matched_in_title: Column | str,
    dictionary: KeywordDictionary,
    title_boost: float = TITLE_BOOST,
    default_weight: float = DEFAULT_WEIGHT,
) -> Column:
    """Sum of the keywords' weights, boosted where a keyword also stands in the title."""
    weights = constant_map(dict(dictionary.weights), "double")
    in_title = _col(matched_in_title)
    return F.aggregate(
        _col(matched),
        F.lit(0.0),
        lambda total, k: total
        + F.coalesce(F.try_element_at(weights, k), F.lit(default_weight))
        * F.when(F.array_contains(in_title, k), F.lit(title_boost)).otherwise(F.lit(1.0)),
    )


def with_keywords(
    df: DataFrame,
    dictionary: KeywordDictionary,
    text_columns: Sequence[str] = DEFAULT_TEXT_COLUMNS,
    title_column: str | None = "job_title",
) -> DataFrame:
    """Label rows: adds keywords_matched and keyword_count, and keyword_score given a title."""
    labelled = df.withColumn(
        "keywords_matched", match_keywords(combined_text(*text_columns), dictionary)
    ).withColumn("keyword_count", F.size("keywords_matched"))
    if title_column is None:
        return labelled
    return (
        labelled.withColumn(
            "_in_title", match_keywords(F.coalesce(_col(title_column), F.lit("")), dictionary)
        )
        .withColumn("keyword_score", keyword_score("keywords_matched", "_in_title", dictionary))
        .drop("_in_title")
    )


def _occurrences(df: DataFrame, dictionary: KeywordDictionary, text: str, matched: str) -> DataFrame:
    """The columns of ``df`` but its text, with every start of a keyword in the text.

    ``_pieces``: the text cut after the first character of every start of a variant.  ``_sizes``: their
    lengths.  ``_groups``: for each keyword its starts (keyword, at, size) in text order; start ``at`` is
    the last character of that piece.  One regex finds all variants, so the text is read the same
    number of times whatever the dictionary's size, and nothing is cut up for each keyword.
    """
    kept = [c for c in df.columns if c != text]
    regex = F.lit(_pieces_regex(dictionary))
    scanned = df.select(
        *kept,
        F.regexp_extract_all(text, regex, F.lit(0)).alias("_pieces"),
        F.regexp_extract_all(text, regex, F.lit(1)).alias("_hits"),
    )
    entry = "array<struct<keyword:string,size:int>>"
    implied = constant_map(_implied_occurrences(dictionary), entry)
    fold = (lambda c: c) if dictionary.case_sensitive else fold_case_column

    def starts(hit: Column, at: Column) -> Column:
        here = F.coalesce(F.try_element_at(implied, fold(hit)), F.array().cast(entry))
        return F.transform(here, lambda k: F.struct(k["keyword"].alias("keyword"), at.alias("at"), k["size"].alias("size")))

    found = F.sort_array(F.flatten(F.transform("_hits", starts)))
    # A generator keeps what it makes from being computed again inside the functions below.
    made = F.struct("_pieces", F.transform("_pieces", F.length).alias("_sizes"), found.alias("_starts"))
    ready = scanned.select(*kept, F.inline(F.array(made)))
    numbered = F.transform("_starts", lambda s, i: F.struct(s["keyword"].alias("keyword"), i.alias("at")))
    heads = F.filter(
        numbered, lambda s: (s["at"] == 0) | (F.get("_starts", s["at"] - 1)["keyword"] != s["keyword"])
    )
    headed = ready.select("*", F.inline(F.array(F.struct(heads.alias("_heads")))))
    groups = F.transform(
        "_heads",
        lambda s, i: F.slice(
            "_starts", s["at"] + 1, F.coalesce(F.get("_heads", i + 1)["at"], F.size("_starts")) - s["at"]
        ),
    )
    known = F.filter(groups, lambda g: F.array_contains(matched, F.get(g, F.lit(0))["keyword"]))
    return headed.select(*kept, "_pieces", "_sizes", known.alias("_groups"))


def _reaches(first: Column, second: Column, sizes: str) -> Column:
    """Whether the second start lies inside the first one's variant.

    Pieces have a character at least, so no more of them are added up than the variant has characters.
    """
    between = F.slice(sizes, first["at"] + 2, F.least(second["at"] - first["at"], first["size"]))
    return F.aggregate(between, F.lit(0), lambda total, size: total + size) < first["size"]


def _chosen(group: Column, sizes: str) -> Column:
    """Of one keyword's starts the occurrences: from the left, none inside the one before it."""
    met = F.filter(group, lambda s, i: (i > 0) & _reaches(F.get(group, i - 1), s, sizes))
    chosen = F.aggregate(
        F.slice(group, 2, F.size(group)),
        F.slice(group, 1, 1),
        lambda done, s: F.when(_reaches(F.element_at(done, -1), s, sizes), done).otherwise(F.array_append(done, s)),
    )
    # Without starts that meet, which is nearly always so, there is nothing to choose.
    return F.when(F.size(met) == 0, group).otherwise(chosen)


def _counted(group: Column, sizes: str) -> Column:
    """Number of one keyword's occurrences."""
    none = F.struct(F.lit(0).alias("n"), F.lit(None).cast(_START).alias("last"))
    return F.aggregate(
        group,
        none,
        lambda so_far, s: F.when(F.coalesce(_reaches(so_far["last"], s, sizes), F.lit(False)), so_far).otherwise(
            F.struct((so_far["n"] + 1).alias("n"), s.alias("last"))
        ),
        lambda so_far: so_far["n"],
    )


_START = "struct<keyword:string,at:int,size:int>"


def keyword_frequency(
    df: DataFrame,
    dictionary: KeywordDictionary,
    text: str,
    matched: str = "keywords_matched",
) -> DataFrame:
    """One row per (row, matched keyword of the dictionary) with its number of non-overlapping occurrences.

    Needs the ``matched`` column; a keyword of it that doesn't stand in this text has 0.
    """
    kept = [c for c in df.columns if c not in (text, matched)]
    if dictionary.n_variants == 0:
        return df.select(*kept, F.lit("").alias("keyword"), F.lit(0).alias("occurrences")).where("false")
    found = _occurrences(df, dictionary, text, matched)
    counts = F.transform(
        "_groups",
        lambda g: F.struct(F.get(g, F.lit(0))["keyword"].alias("keyword"), _counted(g, "_sizes").alias("occurrences")),
    )
    names = F.from_json(F.lit(json.dumps(sorted(dictionary.variants))), "array<string>")
    there = F.transform("_groups", lambda g: F.get(g, F.lit(0))["keyword"])
    absent = F.array_except(F.array_intersect(matched, names), F.coalesce(there, _no_keywords()))
    zeros = F.transform(absent, lambda k: F.struct(k.alias("keyword"), F.lit(0).alias("occurrences")))
    both = F.concat(F.coalesce(counts, F.array().cast(_COUNTS)), zeros)
    return found.select(*kept, F.inline(both))


_COUNTS = "array<struct<keyword:string,occurrences:int>>"


def _around(between: str, hits: str, width: int) -> Column:
    """Contexts of all occurrences, from the texts between them and the occurrences.

    Segment j is the text since the previous occurrence plus occurrence j, at least one
    character long, so the ``width`` nearest segments always reach far enough and the work
    per occurrence does not grow with the text.
    """

    def around(hit: Column, i: Column) -> Column:
        first = F.greatest(i - width, F.lit(0))
        left = F.concat(
            F.array_join(
                F.zip_with(
                    F.slice(between, first + 1, i - first),
                    F.slice(hits, first + 1, i - first),
                    lambda piece, hit_before: F.concat(piece, hit_before),
                ),
                "",
            ),
            F.get(between, i),
        )
        # The last piece of text has no occurrence after it.
        right = F.array_join(
            F.zip_with(
                F.slice(between, i + 2, F.lit(width + 1)),
                F.slice(hits, i + 2, F.lit(width + 1)),
                lambda piece, hit_after: F.concat(piece, F.coalesce(hit_after, F.lit(""))),
            ),
            "",
        )
        return strip_ws(F.concat(F.right(left, F.lit(width)), hit, F.left(right, F.lit(width))))

    return F.transform(hits, around)


def occurrences_in_context(between: str, hits: str, width: int) -> Column:
    """Generator of (occurrence, context), numbered from 0 in text order."""
    return F.posexplode(_around(between, hits, width)).alias("occurrence", "context")


def regex_table(dictionary: KeywordDictionary, spark: SparkSession) -> DataFrame:
    """(keyword, regex) rows, for occurrences by join."""
    rows = [(k, keyword_regex(dictionary, k)) for k in dictionary.variants]
    return spark.createDataFrame(rows, "keyword string, regex string")


def _around_starts(starts: Column, width: int) -> Column:
    """Contexts of occurrences, from the pieces of the text.

    A piece has a character at least, so the nearest ones reach far enough, and of each no more than its
    nearest characters count; the work for an occurrence doesn't grow with the text.
    """

    def around(start: Column) -> Column:
        first = F.greatest(start["at"] - width, F.lit(0))
        # The last character of the left side is the occurrence's first.
        left = F.array_join(F.slice("_ends", first + 1, start["at"] - first + 1), "")
        right = F.array_join(F.slice("_begins", start["at"] + 2, start["size"] + width), "")
        return strip_ws(F.concat(F.right(left, F.lit(width + 1)), F.left(right, start["size"] - 1 + width)))

    return F.transform(starts, around)


def keyword_context(
    df: DataFrame,
    dictionary: KeywordDictionary,
    text: str,
    matched: str = "keywords_matched",
    context_chars: int = 50,
) -> DataFrame:
    """One row per (row, matched keyword, occurrence) with the text around it."""
    kept = [c for c in df.columns if c not in (text, matched)]
    if dictionary.n_variants == 0:
        nothing = [F.lit("").alias("keyword"), F.lit(0).alias("occurrence"), F.lit("").alias("context")]
        return df.select(*kept, *nothing).where("false")
    longest = max(len(form) for forms in dictionary.variants.values() for form in forms)
    found = _occurrences(df, dictionary, text, matched)
    cut = F.struct(
        F.transform("_pieces", lambda p: F.right(p, F.lit(context_chars + 1))).alias("_ends"),
        F.transform("_pieces", lambda p: F.left(p, F.lit(longest + context_chars))).alias("_begins"),
        F.transform("_groups", lambda g: _chosen(g, "_sizes")).alias("_chosen"),
    )
    ready = found.select(*kept, F.inline(F.array(cut)))
    contexts = F.transform(
        "_chosen",
        lambda g: F.struct(
            F.get(g, F.lit(0))["keyword"].alias("keyword"), _around_starts(g, context_chars).alias("_contexts")
        ),
    )
    per_keyword = ready.select(*kept, F.inline(contexts))
    return per_keyword.select(*kept, "keyword", F.posexplode("_contexts").alias("occurrence", "context"))


def skill_categories(matched: Column | str, dictionary: KeywordDictionary) -> Column:
    """Map category -> sorted keywords; categories without a keyword are left out."""
    keywords = _col(matched)
    names = list(dict.fromkeys(dictionary.categories.values()))
    if DEFAULT_CATEGORY not in names:
        names.append(DEFAULT_CATEGORY)
    category_of = constant_map(dict(dictionary.categories), "string")

    def members(name: str) -> Column:
        return F.filter(
            keywords,
            lambda k: F.coalesce(F.try_element_at(category_of, k), F.lit(DEFAULT_CATEGORY)) == name,
        )

    entries = F.array(*[F.struct(F.lit(n).alias("k"), members(n).alias("v")) for n in names])
    return F.map_from_entries(F.filter(entries, lambda e: F.size(e["v"]) > 0))


def suggest_missing_skills(matched: Column | str, dictionary: KeywordDictionary) -> Column:
    """Skills paired with the matched keywords and not among them, sorted and distinct."""
    keywords = _col(matched)
    paired = constant_map(dict(dictionary.pairings), "array<string>")
    candidates = F.flatten(
        F.transform(keywords, lambda k: F.coalesce(F.try_element_at(paired, k), _no_keywords()))
    )
    return F.sort_array(F.array_except(candidates, keywords))
