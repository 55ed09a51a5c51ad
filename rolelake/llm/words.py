"""Words as the operators of this folder count them: runs without space, tab or line breaks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Everything but U+0020 and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def as_text(name: str) -> Column:
    """A column as text, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
