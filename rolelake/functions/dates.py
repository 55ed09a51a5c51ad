"""Posting dates from text.  The reference time is always passed in as ``as_of``.

All results are TIMESTAMP_NTZ, so they do not depend on the session time zone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from rolelake.functions.text import WS, _col, clean_text, let, strip_ws

# Relative units in the order in which they are tried, in hours.
_RELATIVE_UNITS = (("day", 24), ("week", 7 * 24), ("month", 30 * 24), ("hour", 1))

# Absolute date forms in the order in which they are tried, each with the
# shape of its texts.  No text has two of the shapes, so each is parsed at most once.
_ABSOLUTE_FORMS = (
    ("yyyy-M-d", r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
    ("d/M/yyyy", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"),
    ("d-M-yyyy", r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"),
    ("MMMM d, yyyy", r"^([A-Za-z]{4,}|[Mm][Aa][Yy]) [0-9]{1,2}, [0-9]{4}$"),
    ("d MMMM yyyy", r"^[0-9]{1,2} ([A-Za-z]{4,}|[Mm][Aa][Yy]) [0-9]{4}$"),
    ("MMM d, yyyy", r"^[A-Za-z]{3} [0-9]{1,2}, [0-9]{4}$"),
    ("d MMM yyyy", r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4}$"),
)


def timestamp_lit(as_of: datetime | str | Column) -> Column:
    """``as_of`` as a TIMESTAMP_NTZ column."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else str(as_of)
    return F.lit(text).cast("timestamp_ntz")


def ago(as_of: datetime | str | Column, days: int | Column = 0, hours: int | Column = 0) -> Column:
    """``as_of`` minus a span."""
    d = days if isinstance(days, Column) else F.lit(days)
    h = hours if isinstance(hours, Column) else F.lit(hours)
    return timestamp_lit(as_of) - F.make_dt_interval(d, h)


def parse_relative_date(c: Column | str, as_of: datetime | str | Column) -> Column:
    """'today', 'yesterday', '3 days ago' and the like; null when nothing fits."""
    units = "|".join(unit for unit, _ in _RELATIVE_UNITS)
    # A longer span has no date.
    since_year_1 = F.timestamp_diff("HOUR", F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"), timestamp_lit(as_of))

    def counted(text: Column) -> Column:
        rule = F
        for unit, unit_hours in _RELATIVE_UNITS:
            digits = F.regexp_extract(text, rf"([0-9]+){WS}*{unit}", 1)
            span = digits.try_cast("int").cast("bigint") * unit_hours
            rule = rule.when(digits != "", F.when(span <= since_year_1, span.cast("int")))
        return ago(as_of, hours=rule)

    def relative(text: Column) -> Column:
        return (
            F.when(
                F.contains(text, F.lit("today")) | F.contains(text, F.lit("just now")),
                timestamp_lit(as_of),
            )
            .when(F.contains(text, F.lit("yesterday")), ago(as_of, days=1))
            .when(text.rlike(f"[0-9]{WS}*({units})"), counted(text))
        )

    return let(strip_ws(F.lower(_col(c))), relative)


def parse_absolute_date(c: Column | str) -> Column:
    """A calendar date in one of seven forms, at midnight; null when none fits."""

    def absolute(text: Column) -> Column:
        rule = F
        for form, shape in _ABSOLUTE_FORMS:
            rule = rule.when(text.rlike(shape), F.try_to_date(text, form))
        return rule

    tidy = F.regexp_replace(clean_text(c), " {2,}", " ")
    return let(tidy, absolute).cast("timestamp_ntz")


def parse_date(
    c: Column | str,
    as_of: datetime | str | Column,
    default: datetime | str | Column | None = None,
) -> Column:
    """Relative form, else absolute form, else ``default`` (null unless given)."""
    tries = [parse_relative_date(c, as_of), parse_absolute_date(c)]
    if default is not None:
        tries.append(timestamp_lit(default))
    return F.coalesce(*tries)
