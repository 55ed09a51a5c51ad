"""Row checks that return an ordered list of errors per row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rolelake.functions.urls import is_valid_url
from rolelake.schema import ALLOWED_SOURCES, NOTIFICATION_STATES, RUN_STATES

# Fields that a posting needs; the messages below are fixed, too.
REQUIRED_FIELDS = ("job_title", "posting_url", "source")


def _error(condition: Column, message: Column | str) -> Column:
    text = message if isinstance(message, Column) else F.lit(message)
    return F.when(condition, text)


def _listed(errors: Sequence[Column]) -> Column:
    return F.array_compact(F.array(*errors)) if errors else F.array().cast("array<string>")


def posting_errors(allowed_sources: Sequence[str] = ALLOWED_SOURCES) -> Column:
    """Errors of a collected posting: required fields, then its URL, then its source."""

    def is_blank(name: str) -> Column:
        return F.coalesce(name, F.lit("")) == ""

    errors = [_error(is_blank(f), f"Missing required field: {f}") for f in REQUIRED_FIELDS]
    errors.append(_error(~is_blank("posting_url") & ~is_valid_url("posting_url"), "Invalid posting URL"))
    known = F.coalesce(F.col("source").isin(*allowed_sources), F.lit(False))
    errors.append(
        _error(~known, F.concat(F.lit("Invalid source: "), F.coalesce("source", F.lit("None"))))
    )
    return _listed(errors)


def with_validation(df: DataFrame, allowed_sources: Sequence[str] = ALLOWED_SOURCES) -> DataFrame:
    """Adds ``errors`` and ``valid``."""
    return df.withColumn("errors", posting_errors(allowed_sources)).withColumn(
        "valid", F.size("errors") == 0
    )


def valid_rows(df: DataFrame, allowed_sources: Sequence[str] = ALLOWED_SOURCES) -> DataFrame:
    return df.where(F.size(posting_errors(allowed_sources)) == 0)


@dataclass(frozen=True)
class Constraint:
    """What a stored column must satisfy."""

    column: str
    not_null: bool = False
    max_length: int | None = None
    one_of: Sequence[str] | None = None
    between: tuple[int, int] | None = None


# Constraints of the stored tables.
POSTING_CONSTRAINTS = (
    Constraint("job_title", not_null=True, max_length=500),
    Constraint("company", max_length=300),
    Constraint("location", max_length=200),
    Constraint("salary_text", max_length=200),
    Constraint("posting_url", not_null=True, max_length=1000),
    Constraint("source", not_null=True, max_length=50, one_of=ALLOWED_SOURCES),
)
RUN_LOG_CONSTRAINTS = (
    Constraint("source", not_null=True, max_length=50),
    Constraint("scrape_start", not_null=True),
    Constraint("status", max_length=20, one_of=RUN_STATES),
)
NOTIFICATION_LOG_CONSTRAINTS = (
    Constraint("recipient", not_null=True, max_length=255),
    Constraint("subject", max_length=500),
    Constraint("status", max_length=20, one_of=NOTIFICATION_STATES),
)
KEYWORD_PRIORITY_CONSTRAINTS = (
    Constraint("keyword", not_null=True, max_length=100),
    Constraint("priority", between=(1, 5)),
    Constraint("category", max_length=50),
)


def constraint_errors(constraints: Sequence[Constraint]) -> Column:
    """Errors per row; as in SQL, a null passes every check but NOT NULL."""
    errors = []
    for rule in constraints:
        value = F.col(rule.column)
        if rule.not_null:
            errors.append(_error(value.isNull(), f"{rule.column} is null"))
        if rule.max_length is not None:
            errors.append(
                _error(
                    F.length(value) > rule.max_length,
                    f"{rule.column} is longer than {rule.max_length}",
                )
            )
        if rule.one_of is not None:
            errors.append(
                _error(~value.isin(*rule.one_of), f"{rule.column} is not an allowed value")
            )
        if rule.between is not None:
            low, high = rule.between
            errors.append(
                _error(~value.between(low, high), f"{rule.column} is not in {low}..{high}")
            )
    return _listed(errors)
