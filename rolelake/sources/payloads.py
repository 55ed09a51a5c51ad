"""Postings out of a table of JSON payloads, through the VARIANT type."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from rolelake.functions.dates import parse_date
from rolelake.functions.text import (
    blank_to_null,
    clean_text,
    extract_salary,
    let,
    normalize_location,
    truncate_text,
)

# Names under which an object may hold its array of items, in order.
WRAPPERS = ("jobs", "results", "data", "listings", "items")

# JSON values that count as empty unless they are strings.
_EMPTY_JSON = r"^(-?0+(\.0+)?([eE][+-]?[0-9]+)?|false|null|\[\]|\{\})$"


@dataclass(frozen=True)
class PayloadRules:
    """Where a source keeps its fields: names per field, tried in order."""

    source: str
    base_url: str
    fields: Mapping[str, Sequence[str]]
    defaults: Mapping[str, str] = field(default_factory=dict)
    wrappers: Sequence[str] = WRAPPERS


# Field names of the two sources with JSON payloads.
BRIGHTERMONDAY = PayloadRules(
    source="BrighterMonday",
    base_url="https://www.brightermonday.co.ke",
    fields={
        "title": ("title", "name", "job_title", "position"),
        "url": ("url", "link", "posting_url", "job_url"),
        "company": ("company", "employer", "affiliation", "organisation"),
        "location": ("location", "city", "location_name"),
        "description": ("description", "snippet", "summary"),
        "date": ("posted_date", "date", "created_at", "published_at"),
        "salary": ("salary", "salary_text", "salary_range"),
    },
    defaults={"company": "N/A", "location": "Nairobi"},
)
FUZU = PayloadRules(
    source="Fuzu",
    base_url="https://fuzu.com",
    fields={
        "title": ("title", "name", "job_title"),
        "url": ("url", "link", "posting_url"),
        "company": ("company", "employer"),
        "location": ("location",),
        "description": ("description", "snippet"),
        "date": ("posted_date", "date", "created_at", "deadline"),
    },
    defaults={"company": "N/A", "location": "Kenya"},
)


def _path(name: str) -> str:
    return f"$['{name}']"


def _filled_text(item: Column, name: str) -> Column:
    """Text of one field, null where the value is empty ('' , 0, false, [], {}, null)."""
    value = F.try_variant_get(item, _path(name), "variant")

    def unless_empty(text: Column) -> Column:
        # Only a text that looks empty needs a look at its kind.
        return F.when(text == "", None).when(
            text.rlike(_EMPTY_JSON), F.when(F.schema_of_variant(value) == "STRING", text)
        ).otherwise(text)

    return let(F.try_variant_get(item, _path(name), "string"), unless_empty)


def _is_filled(item: Column, name: str) -> Column:
    """True where a field holds a value that is not empty."""
    n_items = F.size(F.try_variant_get(item, _path(name), "array<variant>"))
    return F.coalesce(n_items > 0, _filled_text(item, name).isNotNull())


def alias_chain(item: Column, names: Sequence[str], default: str | None = None) -> Column:
    """First field of the list that is filled, else ``default``."""
    tries = [_filled_text(item, n) for n in names]
    return F.coalesce(*tries, F.lit(default).cast("string"))


def _items(payload: str, wrappers: Sequence[str]) -> Column:
    """The payload's array of items, or null."""
    wrapped = F
    for name in wrappers:
        wrapped = wrapped.when(
            _is_filled(F.col(payload), name),
            F.try_variant_get(payload, _path(name), "array<variant>"),
        )
    return F.coalesce(F.try_variant_get(payload, "$", "array<variant>"), wrapped)


def payload_fields(
    payloads: DataFrame, rules: PayloadRules, body: str = "body"
) -> DataFrame:
    """Raw fields per item, as text, next to the payload's other columns and ``item_pos``.

    A payload is an array, or an object with the array under its first filled wrapper.
    Broken payloads and other shapes give no row, nor do items that are not objects or lack
    a title or URL.
    """
    kept = [c for c in payloads.columns if c != body]
    parsed = payloads.select(*kept, F.try_parse_json(body).alias("_payload"))

    def fields(item: Column, pos: Column) -> Column:
        is_object = F.startswith(F.schema_of_variant(item), F.lit("OBJECT"))
        texts = {
            name: alias_chain(item, names, rules.defaults.get(name))
            for name, names in rules.fields.items()
        }
        texts["url"] = let(
            texts["url"],
            lambda u: F.when(F.startswith(u, F.lit("http")), u).otherwise(
                F.concat(F.lit(rules.base_url), u)
            ),
        )
        raw = [text.alias(f"raw_{name}") for name, text in texts.items()]
        return F.when(is_object, F.struct(pos.alias("item_pos"), *raw))

    # Dropped inside the array: a filter on rows would be pushed down and extract twice.
    complete = F.filter(
        F.transform(_items("_payload", rules.wrappers), fields),
        lambda f: f["raw_title"].isNotNull() & f["raw_url"].isNotNull(),
    )
    return parsed.select(*kept, F.inline(complete))


def payload_postings(
    payloads: DataFrame,
    rules: PayloadRules,
    as_of: datetime | str,
    body: str = "body",
) -> DataFrame:
    """Normalised posting columns per item, next to the payload's other columns."""
    raw = payload_fields(payloads, rules, body)
    kept = [c for c in raw.columns if not c.startswith("raw_")]

    def column(name: str) -> Column:
        return F.coalesce(f"raw_{name}", F.lit("")) if name in rules.fields else F.lit("")

    salary = F.lit(None).cast("string")
    if "salary" in rules.fields:
        salary = F.coalesce(
            blank_to_null(clean_text(column("salary"))), extract_salary(column("description"))
        )
    return raw.select(
        *kept,
        clean_text("raw_title").alias("job_title"),
        clean_text(column("company")).alias("company"),
        normalize_location(column("location")).alias("location"),
        F.col("raw_url").alias("posting_url"),
        F.lit(rules.source).alias("source"),
        salary.alias("salary_text"),
        blank_to_null(truncate_text(clean_text(column("description")), 500)).alias(
            "description_snippet"
        ),
        F.lit(None).cast("string").alias("full_description"),
        parse_date(column("date"), as_of).alias("posted_date"),
        F.create_map(F.lit("source"), F.lit("api_intercept")).alias("metadata"),
    )
