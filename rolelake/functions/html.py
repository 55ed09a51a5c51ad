"""HTML fragments as columns: character references and visible text nodes."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, functions as F

from rolelake.functions.constants import constant_map
from rolelake.functions.text import _col, strip_ws

# Some old names count without the semicolon, too; the longest of them that fits is taken.
_BARE_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
_REFERENCE = rf"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;|(?:{_BARE_NAMES}))"
# A whole tag: a quoted value after "=" may hold ">".
TAG = r"""<[/a-zA-Z!?](?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+>"""
# Tried before the whole table is searched.
_COMMON_REFERENCES = ("amp", "nbsp", "quot", "lt", "gt", "apos")
_LARGEST_CODE_POINT = 0x10FFFF


def _named_references() -> Column:
    # The standard library's table of named references.
    return constant_map(dict(html5), "string")


def _code_point(n: Column) -> Column:
    usable = n.between(1, 0xD7FF) | n.between(0xE000, _LARGEST_CODE_POINT)
    code = F.when(usable, n).otherwise(F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _decode_reference(ref: Column) -> Column:
    digits = F.regexp_extract(ref, r"^&#([0-9]+);?$", 1)
    hex_digits = F.regexp_extract(ref, r"^&#[xX]([0-9a-fA-F]+);?$", 1)
    common = F
    for name in _COMMON_REFERENCES:
        common = common.when(ref == f"&{name};", F.lit(html5[f"{name};"]))
    return (
        common.when(digits != "", _code_point(digits.try_cast("bigint")))
        .when(hex_digits != "", _code_point(F.conv(hex_digits, 16, 10).try_cast("bigint")))
        .otherwise(F.coalesce(F.try_element_at(_named_references(), F.substring(ref, F.lit(2), F.length(ref))), ref))
    )


def decode_references(c: Column | str) -> Column:
    """Replace character references by the characters they stand for."""
    text = _col(c)
    between = F.split(text, _REFERENCE, -1)
    decoded = F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)), _decode_reference)
    joined = F.array_join(
        F.zip_with(
            between,
            decoded,
            lambda plain, ref: F.concat(plain, F.coalesce(ref, F.lit(""))),
        ),
        "",
    )
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def visible_text(c: Column | str) -> Column:
    """Text of a fragment: each text node stripped, then all joined without a gap."""
    nodes = F.split(_col(c), TAG, -1)
    return F.array_join(F.transform(nodes, lambda node: strip_ws(decode_references(node))), "")
