"""URL columns: validity, host, and RFC 3986 resolution."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rolelake.functions.text import _col

_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"
_LEADING_CONTROL = r"^[\x00-\x20]+"


def _tidy(c: Column | str) -> Column:
    # URL parsers ignore leading control characters and any tab or line break.
    return F.translate(F.regexp_replace(_col(c), _LEADING_CONTROL, ""), "\t\r\n", "")


def is_valid_url(c: Column | str) -> Column:
    """True where a scheme and a host part are present; never null."""
    url = _tidy(c)
    host = F.regexp_extract(url, rf"^{_SCHEME}://([^/?#]+)", 1)
    brackets_pair = F.contains(host, F.lit("[")) == F.contains(host, F.lit("]"))
    return F.coalesce((host != "") & brackets_pair, F.lit(False))


def extract_domain(c: Column | str) -> Column:
    """Host part with user and port; '' where there is none."""
    host = F.regexp_extract(_tidy(c), rf"^(?:{_SCHEME}:)?//([^/?#]*)", 1)
    return F.coalesce(host, F.lit(""))


def _resolve_dots(path: Column) -> Column:
    """Fold '.' and '..' segments of a path that starts with '/'."""
    segments = F.split(F.substring(path, 2, 2**31 - 1), "/")
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda kept, s: F.when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(s == ".", kept)
        .otherwise(F.array_append(kept, s)),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    closed = F.when(ends_in_dots, F.array_append(folded, F.lit(""))).otherwise(folded)
    return F.concat(F.lit("/"), F.array_join(closed, "/"))


def make_absolute_url(base: Column | str, relative: Column | str) -> Column:
    """Resolve ``relative`` against ``base``; null counts as ''."""
    base_url = F.coalesce(_col(base), F.lit(""))
    rel = F.coalesce(_col(relative), F.lit(""))

    scheme = F.regexp_extract(base_url, rf"^({_SCHEME}):", 1)
    origin = F.regexp_extract(base_url, rf"^({_SCHEME}://[^/?#]*)", 1)
    base_path = F.regexp_extract(base_url, rf"^{_SCHEME}://[^/?#]*([^?#]*)", 1)
    base_query = F.regexp_extract(base_url, r"^[^?#]*(\?[^#]*)", 1)

    rel_path = F.regexp_extract(rel, r"^([^?#]*)", 1)
    rel_rest = F.regexp_extract(rel, r"(?s)^[^?#]*(.*)$", 1)

    folder = F.regexp_replace(base_path, r"[^/]*$", "")
    merged = F.when(F.startswith(rel_path, F.lit("/")), rel_path).otherwise(
        F.regexp_replace(F.concat(F.lit("/"), folder, rel_path), "/{2,}", "/")
    )
    has_dots = F.contains(merged, F.lit("/."))
    path = F.when(has_dots, _resolve_dots(merged)).otherwise(merged)

    return (
        F.when(rel == "", base_url)
        .when((base_url == "") | rel.rlike(rf"^{_SCHEME}:"), rel)
        .when(F.startswith(rel, F.lit("//")), F.concat(scheme, F.lit(":"), rel))
        .when(
            F.startswith(rel, F.lit("?")),
            F.concat(origin, base_path, rel),
        )
        .when(
            F.startswith(rel, F.lit("#")),
            F.concat(origin, base_path, base_query, rel),
        )
        .otherwise(F.concat(origin, path, rel_rest))
    )
