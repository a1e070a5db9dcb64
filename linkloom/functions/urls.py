"""URL expressions."""

from __future__ import annotations

from urllib.parse import uses_relative

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"


def url_root(url: Column) -> Column:
    """``scheme://authority/``; https and the whole input where a part is missing."""
    scheme = F.lower(F.regexp_extract(url, _SCHEME, 1))
    authority = F.regexp_extract(url, _AUTHORITY, 1)
    return F.when(
        scheme == "",
        F.concat(F.lit("https://"), F.when(authority == "", url).otherwise(authority), F.lit("/")),
    ).otherwise(F.concat(scheme, F.lit("://"), authority, F.lit("/")))


def collapse_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.array_append(done, part)),
    )
    closed = F.when(
        F.element_at(segments, -1).isin(".", ".."), F.array_append(kept, F.lit(""))
    ).otherwise(kept)
    joined = F.array_join(closed, "/")
    return F.when(F.startswith(joined, F.lit("/")), joined).otherwise(
        F.concat(F.lit("/"), joined)
    )


def url_join(base: Column, href: Column) -> Column:
    """Resolve a root-relative href against the root of ``base``; others are unchanged."""
    root = url_root(base)
    scheme = F.regexp_extract(root, _SCHEME, 1)
    path = F.regexp_extract(href, r"(?s)^([^?#]*)", 1)
    tail = F.regexp_extract(href, r"(?s)^[^?#]*(.*)$", 1)
    tail = F.regexp_replace(F.regexp_replace(tail, r"^([^#]*)#$", "$1"), r"^\?(?=#|$)", "")
    rooted = F.concat(
        F.regexp_extract(root, _ORIGIN, 1),
        F.when(F.contains(path, F.lit("/.")), collapse_dots(path)).otherwise(path),
        tail,
    )
    hosted = F.concat(scheme, F.lit(":"), path, tail)
    relative = F.startswith(href, F.lit("/")) & scheme.isin(*[s for s in uses_relative if s])
    return (
        F.when(relative & F.startswith(href, F.lit("//")), hosted)
        .when(relative, rooted)
        .otherwise(href)
    )
